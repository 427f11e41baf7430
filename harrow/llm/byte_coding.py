"""Byte-level BPE by prefix dynamic programming.

Merging by rank gives each byte string one encoding, whose beginnings are encodings too. So each prefix of a string has one valid last
token: the token that ends there and may follow the last token of the prefix before it, which is so if merging the two tokens' bytes gives
just these two. The table of last tokens is filled from left to right; ids are read off it from the end. It can be carried on behind its end
(an append), and after an edit it is filled again only from the edit to where it agrees with the old one for as long as a token may be.
A text is cut by a pattern first; its pieces are encoded apart from each other, so one table holds the pieces of a text one after another.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache, cached_property
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import slices, string_bytes, tidied

#: Pieces and pairs of tokens that a task remembers, the longest piece (in characters) that it does, and pieces of a text encoded at once.
REMEMBERED, LONGEST_REMEMBERED, AT_ONCE = 300_000, 64, 65_536


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _ranges(points: set[int]) -> str:
    """A set of characters for a pattern."""
    firsts, lasts = (sorted(c for c in points if c + step not in points) for step in (-1, 1))
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts, lasts, strict=True)) + "]"


@cache
def as_library(pattern: str) -> tuple[str, str]:
    """pattern with the letters and numbers of the tiktoken library's Unicode version in place of this interpreter's, which may know more or
    fewer; and a pattern of the characters that the versions differ on, empty if there are none.

    Whether the library takes a character for a letter shows from a vocabulary that has a token for `a` with the character's first byte: the
    two only meet if no piece ends between them. Numbers likewise behind `1`."""
    import tiktoken

    odd: set[int] = set()
    points = [c for c in (*range(0x80, 0x40000), *range(0xE0000, 0xE1000)) if not 0xD800 <= c < 0xE000]  # the planes that have characters with a class
    for name, before in (("L", "a"), ("N", "1")):
        pairs = {bytes([b]): b for b in range(256)} | {before.encode() + bytes([b]): 256 + b for b in range(0x80, 256)}
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=pairs, special_tokens={})
        theirs: set[int] = set()
        for k in range(0, len(points), 1 << 14):
            part = points[k : k + (1 << 14)]
            ids = np.array(probe.encode_ordinary("".join(f"{before}{chr(c)}\n" for c in part)))
            heads = np.concatenate([[0], np.flatnonzero(ids == 10)[:-1] + 1])
            theirs.update(np.array(part)[ids[heads] >= 256].tolist())
        ours = {ord(c) for c in regex.findall(rf"\p{{{name}}}", "".join(map(chr, points)))}
        odd |= ours ^ theirs
        if ours != theirs:
            own = rf"\p{{{name}}}"
            own = f"[{own}--{_ranges(ours - theirs)}]" if ours - theirs else own
            pattern = pattern.replace(rf"\p{{{name}}}", f"[{own}||{_ranges(theirs - ours)}]" if theirs - ours else own)
    return pattern, _ranges(odd) if odd else ""


class ByteVocabulary:
    """Ranks of a byte-level BPE and the pattern that cuts texts. It is small (some ten thousand tokens) and travels with the task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, as_library: tuple[str, str] = ("", "")):
        self.ranks, self.pattern, self.as_library = ranks, pattern, as_library
        self._pairs: dict[int, bool] = {}
        self._codes: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str | None = None, pattern: str | None = None) -> ByteVocabulary:
        """The ranks of a file with one base64 token and its rank a line. An error if a byte has no token or merging doesn't reach a token."""
        with open(path or default_ranks(), "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, file)))}
        pattern = pattern or default_pattern()
        out = cls(ranks, pattern, as_library(pattern))
        lost = [t for t in [*map(bytes, zip(range(256))), *ranks] if t not in ranks or out.merged(t) != [ranks[t]]]
        if lost:
            raise ValueError(f"{len(lost)} tokens can't be had by merging bytes, such as {lost[0]!r}")
        return out

    def __reduce__(self):
        return _shared, (self.ranks, self.pattern, self.as_library)

    @cached_property
    def tokens(self) -> dict[int, bytes]:
        return {rank: token for token, rank in self.ranks.items()}

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.ranks))

    @cached_property
    def _splits(self) -> tuple[regex.Pattern, regex.Pattern, re.Pattern, re.Pattern]:
        """The pattern as it is, the exact one, and what finds characters that need the latter: none below the first of them, which is quick to see."""
        exact, odd = self.as_library
        above = re.compile(rf"[{odd[1:11]}-\U0010ffff]") if odd else re.compile("(?!)")
        return regex.compile(self.pattern), regex.compile(exact or self.pattern, regex.VERSION1), above, re.compile(odd or "(?!)")

    def split(self, text: str) -> regex.Pattern:
        """What cuts the text: the pattern as it is, unless a character needs the slower one that knows the library's Unicode version."""
        plain, exact, above, odd = self._splits
        return exact if not text.isascii() and above.search(text) and odd.search(text) else plain

    @cached_property
    def endings(self):
        """Finds every token that ends at each byte of a string, longest first."""
        import ahocorasick

        found = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            found.add_word(token.decode("latin-1"), (rank, len(token)))
        found.make_automaton()
        return found

    def merged(self, piece: bytes) -> list[int]:
        """The tokens of a short string by merging the pair of least rank, the first of several, as long as there is one."""
        rank, most = self.ranks.get, 1 << 62
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = [rank(piece[i : i + 2], most) for i in range(len(piece) - 1)]
        while ranks and (low := min(ranks)) < most:
            i = ranks.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], most)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], most)
        return [self.ranks[p] for p in parts]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging the two tokens' bytes gives just them."""
        if len(self._pairs) >= REMEMBERED:
            self._pairs.clear()
        both = self.tokens[a] + self.tokens[b]
        self._pairs[a << 32 | b] = known = both not in self.ranks and self.merged(both) == [a, b]
        return known

    def fill(self, piece: bytes, last: list[int], old: list[int] = (), same: int = 0) -> tuple[list[int], int]:
        """(the table of piece, bytes whose token was looked for): `last`, the table of a beginning of piece, is carried on to its end.

        `old` is the table of a string whose last `same` bytes are piece's. Where both agree on so many of these as the longest token has, they
        agree on all that follows, which is taken from it.
        """
        done, back, behind, agreed, pairs = len(last), len(old) - len(piece), len(piece) - same, 0, self._pairs
        for end, (token, size) in self.endings.iter(piece.decode("latin-1"), max(0, done - self.longest + 1)):
            if end < len(last):
                continue
            if size <= end:
                before = last[end - size]
                if (known := pairs.get(before << 32 | token)) is None:
                    known = self.may_follow(before, token)
                if not known:
                    continue
            last.append(token)
            if end >= behind:
                agreed = agreed + 1 if old[end + back] == token else 0
                if agreed == self.longest:
                    return last + old[end + back + 1 :], end + 1 - done
        return last, len(piece) - done

    def ids(self, last: list[int]) -> list[int]:
        """The ids of a table, read from its end."""
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.tokens[last[at - 1]])
        return out[::-1]

    def encode_piece(self, piece: str) -> bytes:
        """The ids of one piece as little-endian 32-bit integers."""
        code = self._codes.get(piece)
        if code is None:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            ids = [whole] if whole is not None else self.ids(self.fill(raw, [])[0])
            code = pack(f"<{len(ids)}I", *ids)
            if len(piece) <= LONGEST_REMEMBERED:
                if len(self._codes) >= REMEMBERED:
                    self._codes.clear()
                self._codes[piece] = code
        return code

    def encode_text(self, text: str) -> Iterator[bytes]:
        """The ids of a text, in parts of AT_ONCE pieces."""
        known, own = self._codes, self.encode_piece
        split = self.split(text)
        found = split.finditer(text)
        while part := [m[0] for m in islice(found, AT_ONCE)] if len(text) > AT_ONCE else split.findall(text):
            yield b"".join([known.get(p) or own(p) for p in part])
            if len(text) <= AT_ONCE:
                return

    def decode(self, code: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(code, "<u4").tolist()))

    def table(self, text: str) -> list[int]:
        """The last token of each byte prefix of each piece, piece after piece."""
        return [t for m in self.split(text).finditer(text) for t in self.fill(m[0].encode(), [])[0]]

    def edited(self, text: str, last: list[int], at: int, removed: int, inserted: str) -> tuple[str, list[int], int]:
        """(new text, its table, bytes whose token was looked for) after `removed` characters at `at` of text gave way to `inserted`.

        A piece hangs on its own characters and at most two behind it, so pieces that end two before the edit stay. Behind the edit, the first
        piece that starts where an old one does has only old pieces behind it. A piece in between takes what it can from the old table.
        """
        new, shift, tail = text[:at] + inserted + text[at + removed :], len(inserted) - removed, at + len(inserted)
        split = self.split(text + inserted)
        starts = [m.start() for m in split.finditer(text)]
        number, stops = {s: k for k, s in enumerate(starts)}, [*starts[1:], len(text)]
        ending = {e: k for k, e in enumerate(stops)}
        place = lambda i: len(text[:i].encode())
        begin = starts[max(0, bisect_right(starts, at - 2) - 1)] if starts else 0
        out, looked = last[: place(begin)], 0
        for m in split.finditer(new, begin):
            s, e, held, old, same = m.start(), m.end(), [], [], 0
            if s >= tail and s - shift in number:
                return new, out + last[place(s - shift) :], looked
            if s < at and s in number:  # an old piece has the same beginning
                held = last[place(s) : place(min(at, e, stops[number[s]]))]
            if e > tail and e - shift in ending:  # an old piece has the same end
                k = ending[e - shift]
                old, same = last[place(starts[k]) : place(stops[k])], len(new[max(tail, s, starts[k] + shift) : e].encode())
            table, n = self.fill(m[0].encode(), held, old, same)
            out, looked = out + table, looked + n
        return new, out, looked


_last: list[ByteVocabulary] = []


def _shared(ranks: dict[bytes, int], pattern: str, as_library: tuple[str, str]) -> ByteVocabulary:
    """In a worker: the vocabulary of the task before, with what it remembers, if it is the same one."""
    if not _last or (_last[0].pattern, _last[0].as_library, _last[0].ranks) != (pattern, as_library, ranks):
        _last[:] = [ByteVocabulary(ranks, pattern, as_library)]
    return _last[0]


def encode(docs: DataFrame, keep: list[str] = ("doc_id",), path: str | None = None, pattern: str | None = None, tables: bool = False) -> DataFrame:
    """keep, n_tokens, ids, ids_sha256 and decoded_sha256 of each document's text; with tables, the table of its byte prefixes as last_tokens.

    ids are what merging by rank gives for each match of pattern, a whole match that is a token being that token; no string is special. They are
    hashed as little-endian 32-bit integers; decoded_sha256 is the digest of the bytes that they decode to. A null text is empty and has no ids.
    Equal rows give equal rows. There is no shuffle; a text of more than AT_ONCE characters is encoded so many pieces at a time.
    """
    vocabulary, keep = ByteVocabulary.load(path, pattern), list(keep)
    fields = [StructField("n_tokens", LongType()), StructField("ids", ArrayType(IntegerType(), False)), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    fields += [StructField("last_tokens", ArrayType(IntegerType(), False))] * tables
    rows = docs.select(*keep, F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(string_bytes(batch.column(len(keep)))[1]):
                own, codes, digests, decoded, lasts = batch.slice(a, b - a), [], [], [], []
                for text in own.column(len(keep)).to_pylist():
                    coded, back, parts = hashlib.sha256(), hashlib.sha256(), []
                    for code in vocabulary.encode_text(text or ""):
                        coded.update(code)
                        back.update(vocabulary.decode(code))
                        parts.append(code)
                    codes.append(b"".join(parts))
                    digests.append(coded.hexdigest())
                    decoded.append(back.hexdigest())
                    if tables:
                        lasts.append(np.array(vocabulary.table(text or ""), np.int32).tobytes())
                columns = [pa.array([len(c) // 4 for c in codes], pa.int64()), _lists(codes), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([*own.columns[: len(keep)], *columns, *([_lists(lasts)] if tables else [])], [*keep, *(f.name for f in fields)])

    return rows.mapInArrow(tidied(run), StructType([f for f in rows.schema.fields if f.name != "_text"] + fields))


def _lists(codes: list[bytes]) -> pa.Array:
    """A list of integers from each row's bytes."""
    offsets = np.zeros(len(codes) + 1, np.int32)
    np.cumsum([len(c) // 4 for c in codes], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(codes), np.int32)))


def edit(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """encoded (text, last_tokens and any other columns) after an edit of each row: `removed` characters of text from `at` on give way to
    `inserted`; at = length of text is an append. text, last_tokens, ids and n_tokens become the new text's, exactly as encode() gives them;
    n_looked is the number of bytes whose token had to be looked for. Places beyond the text mean its end; nulls are nothing (0 or empty)."""
    vocabulary = ByteVocabulary.load(path, pattern)
    left = [c for c in encoded.columns if c not in ("text", "last_tokens", "ids", "n_tokens", "ids_sha256", "decoded_sha256", "at", "removed", "inserted")]
    rows = encoded.select(*left, "text", "last_tokens", F.col("at").cast("long").alias("at"), F.col("removed").cast("long").alias("removed"), "inserted")
    whole = ArrayType(IntegerType(), False)
    schema = StructType([*rows.select(*left).schema.fields, StructField("text", StringType()), StructField("last_tokens", whole), StructField("ids", whole), StructField("n_tokens", LongType()), StructField("n_looked", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(string_bytes(batch.column(len(left)))[1]):
                own, out = batch.slice(a, b - a), []
                for text, last, at, removed, inserted in zip(*(c.to_pylist() for c in own.columns[len(left) :]), strict=True):
                    text = text or ""
                    at = min(max(at or 0, 0), len(text))
                    text, last, looked = vocabulary.edited(text, last or [], at, min(max(removed or 0, 0), len(text) - at), inserted or "")
                    ids = vocabulary.ids(last)
                    out.append((text, np.array(last, np.int32).tobytes(), np.array(ids, np.int32).tobytes(), len(ids), looked))
                texts, lasts, codes, counts, looks = map(list, zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([*own.columns[: len(left)], pa.array(texts, pa.string()), _lists(lasts), _lists(codes), pa.array(counts, pa.int64()), pa.array(looks, pa.int64())], schema.fieldNames())

    return rows.mapInArrow(tidied(run), schema)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """encoded with a column text: what its ids decode to, bytes that aren't UTF-8 as replacement characters. Null ids give null; an unknown id is an error."""
    vocabulary, left = ByteVocabulary.load(path), [c for c in encoded.columns if c not in ("text", "ids")]
    rows = encoded.select(*left, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if ids is None else vocabulary.decode(np.array(ids, "<u4").tobytes()).decode("utf-8", "replace") for ids in batch.column(len(left)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*left, "ids", "text"])

    return rows.mapInArrow(tidied(run), StructType([*rows.schema.fields, StructField("text", StringType())]))
