"""SentencePiece encoding and decoding with a shared-prefix Viterbi search.

Spaces become marks and a text is cut into marked words, which no piece of the vocabulary crosses. The distinct words of
a stretch of texts are sorted, so that words with a common beginning follow each other as in a depth-first walk of
their trie: the search takes each distinct prefix once, all of one length together, with the forward scores of the shorter ones. The result is the
segmentation with the largest sum of the model's piece scores. Characters outside the vocabulary become their bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import slices, string_bytes, tidied

MARK = "▁"
#: The mark and the space change places, so a mark that a text has itself stays apart from its spaces.
SWAP = {ord(" "): MARK, ord(MARK): " "}
WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n+")
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words whose pieces a task remembers.
REMEMBERED = 500_000
#: Words searched together, and the longest one (in characters) that is.
TOGETHER, LONGEST_TOGETHER = 8192, 48


def path_scores(scores: list[float]) -> list[float]:
    """Scores that may be summed along a path. A unigram model's are logarithms of probabilities and stay. A merge model's are ranks
    (whole numbers from 0 down), whose sums mean nothing: a piece of rank r gets the logarithm of a Zipf probability, -log(r + 2)."""
    return [-log(2 - s) for s in scores] if all(s == int(s) <= 0 for s in scores) else scores


class PieceVocabulary:
    """Pieces and scores of a SentencePiece model. It is small (some ten thousand pieces) and travels with the task."""

    def __init__(self, pieces: list[str], scores: list[float], bytes_first: int):
        self.pieces, self.scores, self.bytes_first = pieces, scores, bytes_first

    @classmethod
    def load(cls, model: str = DEFAULT_MODEL) -> PieceVocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        first = sp.piece_to_id("<0x00>")
        if first + 255 >= len(pieces) or not all(sp.is_byte(first + b) for b in range(256)):
            raise ValueError("the model has no pieces for bytes, which characters outside its pieces need")
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) for i in range(len(pieces))]
        for piece in (p for p, ok in zip(pieces, plain, strict=True) if ok):
            if "\n" in piece and len(piece) > 1 or MARK in piece.lstrip(MARK):
                raise ValueError(f"the piece {piece!r} crosses words")
        return cls([p if ok else "" for p, ok in zip(pieces, plain, strict=True)], path_scores([sp.get_score(i) for i in range(len(pieces))]), first)

    def __reduce__(self):
        return PieceVocabulary, (self.pieces, self.scores, self.bytes_first)

    @cached_property
    def byte_score(self) -> float:
        return min(self.scores) - 10.0

    @cached_property
    def endings(self) -> tuple[dict[int, int], list[tuple[int, float] | None]]:
        """The pieces as a trie read from their ends: (node and character -> node, what ends at the node)."""
        step: dict[int, int] = {}
        found: list[tuple[int, float] | None] = [None]
        for i, piece in enumerate(self.pieces):
            node = 0
            for c in reversed(piece):
                key = node << 21 | ord(c)
                if key not in step:
                    step[key] = len(found)
                    found.append(None)
                node = step[key]
            if piece and (found[node] is None or found[node][1] < self.scores[i]):
                found[node] = (i, self.scores[i])
        return step, found

    @cached_property
    def texts(self) -> list[bytes]:
        out = [p.replace(MARK, " ").encode() for p in self.pieces]
        for b in range(256):
            out[self.bytes_first + b] = bytes([b])
        return out

    @cached_property
    def searched(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """endings as arrays: the sorted keys of its steps and the nodes they lead to; each node's piece (-1: none) and score."""
        step, found = self.endings
        keys = np.array(sorted(step), np.int64)
        return keys, np.array([step[k] for k in keys.tolist()], np.int64), np.array([f[0] if f else -1 for f in found], np.int32), np.array([f[1] if f else -np.inf for f in found])

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The pieces of each of the words, which are sorted. Of equally good paths the one with the longest last piece wins."""
        pieces: dict[str, list[int]] = {}
        short = [w for w in words if len(w) <= LONGEST_TOGETHER]
        for k in range(0, len(short), TOGETHER):
            flat, counts = self._encode_together(short[k : k + TOGETHER])
            ends = np.cumsum(counts).tolist()
            flat = flat.tolist()
            pieces.update((w, flat[i:j]) for w, i, j in zip(short[k : k + TOGETHER], [0, *ends], ends, strict=False))
        long = [w for w in words if len(w) > LONGEST_TOGETHER]
        pieces.update(zip(long, self._encode_long(long), strict=True))
        return [pieces[w] for w in words]

    def _encode_together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of sorted words, one word after another, and how many each has.

        A prefix that words share is one state. States are numbered by length, so those of one length are a range that follows from the ranges before."""
        keys, nodes, piece_at, score_at = self.searched
        most, n = max(map(len, self.pieces)), len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        wide = int(lengths.max())
        chars = np.array(words, f"U{wide}").view(np.uint32).reshape(n, wide)
        same = np.zeros(n, np.int64)
        same[1:] = np.minimum(np.hstack([chars[1:] != chars[:-1], np.ones((n - 1, 1), bool)]).argmax(axis=1), np.minimum(lengths[1:], lengths[:-1]))
        chars, at = np.ascontiguousarray(chars.T).astype(np.int64), np.arange(wide)[:, None]
        new = (at >= same) & (at < lengths)
        number = np.cumsum(new.ravel()).reshape(wide, n)
        state = np.zeros((wide + 1, n), np.int64)  # by length of the prefix; 0 is the empty one
        state[1:] = np.maximum.accumulate(np.where(new, number, 0), axis=1)
        last, word = (np.concatenate([[0], x]) for x in np.nonzero(new))  # of each state: the place of its last character, and a word
        char = chars[last, word]

        size = len(last)
        score, piece, before = np.full((size, most), -np.inf), np.full((size, most), -1, np.int32), np.zeros((size, most), np.int32)
        own, node = np.arange(1, size), np.zeros(size - 1, np.int64)
        for d in range(most):  # pieces of d + 1 characters that end at a state; longer ones are in columns before
            inside = last[own] >= d
            own, node = own[inside], node[inside]
            key = node << 21 | chars[last[own] - d, word[own]]
            i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[i] == key
            own, node = own[hit], nodes[i[hit]]
            ends = piece_at[node] >= 0
            a = own[ends]
            score[a, most - 1 - d], piece[a, most - 1 - d], before[a, most - 1 - d] = score_at[node[ends]], piece_at[node[ends]], state[last[a] - d, word[a]]

        as_bytes = 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000)
        spelt = np.where(char == ord(" "), 3, as_bytes)  # a space stands for a mark
        parent = state[last, word]  # the prefix without its last character
        best, count, took, back = np.zeros(size), np.zeros(size, np.int64), np.full(size, -1, np.int32), np.zeros(size, np.int64)
        to = np.cumsum(new.sum(axis=1)) + 1
        for i, j in zip([1, *to.tolist()], to.tolist(), strict=False):
            scores = best[before[i:j]] + score[i:j]
            column = scores.argmax(axis=1)
            row = np.arange(j - i)
            top, took[i:j] = scores[row, column], piece[i:j][row, column]
            none = took[i:j] < 0
            back[i:j] = np.where(none, parent[i:j], before[i:j][row, column])
            best[i:j] = np.where(none, best[parent[i:j]] + self.byte_score * as_bytes[i:j], top)
            count[i:j] = count[back[i:j]] + np.where(none, spelt[i:j], 1)

        now = state[lengths, np.arange(n)]
        counts = count[now]
        end = np.cumsum(counts)
        flat = np.zeros(int(end[-1]), np.int32)
        kinds, kind = np.unique(char[took < 0], return_inverse=True)
        spelling = [(MARK if c == ord(" ") else chr(c)).encode("utf-8", "surrogatepass") for c in kinds.tolist()]
        own_bytes, kind_of = np.array([list(b.ljust(4, b"\0")) for b in spelling], np.int32).reshape(-1, 4), np.zeros(size, np.int64)
        kind_of[took < 0] = kind
        while len(now):
            plain = took[now] >= 0
            flat[end[plain] - 1] = took[now[plain]]
            odd, behind = now[~plain], end[~plain]
            for k in range(4 if len(odd) else 0):
                there = spelt[odd] > k
                flat[(behind - spelt[odd] + k)[there]] = self.bytes_first + own_bytes[kind_of[odd[there]], k]
            end = end - np.where(plain, 1, spelt[now])
            now = back[now]
            now, end = now[now > 0], end[now > 0]
        return flat, counts

    def _encode_long(self, words: list[str]) -> list[list[int]]:
        """As encode_words(), a character after another, with no bound on a word's length."""
        step, found = self.endings
        out: list[list[int]] = []
        best, back, last = [0.0], [(0, 0)], ""  # by position: score, (where the last piece starts, its id or -1 for bytes)
        for word in words:
            same, most = 0, min(len(word), len(last))
            while same < most and word[same] == last[same]:
                same += 1
            del best[same + 1 :], back[same + 1 :]
            for j in range(same + 1, len(word) + 1):
                node, i, top, choice = 0, j, float("-inf"), (j - 1, -1)
                while i and (node := step.get(node << 21 | ord(word[i - 1]), -1)) > 0:
                    i -= 1
                    if (piece := found[node]) and (score := best[i] + piece[1]) >= top:
                        top, choice = score, (i, piece[0])
                if choice[1] < 0:
                    top = best[j - 1] + self.byte_score * len(word[j - 1].encode())
                best.append(top)
                back.append(choice)
            path, j = [], len(word)
            while j:
                i, piece = back[j]
                path += [piece] if piece >= 0 else [self.bytes_first + b for b in reversed((MARK if word[i] == " " else word[i]).encode())]
                j = i
            out.append(path[::-1])
            last = word
        return out

    def words(self, text: str) -> list[str]:
        """A text's marked words; a mark before the text lets its first word look like any other."""
        return WORD.findall(MARK + text.translate(SWAP)) if text else []

    def keys(self, text: str) -> list[str]:
        """The marked words of a text in a form that splitting gives at once: a word after one space is what follows the space, a word
        at a line's start has a line feed before it, runs of line feeds are themselves, and any other word is marked and has a NUL before it."""
        if not text:
            return []
        out: list[str] = []
        if "\0" not in text and "  " not in text and "\n\n" not in text and " \n" not in text and "\n " not in text and text[0] != " " and text[-1] != " ":
            for k, line in enumerate(text.split("\n")):
                tokens = line.split(" ") if line else []
                if k:
                    out.append("\n")
                    if tokens:
                        tokens[0] = "\n" + tokens[0]
                elif not tokens:
                    return ["\0" + w for w in self.words(text)]
                out += tokens
            return out
        return ["\0" + w for w in self.words(text)]

    @staticmethod
    def marked(key: str) -> str:
        if key[0] == "\0":
            return key[1:]
        own = key.replace(MARK, " ")  # splitting left no spaces
        if key[0] == "\n":
            return own[1:] or "\n"
        return MARK + own

    def encode_keys(self, keys: set[str]) -> dict[str, list[int]]:
        """The pieces of each key's word."""
        own, flat, counts = self.coded_keys(keys)
        ends = np.cumsum(counts).tolist()
        flat = flat.tolist()
        return {k: flat[i:j] for k, i, j in zip(own, [0, *ends], ends, strict=False)}

    def coded_keys(self, keys: set[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The keys in an order of their own, the pieces of their words one after another, and how many each has."""
        words = sorted((self.marked(k), k) for k in keys)
        short, long = [x for x in words if len(x[0]) <= LONGEST_TOGETHER], [x for x in words if len(x[0]) > LONGEST_TOGETHER]
        parts = [self._encode_together([w for w, _ in short[k : k + TOGETHER]]) for k in range(0, len(short), TOGETHER)]
        more = self._encode_long([w for w, _ in long])
        parts.append((np.fromiter(chain.from_iterable(more), np.int32), np.array([len(p) for p in more], np.int64)))
        return [k for _, k in short + long], *(np.concatenate(x) for x in zip(*parts, strict=True))

    def encode(self, text: str) -> list[int]:
        keys = self.keys(text)
        pieces = self.encode_keys(set(keys))
        return [p for k in keys for p in pieces[k]]

    def decode(self, ids: list[int]) -> str:
        texts = self.texts
        return b"".join([texts[i] for i in ids]).decode("utf-8", "replace")[1:]


def encode(docs: DataFrame, model: str = DEFAULT_MODEL, keep: list[str] | None = None, check: bool = False) -> DataFrame:
    """The columns of docs (all, or those to keep; own ones replace others of their names) with ids (array of int, the pieces of text) and n_tokens; with check also decoded_sha256, the
    digest of the text that the ids decode to. Nothing is shuffled. Null and empty texts have no pieces.

    A task takes texts in stretches of a quarter of a megabyte, and searches only words that it doesn't remember.
    """
    vocabulary = PieceVocabulary.load(model)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("ids", "n_tokens", "decoded_sha256")]
    names = [*keep, "ids", "n_tokens", *(["decoded_sha256"] if check else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[str, int] = {}
        flat, ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        for batch in batches:
            texts = batch.column(0)
            _, offsets = string_bytes(texts)
            for a, b in slices(offsets):
                rows = [vocabulary.keys(t or "") for t in texts[a:b].to_pylist()]
                if len(ids) > REMEMBERED:
                    ids, flat, ends = {}, np.zeros(0, np.int32), np.zeros(1, np.int64)
                new = set().union(*rows) - ids.keys()
                if new:
                    own, more, sizes = vocabulary.coded_keys(new)
                    ids.update(zip(own, range(len(ids), len(ids) + len(own)), strict=True))
                    stops = ends[-1] + np.cumsum(sizes)
                    if len(flat) < ends[-1] + len(more):
                        flat = np.concatenate([flat[: ends[-1]], np.zeros(ends[-1] + 2 * len(more), np.int32)])  # room to grow, so not every slice copies
                    flat[ends[-1] : ends[-1] + len(more)] = more
                    ends = np.concatenate([ends, stops])
                at = np.fromiter(map(ids.__getitem__, chain.from_iterable(rows)), np.int64)
                counts = ends[at + 1] - ends[at]
                pieces = flat[np.repeat(ends[at] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]
                places = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum([len(r) for r in rows])])]
                columns = [batch.column(1 + k).slice(a, b - a) for k in range(len(keep))]
                columns += [pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(pieces)), pa.array(np.diff(places).astype(np.int64))]
                if check:
                    columns.append(pa.array([hashlib.sha256(vocabulary.decode(pieces[i:j].tolist()).encode()).hexdigest() for i, j in zip(places, places[1:], strict=False)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = StructType([*docs.select(*keep).schema.fields, StructField("ids", ArrayType(IntegerType())), StructField("n_tokens", LongType()), *([StructField("decoded_sha256", StringType())] if check else [])])
    return docs.select(F.col("text").alias("_text"), *keep).mapInArrow(tidied(run), schema)


def decode(coded: DataFrame, model: str = DEFAULT_MODEL, keep: list[str] | None = None) -> DataFrame:
    """The columns of coded (all but ids, or those to keep) with text, decoded from ids. Null ids give null."""
    vocabulary = PieceVocabulary.load(model)
    keep = [c for c in coded.columns if c != "ids"] if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x.as_py() is None else vocabulary.decode(x.as_py()) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], [*keep, "text"])

    return coded.select(F.col("ids").alias("_ids"), *keep).mapInArrow(tidied(run), StructType([*coded.select(*keep).schema.fields, StructField("text", StringType())]))
