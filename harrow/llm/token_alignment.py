"""Alignment of two tokenizers' tokens over the same bytes.

A task tokenises a slice of texts and marks the byte offsets at which tokens end. The ends that both sides have cut the tokens into groups,
and all tokens of a group are linked; both are found for a slice at once, with sorts and sums over its arrays. How many documents hold a pair of
ids linked says which partner an id mostly has: Spark counts the pairs and joins the counts to each document's links.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import shared_dir, slices, string_bytes, tidied, written

#: Characters of a text tokenised at once.
PART_CHARS = 1 << 18
#: Most pairs of ids whose counts are broadcast; rarer ones are joined by a shuffle.
BROADCAST_PAIRS = 500_000
#: Words that a worker remembers, and the longest one (in characters).
REMEMBERED, LONGEST_REMEMBERED = 300_000, 64
#: Longest word (in characters) whose merges are applied by tiktoken, whose time grows faster than a word does.
LONGEST_RANKED = 400
#: What ranks don't tell: a word behind more than one space, spaces at the end, and words that are too long.
_APART = re.compile(f"( {{2,}}[^ ]*| ?[^ ]{{{LONGEST_RANKED + 1},}})")
#: A word with the spaces before it, or spaces at the end.
_WORD = re.compile(" *[^ ]+| +")
#: Where a long text may be parted: neither tokenizer has tokens with a space behind other characters.
_PART = re.compile("(?<=[A-Za-z,.;:!?]) (?=[A-Za-z])")


def default_models() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of_char() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes a byte: itself if it is visible, else the next one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def _ranked(pattern: str, ranks: dict[bytes, int]):
    """A tiktoken encoding. Its arrays of ids are only given where there is a special token, so it has one; texts are encoded with none allowed."""
    import tiktoken

    return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={"<|none|>": max(ranks.values()) + 1})


def piece_ranks(sp) -> dict[bytes, list[int]] | None:
    """Byte strings in the order in which they are merged, and the ids of each, if merging them gives the model's own ids for words behind one space.

    A merge model begins with characters and merges neighbours by score. So after the bytes come the beginnings of its characters of several bytes,
    which stand for bytes, then these characters, then its longer pieces. Runs of spaces are left out: their scores are equal, so they have no order.
    """
    try:
        from sentencepiece import sentencepiece_model_pb2 as proto
    except ImportError:
        return None
    model = proto.ModelProto.FromString(sp.serialized_model_proto())
    norm, kinds = model.normalizer_spec, proto.ModelProto.SentencePiece
    kind, text, score = ([getattr(p, name) for p in model.pieces] for name in ("type", "piece", "score"))
    plain = [i for i in range(len(kind)) if kind[i] == kinds.NORMAL]
    chars, longer = [i for i in plain if len(text[i]) == 1], sorted((i for i in plain if len(text[i]) > 1 and "▁▁" not in text[i]), key=lambda i: -score[i])
    if (
        model.trainer_spec.model_type != proto.TrainerSpec.BPE
        or norm.precompiled_charsmap
        or norm.remove_extra_whitespaces
        or not (norm.add_dummy_prefix and norm.escape_whitespaces)
        or model.trainer_spec.treat_whitespace_as_suffix
        or {kinds.USER_DEFINED, kinds.UNUSED} & set(kind)
        or kind.count(kinds.BYTE) != 256
        or any("▁" in t.lstrip("▁") for t in text)
        or {text[i] for i in chars} != {c for i in plain for c in text[i]}
        or len({score[i] for i in longer}) != len(longer)
    ):
        return None
    ids = {text[i].replace("▁", " ").encode(): i for i in plain}
    byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    beginnings = sorted({t[:k] for i in chars for t in [text[i].encode()] if text[i] != "▁" for k in range(2, len(t))}, key=len)
    order = [bytes([b]) for b in range(256)] + beginnings + [t for t in (text[i].encode() for i in chars if text[i] != "▁") if len(t) > 1] + [text[i].replace("▁", " ").encode() for i in longer]
    if any(sp.encode(t[1:].decode()) != [ids[t]] for t in order[256:] if t[:1] == b" "):  # a word that is a piece is looked up, not merged
        return None
    return {t: [ids[t]] if t in ids else [byte[b] for b in t] for t in order}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens; loaded in each worker from files that all of them have.

    Their merges have an order each, so both are tables of ranks, which tiktoken applies several times faster than the
    own libraries do; a byte-level model whose merges aren't numbered as its tokens are is left to tokenizers. A piece of the other never
    has a space behind another character, so its texts fall into words; those that ranks don't tell are left to sentencepiece and remembered.
    """

    def __init__(self, byte_model: str, piece_model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is all there is
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(byte_model)
        self.whole.encode_special_tokens = True
        with open(byte_model) as file:
            model = json.load(file)
        special, chars = {t["id"] for t in model["added_tokens"]}, byte_of_char()
        self.a_bytes = [b""] * (max(*model["model"]["vocab"].values(), *special, -1) + 1)
        for name, i in model["model"]["vocab"].items():
            self.a_bytes[i] = name.encode() if i in special else bytes(chars[c] for c in name)
        merged = [m if isinstance(m, str) else " ".join(m) for m in model["model"]["merges"]]
        self.as_ranks = [model["model"]["vocab"][m.replace(" ", "")] for m in merged] == list(range(256, 256 + len(merged)))
        self.a = _ranked(public_tokenizers.PATTERN, {t: i for i, t in enumerate(self.a_bytes) if t and i not in special}) if self.as_ranks else None
        self.b = sp = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.by_words = not any("▁" in p.lstrip("▁") for p in pieces)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        ranks = piece_ranks(sp)
        self.ranked = _ranked(" ?[^ ]+| ", {t: k for k, t in enumerate(ranks)}) if ranks else None
        if ranks:
            self.rank_size, self.rank_ids = np.array([len(ids) for ids in ranks.values()]), np.array([i for ids in ranks.values() for i in ids], np.int32)
            self.rank_first = np.cumsum(self.rank_size) - self.rank_size
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in tokens], np.int32) for tokens in (self.a_bytes, self.b_bytes))
        #: Each id with what may follow it: first A's with a comma, with a bar, then B's with a comma, with a semicolon.
        self.names = np.array([f"{i}{sign}" for side, signs in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for sign in signs for i in range(len(side))], "S")
        self.words: dict[str, bytes | None] = {}

    def a_ids(self, text: str) -> np.ndarray | None:
        if self.a is None:
            ids = self.whole.encode(text, add_special_tokens=False).ids
            return np.array(ids, np.int32) if b"".join(map(self.a_bytes.__getitem__, ids)) == text.encode() else None
        ids = self.a.encode_to_numpy(text, disallowed_special=()).view(np.int32)
        return ids if self.a_sizes[ids].sum() == len(text.encode()) else None  # tokens are parts of the text in order, so nothing is left out

    def word(self, word: str) -> bytes | None:
        """The ids of a word with the spaces before it, if they spell it; the tokenizer adds the first space itself, but for an empty text."""
        ids = self.b.encode(word[1:], num_threads=1) if len(word) > 1 else [self.b.piece_to_id("▁")]
        code = pack(f"<{len(ids)}i", *ids) if b"".join(map(self.b_bytes.__getitem__, ids)) == word.encode() else None
        if len(word) <= LONGEST_REMEMBERED:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[word] = code
        return code

    def by_word(self, text: str) -> np.ndarray | None:
        """The ids of a space and more, word by word if words are apart."""
        known, own = self.words, self.word
        codes = [known.get(w) or own(w) for w in (_WORD.findall(text) if self.by_words else [text])]
        return None if None in codes else np.frombuffer(b"".join(codes), np.int32)

    def by_rank(self, text: str) -> np.ndarray:
        ranks = self.ranked.encode_to_numpy(text, disallowed_special=())
        sizes = self.rank_size[ranks]
        ends = np.cumsum(sizes)
        first = self.rank_first[ranks]
        return self.rank_ids[first if ends[-1] == len(ends) else np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1])]

    def b_ids(self, text: str) -> np.ndarray | None:
        text = " " + text
        if self.ranked is None or "▁" in text:  # a mark of the text's own is taken for a space
            return self.by_word(text)
        if "  " not in text and max(map(len, text.split(" "))) <= LONGEST_RANKED:
            return self.by_rank(text)
        parts = [(self.by_word if k % 2 else self.by_rank)(part) for k, part in enumerate(_APART.split(text)) if part]
        return None if any(p is None for p in parts) else np.concatenate(parts)

    def of(self, text: str) -> tuple[np.ndarray, ...] | None:
        """Of both sides over a space and the text: ids, ends (the byte behind each token) and cuts (how many tokens lie before each end that both
        have); None if a side's tokens don't spell it. A long text is parted at spaces that both sides part at."""
        sides: tuple[list, list] = ([], [])
        at = 0
        while at < len(text):
            cut = _PART.search(text, at + PART_CHARS) if self.by_words and len(text) - at > PART_CHARS else None
            part = text[at : cut.start() if cut else len(text)]
            for side, ids in zip(sides, (self.a_ids(" " + part), self.b_ids(part)), strict=True):
                if ids is None:
                    return None
                side.append(ids)
            at += len(part) + 1
        ids = [np.concatenate(side) if side else np.zeros(0, np.int32) for side in sides]
        ends = [np.cumsum(sizes[own], dtype=np.int32) for own, sizes in zip(ids, (self.a_sizes, self.b_sizes), strict=True)]
        is_end = np.zeros((2, int(ends[0][-1]) + 1 if len(ends[0]) else 1), bool)
        for k in (0, 1):
            is_end[k, ends[k]] = True
        cuts = [np.flatnonzero(is_end[1 - k, ends[k]]) + 1 for k in (0, 1)]
        return ids[0], ends[0], cuts[0], ids[1], ends[1], cuts[1]


_loaded: dict[tuple[str, str], Tokenizers] = {}


_NONE = (np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int64)) * 2
_COLUMNS = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string", "links": "array<struct<pair:long,n:long>>", "groups": "array<struct<a:array<int>,b:array<int>,pair:long>>"}


def grouped(docs: DataFrame, keep: list[str] = ("doc_id",), models: tuple[str, str] | None = None, groups: bool = True) -> DataFrame:
    """keep and of each document's text n_a, n_b, n_groups, n_links, groups_sha256 (the digest of `a1,a2|b1;a3|b2,b3`, the ids of each group), links (each
    pair of ids that a group links, once, array<struct<pair long, n long>> with n for how often) and, if asked for, the groups, array<struct<a array<int>,
    b array<int>, pair long>> with the pair of a group of one token a side. Nothing of null, empty or differently spelt texts."""
    models, keep = tuple(models or default_models()), list(keep)
    names = [c for c in _COLUMNS if groups or c != "groups"]
    rows = docs.select(*keep, F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if models not in _loaded:
            _loaded[models] = Tokenizers(*models)
        both = _loaded[models]
        for batch in batches:
            for a, b in slices(string_bytes(batch.column(len(keep)))[1]):
                own = batch.slice(a, b - a)
                columns = _aligned(both, [(text and both.of(text)) or _NONE for text in own.column(len(keep)).to_pylist()], groups)
                yield pa.RecordBatch.from_arrays([*own.columns[: len(keep)], *columns], [*keep, *names])

    return rows.mapInArrow(tidied(run), StructType([*rows.drop("_text").schema.fields, *StructType.fromDDL(", ".join(f"{c} {_COLUMNS[c]}" for c in names)).fields]))


def _aligned(both: Tokenizers, coded: list[tuple[np.ndarray, ...]], groups: bool) -> list[pa.Array]:
    """The columns that grouped() gives, of texts tokenised by of(). Both sides spell the same bytes, so their last ends are equal and every token is in a
    group; without tokens there are no groups."""
    n_a, n_b, n_groups = (np.array([len(c[k]) for c in coded], np.int64) for k in (0, 3, 2))
    a, b = (np.concatenate([c[k] for c in coded]).astype(np.int64) for k in (0, 3))
    a_to, b_to = (np.concatenate([c[k] for c in coded]) + np.repeat(np.cumsum(n) - n, n_groups) for k, n in ((2, n_a), (5, n_b)))
    in_a, in_b = np.diff(a_to, prepend=0), np.diff(b_to, prepend=0)
    row = np.repeat(np.arange(len(coded)), n_groups)
    upto = np.concatenate([[0], np.cumsum(in_a * in_b)])[np.concatenate([[0], np.cumsum(n_groups)])]

    many_a, many_b = len(both.a_bytes), len(both.b_bytes)
    a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
    a_last[a_to - 1], b_last[b_to - 1] = True, True
    name = np.empty(len(a) + len(b), np.int64)
    name[np.arange(len(a)) + np.repeat(b_to - in_b, in_a)] = a + many_a * a_last
    name[np.arange(len(b)) + np.repeat(a_to, in_b)] = b + 2 * many_a + many_b * b_last
    written_ids, stops = both.names[name], np.cumsum(n_a + n_b)
    digests = [hashlib.sha256(written_ids[x:y].tobytes().translate(None, b"\0")[:-1]).hexdigest() if x < y else "" for x, y in zip([0, *stops], stops, strict=False)]

    one = (in_a == 1) & (in_b == 1)
    key = lambda row, a, b: (row * many_a + a) * many_b + b
    (a_first, a_kinds, a_ids, a_times), (b_first, b_kinds, b_ids, b_times) = (_kinds(ids[np.repeat(~one, n)], n[~one], many) for ids, n, many in ((a, in_a, many_a), (b, in_b, many_b)))
    size = a_kinds * b_kinds
    group, at = np.repeat(np.arange(len(size)), size), np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    i, j = a_first[group] + at // b_kinds[group], b_first[group] + at % b_kinds[group]
    others, times = key(row[~one][group], a_ids[i], b_ids[j]), a_times[i] * b_times[j]
    found, n = np.unique(np.concatenate([key(row[one], a[a_to[one] - 1], b[b_to[one] - 1]), others]), return_counts=True)
    np.add.at(n, np.searchsorted(found, others[times > 1]), times[times > 1] - 1)
    offsets = np.searchsorted(found, np.arange(len(coded) + 1) * (many_a * many_b))
    links = pa.StructArray.from_arrays([pa.array((found // many_b % many_a) << 32 | found % many_b), pa.array(n)], ["pair", "n"])
    out = [pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(np.diff(upto)), pa.array(digests, pa.string()), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), links)]
    if groups:
        pair = pa.array(a[a_to - 1] << 32 | b[b_to - 1], mask=~one)
        sides = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], to]).astype(np.int32)), pa.array(ids.astype(np.int32))) for to, ids in ((a_to, a), (b_to, b))]
        out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_groups)]).astype(np.int32)), pa.StructArray.from_arrays([*sides, pair], ["a", "b", "pair"])))
    return out


def _kinds(ids: np.ndarray, sizes: np.ndarray, many: int) -> tuple[np.ndarray, ...]:
    """Of groups of so many ids each: where the distinct ids of each begin, how many they are; these ids, how often each is there. An id that a group
    repeats is taken once there, so a long group without common ends stays small."""
    keys, times = np.unique(np.repeat(np.arange(len(sizes)), sizes) * many + ids, return_counts=True)
    kinds = np.bincount(keys // many, minlength=len(sizes))
    return np.cumsum(kinds) - kinds, kinds, keys % many, times


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, count, best) of rows with the links of grouped(): how many rows link the pair, and whether no pair with its first id is linked by more."""
    counts = links.select(F.explode("links.pair").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    highest = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))  # a window holds at most as many rows as the other side has ids
    return counts.select("pair", "count", (F.col("count") == highest).alias("best"))


def align(docs: DataFrame, keep: list[str] = ("doc_id",), models: tuple[str, str] | None = None, groups: bool = True) -> DataFrame:
    """keep, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, if asked for, the groups of each row of docs.

    A pair's count is the number of rows that hold it linked, each row being a document, repeated ones too; n_best counts the links whose count
    is the highest of their first id, ties included, count_sum sums the counts over the links. Texts null, empty or spelt differently by a side
    have no tokens: zeros, no groups and an empty groups_sha256.

    Rows with groups and links are a written table. Pairs in many documents, of which there are at most BROADCAST_PAIRS, are broadcast with
    their counts, so a pair that is everywhere isn't shuffled; the bound for "many" rises with the number of pairs. Rarer ones are joined by shuffle.
    """
    folder = shared_dir(docs.sparkSession)
    keep = list(keep)
    rows = grouped(docs.select(*(F.col(c).alias(f"_{k}") for k, c in enumerate(keep)), "text"), [f"_{k}" for k in range(len(keep))], models, groups)
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), folder, "groups")
    counts = written(pair_counts(rows), folder, "pairs")

    sizes = {r.power: r.n for r in counts.groupBy(F.floor(F.log2("count")).cast("int").alias("power")).agg(F.count("*").alias("n")).collect()}  # at most 64 rows
    power, held = 64, 0
    while power and held + sizes.get(power - 1, 0) <= BROADCAST_PAIRS:
        power -= 1
        held += sizes.get(power, 0)
    many = F.col("count") >= F.lit(1 << min(power, 62))
    links = rows.select("_row", F.inline("links"))
    found = links.join(F.broadcast(counts.filter(many)), "pair")
    if power:
        rest = links.join(F.broadcast(counts.filter(many).select("pair")), "pair", "left_anti").join(counts.filter(~many), "pair")
        found = found.unionByName(rest.select(found.columns))
    sums = found.groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("count") * F.col("n")).alias("count_sum"))
    out = rows.drop("links").join(sums, "_row", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(*(F.col(f"_{k}").alias(c) for k, c in enumerate(keep)), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256", *["groups"] * groups)
