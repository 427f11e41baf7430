"""Line deduplication by content-defined chunks of lines.

A text's lines are hashed; where a rolling hash over the last few line hashes meets a condition, a chunk ends. So equal
passages are cut alike wherever they stand. Chunks of at least two lines that occur before (in a smaller doc_id, or
earlier in the text) are removed, after their bytes were compared. That finds a passage only where chunks happen to fall
inside it, so remove_passages() takes every two lines that follow each other instead and misses none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, SLICE_BYTES, bit_filter, cuts, joined_salted, mix, powers, shared_dir, slices, string_bytes, tidied, with_maybe, written

#: Lines that the rolling hash spans, one in how many lines ends a chunk, and the most lines of a chunk.
SPAN, ONE_IN, MOST_LINES = 2, 4, 32
_BASE = np.uint64(0xD6E8FEB86659FD93)
_SPACES = " \t\n\v\f\r"
IS_FEED = np.arange(256) == 10


def line_ends(data: np.ndarray) -> np.ndarray:
    """The end of each line of one text, its line feed included."""
    ends = np.flatnonzero(data == 10) + 1
    return ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def _hashes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    firsts = np.concatenate([[0], ends[:-1]])
    with np.errstate(over="ignore"):
        lengths = ends - firsts
        place = np.arange(len(data)) - np.repeat(firsts, lengths)
        terms = (data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, int(lengths.max()))[place]
        return mix(np.add.reduceat(terms, firsts))


def chunk_lines(hashes: np.ndarray) -> list[int]:
    """The line after the last of each chunk. A chunk ends where the hash of the last SPAN lines is divisible by ONE_IN, but not with
    its first line, and with its MOST_LINES-th line at the latest; a single line left at the end joins the chunk before it."""
    with np.errstate(over="ignore"):
        rolled = hashes.copy()
        for k in range(1, SPAN):
            rolled[k:] = rolled[k:] * _BASE + hashes[:-k]
    marks = mix(rolled) % np.uint64(ONE_IN) == 0
    out, first = [], 0
    for i, mark in enumerate(marks.tolist(), 1):
        if i - first >= 2 and (mark or i - first >= MOST_LINES):
            out.append(i)
            first = i
    if first < len(hashes):
        if out and len(hashes) - first == 1:
            out[-1] = len(hashes)
        else:
            out.append(len(hashes))
    return out


def chunk_ends(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends, lines): where each chunk of one text ends, and how many lines it has."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = line_ends(data)
    cuts = np.array(chunk_lines(_hashes(data, ends)))
    return ends[cuts - 1], np.diff(cuts, prepend=0)


def chunks(docs: DataFrame, with_text: bool) -> DataFrame:
    """(doc_id, at, hash) of each chunk of two lines or more, and its text if asked for; at: its number in its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_bytes(batch.column(1))
            for a, b in slices(offsets):
                rows, places, hashes, texts = [], [], [], []
                for i in range(a, b):
                    own = data[offsets[i] : offsets[i + 1]]
                    ends, lines = chunk_ends(own)
                    many = np.flatnonzero(lines > 1)
                    if not len(many):
                        continue
                    rows.append(np.full(len(many), i))
                    places.append(many)
                    hashes.append(_hashes(own, ends)[many])
                    if with_text:
                        raw = own.tobytes()
                        texts += [raw[ends[k - 1] if k else 0 : ends[k]].decode() for k in many]
                if rows:
                    columns = [batch.column(0).take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(hashes).view(np.int64))]
                    yield pa.RecordBatch.from_arrays([*columns, *([pa.array(texts, pa.string())] if with_text else [])], ["doc_id", "at", "hash", *(["chunk"] if with_text else [])])

    return docs.select("doc_id", "text").mapInArrow(tidied(run), "doc_id long, at int, hash long" + (", chunk string" if with_text else ""))


def repeated_chunks(docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, at) of every chunk whose bytes stand in a smaller doc_id or earlier in its own text.

    Only hashes are gathered at first; the texts of chunks whose hash repeats are then grouped by their bytes.
    """
    place = F.struct("doc_id", "at")
    groups = written(chunks(docs, False).groupBy("hash").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter("low < high").select("hash"), folder, "hashes")
    likely = with_maybe(chunks(docs, True), bit_filter(groups, "hash"), "hash", "maybe").filter("maybe").drop("maybe")
    suspects = written(likely.join(groups, "hash", "left_semi"), folder, "suspects")
    firsts = suspects.groupBy("hash", "chunk").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count("*").alias("_n")).filter("low < high").select("hash", "chunk", "low", "_n")
    return joined_salted(suspects, written(firsts, folder, "firsts"), ["hash", "chunk"], "doc_id").filter(place > F.col("low")).select("doc_id", "at")


def remove_repeats(docs: DataFrame, removed: str = "n_removed") -> DataFrame:
    """docs (doc_id, text and any others) with the chunks removed from text, and the number of bytes that went as the column `removed`, which replaces one of that name.

    A document keeps its row even if nothing of its text is left. Null texts stay null; single lines are never removed; rows
    of equal doc_id are treated as one document's (a chunk of the one counts as repeated in the other only if its number is
    larger); rows without a doc_id keep their texts.
    """
    folder = shared_dir(docs.sparkSession)
    own = docs.withColumn("_id", F.col("doc_id").cast("long"))
    gone = repeated_chunks(own.filter("_id IS NOT NULL").select(F.col("_id").alias("doc_id"), "text"), folder).groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("at").alias("_gone"))
    gone = written(gone, folder, "gone")

    def without(text: str | None, gone: list[int]) -> str | None:
        if text is None:
            return None
        data = np.frombuffer(text.encode(), np.uint8)
        raw, keep, first, gone = data.tobytes(), [], 0, set(gone)
        for k, end in enumerate(chunk_ends(data)[0].tolist()):
            if k not in gone:
                keep.append(raw[first:end])
            first = end
        return b"".join(keep).decode()

    @F.arrow_udf("string")
    def cut(texts: pa.Array, gone: pa.Array) -> pa.Array:
        return pa.array([without(t.as_py(), g.as_py() or []) for t, g in zip(texts, gone, strict=True)], pa.string())

    # Documents that lose nothing are neither shuffled nor sent to Python.
    marked = with_maybe(own, bit_filter(gone, "_id"), "_id", "_hit")
    joined = marked.filter("_hit").join(gone, "_id", "left").withColumn("_cut", cut(F.when(F.col("_gone").isNotNull(), F.col("text")), "_gone"))
    joined = joined.withColumn("_text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.col("_cut"))).drop("_gone", "_cut")
    rows = joined.unionByName(marked.filter("NOT _hit").withColumn("_text", F.col("text")))
    gone_bytes = (F.coalesce(F.octet_length("text"), F.lit(0)) - F.coalesce(F.octet_length("_text"), F.lit(0))).cast("long")
    return rows.select(*[F.col("_text").alias("text") if c == "text" else F.col(c) for c in docs.columns if c != removed], gone_bytes.alias(removed))


def _line_stretches(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, bytes, offsets, lines before) of pieces of bounded size: whole rows, or of a longer row a part that ends with a line and begins
    with the last line with words of the part before, so that each two lines that follow each other lie whole in a part."""
    for a, b in slices(offsets):
        own = data[offsets[a] : offsets[b]]
        if b - a > 1 or len(own) <= SLICE_BYTES:
            yield a, own, offsets[a : b + 1] - offsets[a], 0
            continue
        first, before = 0, 0
        for _, j in cuts(own, stops=IS_FEED):
            part = own[first:j]
            yield a, part, np.array([0, len(part)]), before
            starts = np.concatenate([[0], np.flatnonzero(part == 10) + 1])
            starts = starts[starts < len(part)]
            filled = np.flatnonzero(np.add.reduceat(~IS_SPACE[part], starts, dtype=np.int64))
            if len(filled):
                before += int(filled[-1])
                first += int(starts[filled[-1]])


def line_pairs(docs: DataFrame, with_text: bool) -> DataFrame:
    """(doc_id, copy, at, hash) of each two lines with words that follow each other, and their bytes if asked for; at: the number of the first in its text.

    Blank lines aren't counted but belong to the pair that they stand in. A last line without a line feed equals one with it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_bytes(batch.column(2))
            for a, own, bounds, before in _line_stretches(data, offsets):
                if not len(own):
                    continue
                open_end = (np.diff(bounds) > 0) & (own[bounds[1:] - 1] != 10)
                own = np.insert(own, bounds[1:][open_end], 10)
                bounds = bounds + np.concatenate([[0], np.cumsum(open_end)])
                ends = np.flatnonzero(own == 10) + 1
                starts = np.concatenate([[0], ends[:-1]])
                rows = np.searchsorted(bounds[1:], starts, "right")
                places = np.arange(len(ends)) - np.searchsorted(starts, bounds[:-1])[rows]
                filled = np.flatnonzero(np.add.reduceat(~IS_SPACE[own], starts, dtype=np.int64))
                one, two = filled[:-1], filled[1:]
                same = rows[one] == rows[two]
                one, two = one[same], two[same]
                if not len(one):
                    continue
                with np.errstate(over="ignore"):
                    hashes = _hashes(own, ends)
                    hashes = mix(hashes[one] * _BASE + hashes[two])
                at = pa.array(rows[one] + a)
                columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array((places[one] + before).astype(np.int32)), pa.array(hashes.view(np.int64))]
                if with_text:
                    raw = own.tobytes()
                    columns.append(pa.array([raw[i:j] for i, j in zip(starts[one].tolist(), ends[two].tolist(), strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "copy", "at", "hash", *(["pair"] if with_text else [])])

    return docs.select("doc_id", "copy", "text").mapInArrow(tidied(run), "doc_id long, copy long, at int, hash long" + (", pair binary" if with_text else ""))


def repeated_pairs(docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, copy, at) of every line pair whose bytes stand in an earlier text, or wholly before it in its own.

    As in repeated_chunks(), only hashes are gathered at first. Texts are ordered by doc_id, those of one doc_id by their hash.
    """
    place = F.struct("doc_id", "copy", "at")
    groups = written(line_pairs(docs, False).groupBy("hash").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter("low < high").select("hash"), folder, "hashes")
    likely = with_maybe(line_pairs(docs, True), bit_filter(groups, "hash"), "hash", "maybe").filter("maybe").drop("maybe")
    suspects = written(likely.join(groups, "hash", "left_semi"), folder, "suspects")
    firsts = suspects.groupBy("hash", "pair").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count("*").alias("_n")).filter("low < high").select("hash", "pair", "low", "_n")
    other = (F.col("doc_id") != F.col("low.doc_id")) | (F.col("copy") != F.col("low.copy"))
    # Pairs of one text may overlap ("a a a"): the first one's own lines aren't its copies.
    return joined_salted(suspects, written(firsts, folder, "firsts"), ["hash", "pair"], "doc_id").filter(other | (F.col("at") > F.col("low.at") + 1)).select("doc_id", "copy", "at")


def remove_passages(docs: DataFrame, removed: str = "n_removed") -> DataFrame:
    """docs as remove_repeats() gives them, but without every passage of two lines or more that stands before, whatever surrounds it.

    Each removed line is still there, in the kept text of an earlier place. Rows of equal doc_id and text are treated as one
    document's; those of equal doc_id and other texts as different documents.
    """
    folder = shared_dir(docs.sparkSession)
    own = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_copy": F.xxhash64("text")})
    gone = repeated_pairs(own.filter("_id IS NOT NULL").select(F.col("_id").alias("doc_id"), F.col("_copy").alias("copy"), "text"), folder)
    gone = written(gone.groupBy(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")).agg(F.collect_set("at").alias("_gone")), folder, "gone")

    def without(text: str | None, gone: list[int]) -> str | None:
        if text is None:
            return None
        lines, starts, out, last = text.split("\n"), set(gone), [], False
        lines = [x + "\n" for x in lines[:-1]] + lines[-1:]
        for i, line in enumerate(lines):
            if i in starts:
                last = True
                continue
            if last and not any(b not in _SPACES for b in line):
                continue  # a blank line inside a pair
            if not last:
                out.append(line)
            last = False
        return "".join(out)

    @F.arrow_udf("string")
    def cut(texts: pa.Array, gone: pa.Array) -> pa.Array:
        return pa.array([without(t.as_py(), g.as_py() or []) for t, g in zip(texts, gone, strict=True)], pa.string())

    # Documents that lose nothing are neither shuffled nor sent to Python.
    marked = with_maybe(own, bit_filter(gone, "_id"), "_id", "_hit")
    joined = marked.filter("_hit").join(gone, ["_id", "_copy"], "left").withColumn("_cut", cut(F.when(F.col("_gone").isNotNull(), F.col("text")), "_gone"))
    joined = joined.withColumn("_text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.col("_cut"))).drop("_gone", "_cut")
    rows = joined.unionByName(marked.filter("NOT _hit").withColumn("_text", F.col("text")))
    gone_bytes = (F.coalesce(F.octet_length("text"), F.lit(0)) - F.coalesce(F.octet_length("_text"), F.lit(0))).cast("long")
    return rows.select(*[F.col("_text").alias("text") if c == "text" else F.col(c) for c in docs.columns if c != removed], gone_bytes.alias(removed))
