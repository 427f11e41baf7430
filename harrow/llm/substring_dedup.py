"""Exact substring deduplication over a log-structured index of window fingerprints.

A window is `window` consecutive words. Of each window the index keeps one fingerprint: the smallest hash
among the runs of `gram` words inside it, so equal windows always keep equal fingerprints and about a fifth
of all positions are kept. Each batch becomes one immutable run: a table bucketed and sorted by fingerprint.
A new run is merge-joined with the older ones bucket by bucket, without a shuffle (Spark sorts a bucket again, as it doesn't rely on
the order of its file); the documents that share a fingerprint are then verified by two independent hashes (95 bits) of all words of
the windows concerned. Runs are compacted when there are more than `fan_in` of one level. The list of runs is a table as well,
so a later session can go on with the index.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bit_filter, cuts, gram_hashes, joined_salted, overlapping, row_of, shared_dir, string_bytes, tidied, with_maybe, within_rows, word_hashes, words_of, written

TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over each `width` consecutive values (len - width + 1 of them)."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def _window_marks(words: np.ndarray, counts: np.ndarray, window: int, gram: int):
    """(grams, kept, lows, valid): gram hashes, which of them are fingerprints, each window's fingerprint, and which windows lie in one row."""
    grams = gram_hashes(words, gram)
    span = window - gram + 1
    valid = within_rows(counts, window, max(0, len(words) - window + 1))
    if not len(valid):
        return grams, np.zeros(len(grams), bool), np.zeros(0, np.uint64), valid
    grams = np.maximum(grams, np.uint64(1))
    lows = _sliding(grams, span, np.minimum)
    padded = np.zeros(len(grams) + span - 1, np.uint64)
    padded[span - 1 : span - 1 + len(lows)] = np.where(valid, lows, np.uint64(0))
    kept = _sliding(padded, span, np.maximum) == grams
    return grams, kept, lows, valid


def fingerprints(docs: DataFrame, window: int = 13, gram: int = 6) -> DataFrame:
    """The distinct (fp, doc_id) of each document; of one longer than a slice some come more than once. Null texts and texts of fewer words than a window have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = string_bytes(batch.column(1))
            for numbers, part, own, _ in overlapping(data, offsets, window - 1):
                starts, ends, counts = words_of(part, own)
                grams, kept, _, _ = _window_marks(word_hashes(part, starts, ends), counts, window, gram)
                at = np.flatnonzero(kept)
                rows, fps = row_of(counts)[at], grams[at]
                order = np.lexsort((fps, rows))
                rows, fps = rows[order], fps[order]
                new = np.ones(len(fps), bool)
                new[1:] = (fps[1:] != fps[:-1]) | (rows[1:] != rows[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(fps[new].view(np.int64)), pa.array(ids[numbers][rows[new]])], ["fp", "doc_id"])

    return docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id IS NOT NULL").mapInArrow(tidied(run), "fp long, doc_id long")


class FingerprintIndex:
    """Sorted immutable runs of (fp, doc_id), as bucketed tables of the session's warehouse.

    add() appends a batch as a run and returns which of its fingerprints, and of the older runs', are shared by
    different documents. compact() merges the runs of a level into one of the next. Rows without a doc_id are left out.
    The runs' names and levels are kept in the table <name>_runs: an index of that name that is there already is gone on with.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int | None = None, window: int = 13, gram: int = 6, fan_in: int = 4):
        self.spark, self.window, self.gram, self.fan_in = spark, window, gram, fan_in
        self.name = name or f"harrow_fp_{uuid.uuid4().hex}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[tuple[int, str]] = []  # (level, table), oldest first
        lists = sorted(t.name for t in spark.catalog.listTables(pattern=f"{self.name}_runs_*"))
        if lists:
            self.runs = [(r.level, r.run) for r in spark.table(lists[-1]).orderBy("at").collect()]
        self._lists = len(lists) and int(lists[-1].rsplit("_", 1)[1]) + 1

    def _write(self, rows: DataFrame) -> str:
        table = f"{self.name}_{uuid.uuid4().hex}"
        rows.repartition(self.buckets, "fp").write.bucketBy(self.buckets, "fp").sortBy("fp").format("parquet").saveAsTable(table)
        return table

    def _list(self, runs: list[tuple[int, str]]) -> None:
        """Makes `runs` the index: a new list is written before the old one goes, so one that is whole is always there."""
        rows = self.spark.createDataFrame([(at, level, run) for at, (level, run) in enumerate(runs)], "at int, level int, run string")
        rows.coalesce(1).write.format("parquet").saveAsTable(f"{self.name}_runs_{self._lists:09d}")
        if self._lists:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_runs_{self._lists - 1:09d}")
        self.runs, self._lists = runs, self._lists + 1

    def add(self, batch: DataFrame) -> DataFrame:
        """Adds the batch (doc_id, text) as a run; returns the (doc_id, fp) of this batch and of older runs
        whose fp occurs in two documents, one of them of the batch."""
        older = [t for _, t in self.runs]
        made = self._write(fingerprints(batch, self.window, self.gram))
        self._list([*self.runs, (0, made)])
        new = self.spark.table(made)
        spread = new.groupBy("fp").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        shared = new.join(spread.filter("low < high"), "fp", "left_semi")
        found = [shared]
        for table in older:
            run = self.spark.table(table)
            found += [new.join(run, "fp", "left_semi"), run.join(new, "fp", "left_semi")]
        out = found[0]
        for x in found[1:]:
            out = out.unionByName(x)
        return out.select("doc_id", "fp")

    def compact(self) -> None:
        """Merges the runs of each level that has more than fan_in of them; the merged runs' tables are dropped."""
        for level in sorted({n for n, _ in self.runs}):
            own = [t for n, t in self.runs if n == level]
            if len(own) > self.fan_in:
                rows = self.spark.table(own[0])
                for t in own[1:]:
                    rows = rows.unionByName(self.spark.table(t))
                merged = self._write(rows.distinct())
                self._list([(level + 1, merged), *(x for x in self.runs if x[1] not in own)])
                for t in own:
                    self.spark.sql(f"DROP TABLE IF EXISTS {t}")

    def drop(self) -> None:
        for _, t in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        if self._lists:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_runs_{self._lists - 1:09d}")
        self.runs, self._lists = [], 0


def _suspect_windows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(w, c, doc_id, var, at) of each window of docs (doc_id, text, fps, var) whose fingerprint is in the row's fps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = string_bytes(batch.column(1))
            lists = batch.column(2)
            ends_of = lists.offsets.to_numpy()
            fps = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            for numbers, part, own, before in overlapping(data, offsets, window - 1):
                a, b = int(numbers[0]), int(numbers[-1]) + 1
                starts, ends, counts = words_of(part, own)
                words = word_hashes(part, starts, ends)
                _, _, lows, valid = _window_marks(words, counts, window, gram)
                if not len(lows):
                    continue
                with np.errstate(over="ignore"):
                    salt = np.arange(b - a).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
                    rows = row_of(counts)[: len(lows)]
                    known = fps[ends_of[a] : ends_of[b]] ^ np.repeat(salt, np.diff(ends_of[a : b + 1]))
                    hit = np.flatnonzero(valid & np.isin(lows ^ salt[rows], known))
                w, c = gram_hashes(words, window, 1)[hit], gram_hashes(words, window, 2)[hit] >> np.uint64(33)
                rows = rows[hit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w.view(np.int64)), pa.array(c.astype(np.int32)), pa.array(ids[a:b][rows]), batch.column(3).take(pa.array(rows + a)), pa.array((hit - counts[rows] + before).astype(np.int32))],
                    ["w", "c", "doc_id", "var", "at"],
                )

    return docs.select("doc_id", "text", "fps", "var").mapInArrow(tidied(run), "w long, c int, doc_id long, var long, at int")


def _kept(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): docs (doc_id, text, starts, copy) without the words that a window from one of starts covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept = [], [], []
            for text, starts, copy in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                at = np.unique(starts.values.to_numpy(zero_copy_only=False)) if starts.is_valid else np.zeros(0, np.int64)
                n, left, parts = 0, 0, []
                for i, j in cuts(data):
                    words = data[i:j].tobytes().split()
                    place = np.arange(n, n + len(words))
                    n += len(words)
                    if len(at):  # the last start at or before a word covers it, or none does
                        last = np.searchsorted(at, place, "right") - 1
                        words = [words[k] for k in np.flatnonzero((last < 0) | (at[last] + window <= place))]
                    left += len(words)
                    parts += [b" ".join(words)] if words else []
                if copy.as_py() and n >= window:
                    left, parts = 0, []
                total.append(n)
                gone.append(n - left)
                kept.append(b" ".join(parts).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return docs.select("doc_id", "text", "starts", "copy").mapInArrow(tidied(run), "doc_id long, n_words long, n_removed long, kept string")


def remove_repeats(docs: DataFrame, shared: DataFrame, window: int = 13, gram: int = 6) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by one space) of each row of docs (doc_id, text).

    A word goes if a window that covers it also starts in a document with a smaller doc_id. shared: the (doc_id, fp)
    of documents that share a fingerprint, as FingerprintIndex.add() gives. Exact copies are found by SHA-256 first, so
    only one of them is verified window by window. Null and empty texts have no words; rows with equal doc_id are
    each judged against smaller ids only; rows without a doc_id are left out; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    folder = shared_dir(docs.sparkSession)
    # var tells the texts of a doc_id that has several rows apart; it is 0 for all others.
    several = written(bit_filter(docs.groupBy("doc_id").count().filter("count > 1"), "doc_id"), folder, "several")
    docs = with_maybe(docs, several, "doc_id", "_maybe").withColumn("var", F.when(F.col("_maybe"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))).drop("_maybe")
    variants = written(docs.filter("var <> 0").select("doc_id", "var").distinct(), folder, "variants")
    own = ["doc_id", "var"]
    digests = docs.select(*own, F.unhex(F.sha2("text", 256)).alias("digest")).filter("digest IS NOT NULL")
    groups = digests.groupBy("digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("_n")).filter("low < high").drop("high")
    copies = written(joined_salted(digests, written(groups, folder, "groups"), ["digest"], "doc_id").filter("doc_id > low").select(*own).distinct().withColumn("copy", F.lit(True)), folder, "copies")
    shared = shared.join(variants, "doc_id", "left").withColumn("var", F.coalesce("var", F.lit(0).cast("long")))
    by_doc = written(shared.groupBy(*own).agg(F.collect_set("fp").alias("fps")).join(copies, own, "left_anti"), folder, "by_doc")
    windows = _suspect_windows(docs.join(by_doc, own), window, gram)
    firsts = windows.groupBy("w", "c").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("_n")).filter("low < high").drop("high")
    starts = joined_salted(windows, written(firsts, folder, "firsts"), ["w", "c"], "doc_id").filter("doc_id > low").groupBy(*own).agg(F.collect_list("at").alias("starts"))
    return _kept(docs.join(starts, own, "left").join(copies, own, "left"), window)


def dedup_table(docs: DataFrame, batches: int = 4, window: int = 13, gram: int = 6, fan_in: int = 2) -> DataFrame:
    """remove_repeats over a whole table: it is taken in as batches of ascending doc_id, each merged against the runs before it, which are
    compacted when there are more than fan_in of one level. The index is dropped in the end; keep a FingerprintIndex of an own name to go on with it."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = docs.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("cuts")).first()["cuts"] or []
    edges = [None, *sorted(set(cuts)), None]
    index, folder, shared = FingerprintIndex(spark, window=window, gram=gram, fan_in=fan_in), shared_dir(spark), None
    try:
        for i, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
            batch = docs.filter("doc_id IS NOT NULL") if low is None else docs.filter(F.col("doc_id") > low)
            batch = batch if high is None else batch.filter(F.col("doc_id") <= high)
            found = written(index.add(batch), folder, f"shared{i}")
            shared = found if shared is None else shared.unionByName(found)
            index.compact()
    finally:
        index.drop()
    return remove_repeats(docs, shared, window, gram)


def kept_digest(kept: DataFrame) -> DataFrame:
    """The contract's columns of remove_repeats' rows."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


__all__ = ["FingerprintIndex", "dedup_table", "fingerprints", "kept_digest", "remove_repeats"]
