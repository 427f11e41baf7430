"""Helpers that the corpus operators share: the shared work folder, and vectorised hashing of words inside tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.sources.shared import shared_folder

#: Bytes of text that a task hashes at once; numpy needs about forty times as much for it.
SLICE_BYTES = 1 << 18
#: The bytes that part words: space and the controls 9 to 13.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Rows of a batch that a task hands to Python at once; Spark's default of 10 000 long texts takes much memory on either side.
BATCH_ROWS = 500
#: Rows of one key above which the key is dealt over SALTS parts in joined_salted().
HOT_ROWS, SALTS = 1024, 64
#: 64-bit words of a bit filter (4 MB).
FILTER_WORDS = 1 << 19

_R1 = np.uint64(0x9E3779B97F4A7C15)
_R2 = np.uint64(0xD6E8FEB86659FD93)


def shared_dir(spark: SparkSession) -> str:
    """A new folder in the one that the cluster names in spark.checkpoint.dir; where it is unset, a local session gets a temporary one, any other an error."""
    return shared_folder(spark)


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """df as a Parquet table in a shared folder: read again, it has no lineage that a lost executor could break."""
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(max(n, 1), base, np.uint64))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets into them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes each, and at least one row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to


def stretches(data: np.ndarray, offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row numbers, bytes, offsets) of pieces of about `most` bytes: several whole rows each, or a part of one row that is longer.

    Such a row is cut at its last space within each `most` bytes from the cut before, so always alike; a word longer than that stays whole.
    """
    for a, b in slices(offsets, most):
        own = data[offsets[a] : offsets[b]]
        if len(own) <= most or b - a > 1:
            yield np.arange(a, b), own, offsets[a : b + 1] - offsets[a]
            continue
        for i, j in cuts(own, most):
            yield np.array([a]), own[i:j], np.array([0, j - i])


def overlapping(data: np.ndarray, offsets: np.ndarray, overlap: int, most: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """As stretches(), but a later part of a long row begins `overlap` words before its cut, so that every run of overlap + 1 words lies whole
    in a part; and how many words of its row stand before the part."""
    for a, b in slices(offsets, most):
        own = data[offsets[a] : offsets[b]]
        if len(own) <= most or b - a > 1:
            yield np.arange(a, b), own, offsets[a : b + 1] - offsets[a], 0
            continue
        first, before = 0, 0
        for _, j in cuts(own, most):
            part = own[first:j]
            yield np.array([a]), part, np.array([0, len(part)]), before
            starts = words_of(part, np.array([0, len(part)]))[0]
            k = max(0, len(starts) - overlap)
            before += k
            first = first + int(starts[k]) if k < len(starts) else j


def cuts(text: np.ndarray, most: int = SLICE_BYTES, stops: np.ndarray = IS_SPACE) -> Iterator[tuple[int, int]]:
    """The stretches of a long text: each ends behind its last space (or other stop) within `most` bytes, or behind the next one if there is none."""
    at = 0
    while at < len(text):
        to = min(at + most, len(text))
        if to < len(text):
            spaces = np.flatnonzero(stops[text[at:to]])
            if len(spaces):
                to = at + int(spaces[-1]) + 1
            else:
                while to < len(text) and not stops[text[to - 1]]:
                    after = np.flatnonzero(stops[text[to : to + most]])
                    to = to + int(after[0]) + 1 if len(after) else min(to + most, len(text))
        yield at, to
        at = to


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in data, and for each row the number of words before it (n + 1 values)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = IS_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, space[1:]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        terms = (data[np.repeat(starts, lengths) + place].astype(np.uint64) + np.uint64(1)) * powers(_R2, int(lengths.max()))[place]
        return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64) * _R1)


def gram_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each k consecutive words (n - k + 1 values, none if n < k); rows are not told apart."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        own = words if not seed else mix(words + np.uint64(seed) * _R1)
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total = total * _R1 + own[j : j + n]
        return mix(total)


def within_rows(counts: np.ndarray, k: int, n: int) -> np.ndarray:
    """For each of the first n positions, whether k words that start there lie in one row. counts: as words_of gives."""
    row_end = np.repeat(counts[1:], np.diff(counts))[:n]
    return np.arange(n) + k <= row_end


def row_of(counts: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(counts) - 1), np.diff(counts))


def bit_filter(keys: DataFrame, key: str) -> DataFrame:
    """(word, bits): a bit set for each key's hash, in FILTER_WORDS words of 64 bits at most. Keys that aren't there mostly find their bit
    unset. However many keys there are, the table has no more rows; with very many all bits are set and nothing is filtered."""
    bit = F.pmod(F.xxhash64(key), F.lit(64 * FILTER_WORDS))
    return keys.select(bit.alias("b")).groupBy(F.expr("b div 64").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("_bits"))


def with_maybe(rows: DataFrame, table: DataFrame, key: str, name: str) -> DataFrame:
    """rows with a boolean: whether the key's bit is set in a bit_filter(). That table is broadcast: its size has a fixed bound."""
    bit = F.pmod(F.xxhash64(key), F.lit(64 * FILTER_WORDS))
    placed = rows.withColumns({"_word": F.floor(bit / 64), "_at": (bit % 64).cast("int")})
    hit = F.coalesce(F.expr("shiftright(_bits, _at) & 1L") == 1, F.lit(False))
    return placed.join(F.broadcast(table), "_word", "left").withColumn(name, hit).drop("_word", "_at", "_bits")


def joined_salted(rows: DataFrame, keys: DataFrame, on: list[str], by: str) -> DataFrame:
    """rows.join(keys, on), where keys (a written table, one row per key) has the number of each key's rows as _n, which is dropped.

    Keys of more than HOT_ROWS rows are dealt over SALTS parts by the column `by` of rows, so that none lands in one task.
    """
    hot = bit_filter(keys.filter(F.col("_n") > HOT_ROWS), on[0])
    salt = F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")
    left = with_maybe(rows, hot, on[0], "_hot").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0)).drop("_hot")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return left.join(with_maybe(keys.drop("_n"), hot, on[0], "_hot").withColumn("_salt", F.explode(salts)).drop("_hot"), [*on, "_salt"]).drop("_salt")


def small_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batches to BATCH_ROWS rows, if they are larger. The queries and stages call it, so it stays in force for the
    session; operators used on their own don't change the session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def tidied(run: Callable) -> Callable:
    """A task's function that gives memory back to the system when it is done: Python workers live on and serve other tasks."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return whole
