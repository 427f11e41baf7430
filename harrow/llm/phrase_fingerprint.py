"""Lempel-Ziv phrase fingerprints: a text's dictionary phrases, hashed, of which the smallest hashes are kept.

A text is parsed from left to right: each phrase is the shortest string from there on that isn't in the dictionary
yet, and joins it. Two texts are as alike as their phrase sets overlap, which the smallest hashes estimate.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, powers, tidied

#: Hashes kept of a text, of 48 bits each.
KEPT = 96
#: Bytes of text that one task puts in order, and the most tasks whose bounds the driver holds.
TASK_BYTES, MOST_TASKS = 16 << 20, 20_000
_BASE = np.uint64(0xD6E8FEB86659FD93)


def phrase_ends(text: str, start: int = 0, seen: set[str] | None = None) -> list[int]:
    """The end of each phrase of text from start on; seen is the dictionary so far and is added to.

    The dictionary holds all beginnings of its phrases, so the length of the last phrase is a first guess
    from which to go up or down. A known rest at the end of the text adds no phrase.
    """
    seen = set() if seen is None else seen
    i, n, guess, ends = start, len(text), 1, []
    while i < n:
        j = i + guess
        if j > n:
            j = n
        if text[i:j] in seen:
            j += 1
            while j <= n and text[i:j] in seen:
                j += 1
            if j > n:
                break
        else:
            while j - 1 > i and text[i : j - 1] not in seen:
                j -= 1
        seen.add(text[i:j])
        ends.append(j)
        guess = j - i
        i = j
    return ends


def phrase_hashes(text: str, start: int, ends: list[int]) -> np.ndarray:
    """A 48-bit hash of each phrase that ends there, the first from start on."""
    if not ends:
        return np.zeros(0, np.uint64)
    stops = np.array(ends, np.int64)
    firsts = np.empty_like(stops)
    firsts[0], firsts[1:] = start, stops[:-1]
    points = np.frombuffer(text[start : ends[-1]].encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = stops - firsts
    place = np.arange(len(points)) - np.repeat(firsts - start, lengths)
    with np.errstate(over="ignore"):
        terms = mix(points + np.uint64(1)) * powers(_BASE, int(lengths.max()))[place]
        return mix(np.add.reduceat(terms, firsts - start)) >> np.uint64(16)


def smallest(hashes: np.ndarray, kept: int = KEPT) -> np.ndarray:
    if len(hashes) > 4 * kept:
        part = np.partition(hashes, 2 * kept)[: 2 * kept]
        found = np.unique(part)
        if len(found) >= kept:
            return found[:kept]
    return np.unique(hashes)[:kept]


def signature(text: str, kept: int = KEPT) -> np.ndarray:
    """The smallest phrase hashes of a text, ascending; none for the empty text."""
    return smallest(phrase_hashes(text, 0, phrase_ends(text)), kept)


def signature_string(hashes: np.ndarray) -> str:
    return base64.b64encode(hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> float:
    """The estimated share of common phrases, from the smallest hashes of both together; 1 if both are empty."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:kept]
    return float(np.isin(both, a).__and__(np.isin(both, b)).sum() / len(both))


def with_next(docs: DataFrame, task_bytes: int = TASK_BYTES) -> tuple[DataFrame, int]:
    """docs (doc_id, text) dealt out in ranges of doc_id, each in order and followed by the first document of the next range (guest).

    Only ids are read to find the ranges; the texts are shuffled once.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).filter("doc_id IS NOT NULL")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(min(MOST_TASKS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // task_bytes)))
    bounds = np.unique(np.array(docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0] or [], np.int64)) if n > 1 else np.zeros(0, np.int64)

    @F.pandas_udf("int")
    def chunk(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), "left").astype(np.int32))

    lows = sorted((r[0], r[1]) for r in docs.groupBy(chunk("doc_id").alias("chunk")).agg(F.min("doc_id")).collect())
    firsts = np.array([low for _, low in lows], np.int64)
    hosts = np.array([lows[i - 1][0] for i in range(len(lows))], np.int32)

    @F.pandas_udf("array<int>")
    def chunks(ids: pd.Series) -> pd.Series:
        ids = ids.to_numpy()
        own = np.searchsorted(bounds, ids, "left")
        at = np.searchsorted(firsts, ids).clip(0, len(firsts) - 1)
        return pd.Series([[int(c), int(hosts[k])] if firsts[k] == i else [int(c)] for c, k, i in zip(own, at, ids, strict=True)])

    rows = docs.select("doc_id", "text", F.posexplode(chunks("doc_id")).alias("guest", "chunk"))
    return rows.repartitionById(len(bounds) + 1, F.col("chunk")).sortWithinPartitions("guest", "doc_id", "text"), n


def compare_edits(docs: DataFrame, kept: int = KEPT) -> DataFrame:
    """For each row of docs (doc_id, text): n_chars, the SHA-256 of its edited text, both fingerprints, and how like the text is to the edited and to the next one.

    In the edited text the last quarter (rounded down) is replaced by as many first code points, or all, of the next text in
    ascending doc_id; the last document is followed by the first. Null texts are empty; an only document is its own next;
    rows of equal doc_id follow each other in the order of their texts; rows without a doc_id are left out.
    """
    ordered, _ = with_next(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        held = None
        for batch in batches:
            out: list[tuple] = []
            for i in range(batch.num_rows):
                text, guest = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                ends = phrase_ends(text)
                hashes = phrase_hashes(text, 0, ends)
                own = smallest(hashes, kept)
                if held is not None:
                    out.append(edited(*held, text, own))
                    if guest:
                        held = None
                        break
                held = None if guest else (batch.column(0)[i].as_py(), text, ends, hashes, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    def edited(doc_id, text, ends, hashes, own, follows, other):
        n = len(text)
        shared = n - n // 4
        changed = text[:shared] + follows[: n // 4]
        if changed == text:
            edit = own
        else:
            k = int(np.searchsorted(np.array(ends, np.int64), shared, "right"))
            start = ends[k - 1] if k else 0
            seen, i = set(), 0
            for j in ends[:k]:
                seen.add(text[i:j])
                i = j
            edit = smallest(np.concatenate([hashes[:k], phrase_hashes(changed, start, phrase_ends(changed, start, seen))]), kept)
        return doc_id, n, hashlib.sha256(changed.encode()).hexdigest(), signature_string(own), signature_string(edit), likeness(own, edit, kept), likeness(own, other, kept)

    return ordered.select("doc_id", "text", "guest").mapInArrow(tidied(run), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def fingerprints(docs: DataFrame, kept: int = KEPT) -> DataFrame:
    """(doc_id, fingerprint) of each row of docs (doc_id, text), without a shuffle. Null texts count as empty; equal texts have equal fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([signature_string(signature(t.as_py() or "", kept)) for t in batch.column(1)], pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(run), "doc_id long, fingerprint string")
