"""Jaccard similarity join of documents on their word n-grams, with prefix, length, positional and suffix filters.

The n-grams of a document are put in one global order, rare before frequent: two sets as alike as asked for must share
one of their first few (the prefix). Exact copies of a set are one entry. Prefix rows of the same n-gram meet in two
steps, so that a group of near copies is never expanded into all its pairs: first every row meets the smallest entry of its
n-gram, and the links found are joined into components; then all rows of an n-gram meet that are still in different
components. Both steps apply the length, positional and suffix filters, and verify each pair once on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, bit_filter, gram_hashes, joined_salted, mix, overlapping, row_of, shared_dir, slices, string_bytes, tidied, within_rows, word_hashes, words_of, with_maybe, written
from .components import connected_components

#: N-grams in more prefixes than this are frequent; the most of them that are sent to every task (16 MB).
FREQUENT, MOST_SENT = 12, 2_000_000
#: Rows of one n-gram that are compared with each other in one go: larger groups are cut into blocks, each pair of which is a group of its own.
BLOCK_ROWS, CROWD = 1024, 64
#: Parts that the suffix filter divides a set into by hash.
PARTS = 64


def _lower(data: np.ndarray) -> np.ndarray:
    out = data.copy()
    capital = (out >= 65) & (out <= 90)
    out[capital] += 32
    return out


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): the distinct n-gram hashes of each row in ascending order, one row after the other; ends has n + 1 values."""
    low = _lower(data)
    starts, ends, counts = words_of(low, offsets)
    words = word_hashes(low, starts, ends)
    sizes = np.diff(counts)
    grams = gram_hashes(words, n, 3)
    at = np.flatnonzero(within_rows(counts, n, len(grams)))
    hashes, rows = grams[at], row_of(counts)[at]
    for k in range(1, n):  # the whole sequence of a shorter text as one
        short = np.flatnonzero(sizes == k)
        if len(short):
            one = gram_hashes(words[(counts[short][:, None] + np.arange(k)).ravel()], k, 3)[::k]
            hashes, rows = np.append(hashes, mix(one + np.uint64(k))), np.append(rows, short)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    hashes, rows = hashes[new], rows[new]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(offsets) - 1))]).astype(np.int64)


def _batches(batch: pa.RecordBatch, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row numbers, hashes, ends) of the slices of a batch whose column 1 is the text. A text longer than a slice is hashed in parts; it is a slice of its own."""
    data, offsets = string_bytes(batch.column(1))
    for a, b in slices(offsets):
        own, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        if b - a > 1 or len(own) <= SLICE_BYTES:
            yield np.arange(a, b), *gram_sets(own, bounds, n)
            continue
        grams, words = np.zeros(0, np.uint64), 0
        for _, part, ends, before in overlapping(own, bounds, n - 1):
            words = before + int(words_of(part, ends)[2][-1])
            if words - before >= n:
                grams = np.union1d(grams, gram_sets(part, ends, n)[0])
        yield (np.array([a]), grams, np.array([0, len(grams)])) if words >= n else (np.array([a]), *gram_sets(own, bounds, n))


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    """How many n-grams a set has beyond those that it may lack: size - ceil(percent * size / 100) + 1."""
    return size - -(-size * percent // 100) + 1


def set_digests(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, size, set1, set2, parts, region): the set's size, two 64-bit digests of it, how many n-grams fall into each of PARTS parts, and
    its first one and a half prefixes in hash order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, hashes, ends in _batches(batch, n):
                sizes, out = np.diff(ends), []
                for seed in (1, 2):
                    with np.errstate(over="ignore"):
                        total = np.zeros(len(hashes) + 1, np.uint64)
                        np.cumsum(mix(hashes + np.uint64(seed)), out=total[1:])
                        out.append(pa.array((total[ends[1:]] - total[ends[:-1]]).view(np.int64)))
                part = np.repeat(np.arange(len(sizes)), sizes) * PARTS + (hashes >> np.uint64(58)).astype(np.int64)
                counts = np.bincount(part, minlength=len(sizes) * PARTS).astype(np.int32)
                parts = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * PARTS, pa.int32()), pa.array(counts))
                most = prefix_length(sizes, percent)
                near = np.minimum(most + most // 2, sizes)
                place = np.arange(len(hashes)) - np.repeat(ends[:-1], sizes)
                region = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(near)]).astype(np.int32)), pa.array(hashes[place < np.repeat(near, sizes)].view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(sizes), *out, parts, region], ["doc_id", "size", "set1", "set2", "parts", "region"])

    return docs.mapInArrow(tidied(run), "doc_id long, size long, set1 long, set2 long, parts array<int>, region array<long>")


def _prefixes(docs: DataFrame, frequent: np.ndarray, n: int, percent: int) -> DataFrame:
    """(gram, doc_id, size, at) of each document's prefix: n-grams that aren't frequent first, then by hash; at: the n-gram's place in that order from 0."""
    session = docs.sparkSession.sparkContext
    sent = session.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for numbers, hashes, ends in _batches(batch, n):
                sizes = np.diff(ends)
                rows = np.repeat(np.arange(len(sizes)), sizes)
                at = np.searchsorted(known, hashes).clip(0, max(0, len(known) - 1))
                often = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
                order = np.lexsort((hashes, often, rows))
                hashes = hashes[order]
                place = np.arange(len(hashes)) - np.repeat(ends[:-1], sizes)
                first = place < np.repeat(prefix_length(sizes, percent), sizes)
                of = rows[first]
                ids = batch.column(0).take(pa.array(numbers[of]))
                yield pa.RecordBatch.from_arrays([pa.array(hashes[first].view(np.int64)), ids, pa.array(sizes[of].astype(np.int32)), pa.array(place[first].astype(np.int32))], ["gram", "doc_id", "size", "at"])

    return docs.mapInArrow(tidied(run), "gram long, doc_id long, size int, at int")


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether two prefix rows of one n-gram can belong to a link, by their lengths and by the n-gram's places.

    With i common n-grams and sizes m and n, link means 100 i >= percent (m + n - i). At most so many are common as stand
    before the n-gram in both sets, and after it in both, and itself.
    """
    c = lambda side, name: F.col(f"{side}.{name}").cast("long")
    m, n = c(a, "size"), c(b, "size")
    lengths = (F.lit(100) * F.least(m, n)) >= F.lit(percent) * F.greatest(m, n)
    most = F.least(c(a, "at"), c(b, "at")) + 1 + F.least(m - c(a, "at") - 1, n - c(b, "at") - 1)
    return lengths & (F.lit(100 + percent) * most >= F.lit(percent) * (m + n))


def _suffixes_fit(pairs: DataFrame, digests: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the suffix filter leaves: two sets differ by at least as many n-grams as the sizes of their parts do, and a link allows m + n - 2 i."""
    side = lambda x, k: digests.select(F.col("doc_id").alias(x), F.col("parts").alias(k))
    joined = pairs.join(side("a", "p"), "a").join(side("b", "q"), "b")
    apart = F.aggregate(F.zip_with("p", "q", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x).cast("long")
    total = F.aggregate(F.zip_with("p", "q", lambda x, y: x + y), F.lit(0), lambda s, x: s + x).cast("long")
    return joined.filter(F.lit(100 + percent) * (total - apart) >= F.lit(2 * percent) * total).select("a", "b")


def _texts_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """The docs whose doc_id is in needed. A bit filter of all needed ids drops most others before the texts are shuffled; the join decides."""
    return with_maybe(docs, bit_filter(needed, "doc_id"), "doc_id", "_maybe").filter("_maybe").drop("_maybe").join(needed, "doc_id", "left_semi")


def _open_pairs(rows: DataFrame, digests: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of rows (gram, doc_id, size, at, component) that share an n-gram, stand in different components and pass all filters.

    The rows of an n-gram are dealt over blocks by doc_id, and every two blocks are compared as a group of 2 * BLOCK_ROWS rows or so,
    however many rows there are. Of the n-grams with more than CROWD rows, a pair comes from the first that both have, so once.
    """
    counts = rows.groupBy("gram").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
    counted = rows.join(counts, "gram")
    crowd = counted.filter(F.col("n") > CROWD)
    orders = crowd.groupBy("doc_id").agg(F.collect_list(F.struct("at", "gram")).alias("order"))
    crowd = crowd.join(orders, "doc_id").withColumn("earlier", F.transform(F.filter("order", lambda x: x["at"] < F.col("at")), lambda x: x["gram"])).drop("order")
    few = counted.filter(F.col("n") <= CROWD).withColumn("earlier", F.array().cast("array<long>"))
    own = few.unionByName(crowd).join(digests.select("doc_id", "parts"), "doc_id").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    groups = dealt.groupBy("gram", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).agg(F.collect_list(F.struct("doc_id", "component", "size", "at", "block", "parts", "earlier")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i, j, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                x = rows.values
                n = len(x)
                ids, component, size, at, block = (x.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "component", "size", "at", "block"))
                parts = x.field("parts").flatten().to_numpy().reshape(n, -1)
                before = x.field("earlier")
                known: dict[int, set[int]] = {}

                def earlier(k: int, before=before, known=known) -> set[int]:
                    if k not in known:
                        known[k] = set(before[k].as_py())
                    return known[k]

                # A small group's pairs are looked at all at once, a large one's row by row: memory stays in proportion to the group.
                sweeps = [np.triu_indices(n, 1)] if n <= CROWD else ((np.full(n - r - 1, r), np.arange(r + 1, n)) for r in range(n - 1))
                for p, q in sweeps:
                    ok = component[p] != component[q]
                    if i != j:
                        ok &= block[p] != block[q]
                    p, q = p[ok], q[ok]
                    both = size[p] + size[q]
                    most = np.minimum(at[p], at[q]) + 1 + np.minimum(size[p] - at[p] - 1, size[q] - at[q] - 1)
                    ok = (100 * np.minimum(size[p], size[q]) >= percent * np.maximum(size[p], size[q])) & ((100 + percent) * most >= percent * both)
                    p, q, both = p[ok], q[ok], both[ok]
                    if not len(p):
                        continue
                    ok = (100 + percent) * (both - np.abs(parts[p] - parts[q]).sum(1, dtype=np.int64)) >= 2 * percent * both
                    pairs = [(ids[a], ids[b]) if ids[a] < ids[b] else (ids[b], ids[a]) for a, b in zip(p[ok].tolist(), q[ok].tolist(), strict=True) if earlier(a).isdisjoint(earlier(b))]
                    found += pairs
            if found:
                pairs = np.unique(np.array(found, np.int64), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return groups.select("i", "j", "rows").mapInArrow(tidied(run), "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, folder: str, name: str, n: int, percent: int) -> DataFrame:
    """pairs (a, b) with linked: whether their whole sets are alike enough."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, hashes, ends in _batches(batch, n):
                grams = [hashes[ends[i] : ends[i + 1]].tobytes() for i in range(len(rows))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(grams, pa.binary())], ["doc_id", "grams"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(x) + len(y) - len(np.union1d(x, y))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    found = written(_texts_of(docs, written(needed, folder, f"{name}_needed")).mapInArrow(tidied(sets), "doc_id long, grams binary"), folder, f"{name}_sets")
    left = found.select(F.col("doc_id").alias("a"), F.col("grams").alias("x"))
    right = found.select(F.col("doc_id").alias("b"), F.col("grams").alias("y"))
    return written(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(tidied(compare), "a long, b long, linked boolean"), folder, name)


def _many(counts: DataFrame, most: int) -> np.ndarray:
    """The n-grams with the largest counts, ascending: all above FREQUENT. If those are more than `most`, the bound is doubled until
    they aren't: the order stays global and the result exact, only fewer n-grams count as frequent."""
    least = FREQUENT
    while counts.filter(F.col("count") > least).count() > most:
        least *= 2
    return np.sort(np.array([r[0] for r in counts.filter(F.col("count") > least).select("gram").toLocalIterator()], np.int64).view(np.uint64))


def _frequent(docs: DataFrame, digests: DataFrame, folder: str, n: int, percent: int) -> np.ndarray:
    """The frequent n-grams, so that each other one is in few prefixes.

    N-grams are counted over the regions of all documents. With a quarter of its region frequent at most, a document's prefix lies in the
    region, whose n-grams are counted. Of the other documents, with much text that many share, all n-grams are counted too.
    """
    counts = written(digests.select(F.explode("region").alias("gram")).groupBy("gram").count().filter(F.col("count") > FREQUENT), folder, "frequent")
    frequent = _many(counts, MOST_SENT // 2)
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            region = batch.column(1)
            ends, grams = region.offsets.to_numpy(), region.values.to_numpy(zero_copy_only=False).view(np.uint64)
            often = np.concatenate([[0], np.cumsum(known[np.searchsorted(known, grams).clip(0, len(known) - 1)] == grams)]) if len(known) else np.zeros(len(grams) + 1, np.int64)
            share = often[ends[1:]] - often[ends[:-1]]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(4 * share > np.diff(ends)))], ["doc_id"])

    def all_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, hashes, _ in _batches(batch, n):
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["gram"])

    heavy = written(digests.select("doc_id", "region").mapInArrow(tidied(crowded), "doc_id long").distinct(), folder, "crowded")
    more = _texts_of(docs, heavy).mapInArrow(tidied(all_grams), "gram long").groupBy("gram").count().filter(F.col("count") > FREQUENT)
    return np.union1d(frequent, _many(written(more, folder, "frequent2"), MOST_SENT // 2))


def similar_groups(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and n_checked of each row of docs (doc_id, text).

    A document's set: the distinct n-word runs of its text with A-Z in lower case; with fewer words all of them as one; null, empty
    and blank texts have the empty set, linked with nothing. Two documents link when 100 * common >= percent * together.
    component_id is the smallest doc_id reachable by links; n_checked counts the links to other sets that were verified
    on the way: at least one wherever there is one, not all; copies not counted. Rows of equal doc_id count as one document of as
    many sets, joined; rows without a doc_id are left out; other columns are not read.
    """
    folder = shared_dir(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    digests = written(set_digests(docs, n, percent), folder, "digests")
    groups = digests.filter("size > 0").groupBy("size", "set1", "set2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("_n")).filter("first < last").drop("last")
    copies = written(joined_salted(digests.select("doc_id", "size", "set1", "set2"), written(groups, folder, "groups"), ["set1", "set2", "size"], "doc_id").filter("doc_id > first").select("doc_id", "first").distinct(), folder, "copies")
    # A document of several sets may have links by one that is no copy, so it keeps its prefixes.
    place = F.struct("size", "set1", "set2")
    several = written(digests.groupBy("doc_id").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter("low < high").select("doc_id"), folder, "several")

    rows = _prefixes(docs, _frequent(docs, digests, folder, n, percent), n, percent)
    prefixes = written(_shared_only(rows, copies.join(several, "doc_id", "left_anti")), folder, "prefixes")

    hubs = prefixes.groupBy("gram").agg(F.min(F.struct("doc_id", "size", "at")).alias("hub")).select("gram", "hub.*")
    met = hubs.alias("a").join(prefixes.alias("b"), "gram").filter((F.col("a.doc_id") < F.col("b.doc_id")) & _possible("a", "b", percent))
    first_pairs = written(met.select(F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b")).distinct(), folder, "pairs1")
    links = _verified(written(_suffixes_fit(first_pairs, digests, percent), folder, "open1"), docs, folder, "links1", n, percent)
    groups = connected_components(links.filter("linked"), f"{folder}/components1")

    # What is left: rows of one n-gram in different components. Most n-grams have a single one and drop out before the join.
    placed = prefixes.join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    placed = written(placed, folder, "placed")
    mixed = placed.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("gram")
    open_rows = written(placed.join(mixed, "gram", "left_semi"), folder, "open_rows")
    rest = written(_open_pairs(open_rows, digests, percent).distinct(), folder, "met2").join(first_pairs, ["a", "b"], "left_anti")
    rest = written(rest, folder, "open2")
    more = _verified(rest, docs, folder, "links2", n, percent)

    linked = written(links.filter("linked").unionByName(more.filter("linked")).select("a", "b"), folder, "links")
    joined = linked.unionByName(copies.select(F.col("first").alias("a"), F.col("doc_id").alias("b")))
    components = connected_components(joined, f"{folder}/components2").withColumnRenamed("id", "doc_id")
    counts = linked.select(F.explode(F.array("a", "b")).alias("doc_id")).groupBy("doc_id").count()
    out = digests.groupBy("doc_id").agg(F.max("size").alias("n_shingles")).join(components, "doc_id", "left").join(counts, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("count", F.lit(0)).alias("n_checked"))


def _shared_only(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """The prefix rows of documents that are no copies, of n-grams that occur in two of them."""
    rows = rows.repartition("gram")  # one shuffle for the counts and for the join
    grams = rows.groupBy("gram").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select("gram")
    return rows.join(grams, "gram", "left_semi").join(copies, "doc_id", "left_anti")
