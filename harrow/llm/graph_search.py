"""Approximate nearest neighbours by inner product, on one robust-pruned directed graph per shard of the vectors.

The graph lies over the vectors' directions. Points enter it in growing batches: greedy searches on the graph so far
propose neighbours, relaxed distance pruning keeps the diverse ones, and each edge is offered to its target. A query's
beam search goes through every shard, ordered by inner product, from the best of a few fixed entry points: the longest
vectors and some others. Directions and lengths are kept apart, so magnitudes may differ as far as doubles can; scores are
inner products of the original vectors in double precision. Vectors of different dimension have no inner product: each
dimension has its own shards.

How wide a beam must be depends on the data, so each shard finds out when it is built: some of its points are held out of the graph, searched for
their nearest in it, and compared with an exact search; the beam doubles until WANTED of them are found. Then they enter the graph too. The width
and the recall at it are columns of the index.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a shard at most, components of a shard (beyond LEAST_ROWS vectors), and queries that meet a shard in one task.
SHARD_ROWS, SHARD_VALUES, LEAST_ROWS, BLOCK_QUERIES = 16_384, 1 << 20, 2048, 2048
DEGREE, BUILD_BEAM, SEARCH_BEAM, RELAX = 32, 64, 160, 1.2
#: The recall that a shard's beam is widened for, and how many of its points are held out to measure it.
WANTED, HELD = 0.96, 96
#: Entry points of a shard (half of them the longest vectors), how many of them a search starts from, and queries searched in step.
ENTRIES, STARTS, IN_STEP = 512, 32, 256
#: Dimensions up to this one have shard numbers fitted to their own vectors; all larger ones share theirs. It bounds the table that is broadcast.
MOST_WIDTHS = 65_536


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors in single precision, lengths in double precision relative to the largest component of all). Rows are finite and not zero."""
    largest = np.abs(vectors).max(1)
    scaled = vectors / largest[:, None]
    lengths = np.sqrt((scaled**2).sum(1))
    return (scaled / lengths[:, None]).astype(np.float32), lengths * (largest / largest.max())


def _beam(units: np.ndarray, lengths: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, width: int, starts: int = STARTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-first searches of all queries in step, by inner product with units times lengths: (beam ids, beam distances, opened ids).

    units, lengths and edges have one row more than there are points: the blank that unused places name. Distances are negative inner products.
    """
    blank, b = len(units) - 1, len(queries)
    starts = min(starts, len(entries), width)
    first = -(queries @ units[entries].T) * lengths[entries]
    best = np.argpartition(first, starts - 1, 1)[:, :starts]
    ids, far, opened = np.full((b, width), blank, np.int32), np.full((b, width), np.inf), np.ones((b, width), bool)
    ids[:, :starts], far[:, :starts], opened[:, :starts] = entries[best], np.take_along_axis(first, best, 1), False
    seen = np.zeros((b, blank + 1), bool)
    seen[:, blank] = True
    np.put_along_axis(seen, ids[:, :starts], True, 1)
    steps = []
    while True:
        waiting = np.where(opened, np.inf, far)
        pick = waiting.argmin(1)
        rows = np.flatnonzero(np.isfinite(waiting[np.arange(b), pick]))
        if not len(rows):
            break
        pick = pick[rows]
        node = ids[rows, pick]
        opened[rows, pick] = True
        step = np.full(b, blank, np.int32)
        step[rows] = node
        steps.append(step)
        near = edges[node]
        fresh = ~seen[rows[:, None], near]
        seen[rows[:, None], near] = True
        d = -np.matmul(units[near], queries[rows][:, :, None])[:, :, 0] * lengths[near]
        d[~fresh] = np.inf
        all_ids, all_far = np.concatenate([ids[rows], near], 1), np.concatenate([far[rows], d], 1)
        all_opened = np.concatenate([opened[rows], ~fresh], 1)
        best = np.argpartition(all_far, width - 1, 1)[:, :width]
        ids[rows], far[rows], opened[rows] = (np.take_along_axis(x, best, 1) for x in (all_ids, all_far, all_opened))
    order = np.argsort(far, 1, "stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1), np.array(steps).T


def _prune(points: np.ndarray, own: np.ndarray, near: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """For each point of own up to `degree` of its candidates near: the closest first, and none to which a chosen one is clearly closer."""
    blank, n = len(points) - 1, len(own)
    near = np.sort(near, 1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = blank
    vectors = points[near]
    d = ((vectors - points[own][:, None]) ** 2).sum(2)
    d[(near == blank) | (near == own[:, None])] = np.inf
    squares = (vectors**2).sum(2)
    between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    out, rows = np.full((n, degree), blank, np.int32), np.arange(n)
    left = d.copy()
    for k in range(degree):
        pick = left.argmin(1)
        ok = np.isfinite(left[rows, pick])
        if not ok.any():
            break
        out[ok, k] = near[rows[ok], pick[ok]]
        left[relax * relax * between[rows, pick] <= d] = np.inf
        left[rows, pick] = np.inf
    return out


def _insert(points: np.ndarray, edges: np.ndarray, new: np.ndarray, entries: np.ndarray, beam: int, relax: float) -> None:
    """Enters points into the graph: searches from entries propose their edges, and each edge is offered to its target."""
    n, degree = len(edges) - 1, edges.shape[1]
    _, _, ids = _beam(points, np.ones(n + 1), edges, entries, points[new], beam)
    edges[new] = _prune(points, new, ids, degree, relax)
    source, target = np.repeat(new, degree), edges[new].ravel()
    source, target = source[target < n], target[target < n]
    by = np.argsort(target, kind="stable")
    source, target = source[by], target[by]
    targets, first, counts = np.unique(target, return_index=True, return_counts=True)
    for many in np.array_split(np.argsort(counts, kind="stable"), ceil(len(targets) / 128)):
        width = int(counts[many].max())
        place = first[many][:, None] + np.arange(width)
        offered = np.where(np.arange(width) < counts[many][:, None], source[place.clip(0, len(source) - 1)], n).astype(np.int32)
        both = np.concatenate([edges[targets[many]], offered], 1)
        free = (both < n).sum(1) <= degree
        fits = np.sort(both[free], 1)[:, :degree]
        edges[targets[many][free]] = fits
        edges[targets[many][~free]] = _prune(points, targets[many][~free], both[~free], degree, relax)


def build_graph(units: np.ndarray, lengths: np.ndarray, k: int, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX, batch: int = 256, seed: int = 7) -> tuple[np.ndarray, int, float]:
    """(edges, width, recall) over unit vectors in single precision: `degree` edges a row, unused ones name the row count, and one blank row more; the
    width of beam that found `recall` of the k nearest of the points held out."""
    n = len(units)
    points = np.vstack([units, np.zeros((1, units.shape[1]), np.float32)])
    edges = np.full((n + 1, degree), n, np.int32)
    order = np.random.default_rng(seed).permutation(n).astype(np.int32)
    held = order[n - min(HELD, n // 4) :]
    order = order[: n - len(held)]
    at, size = 1, 1
    while at < len(order):
        # Searches begin at the best of the points that came first: they lie in all clusters that are not small.
        _insert(points, edges, order[at : at + size], order[: min(at, ENTRIES)], beam, relax)
        at, size = at + size, min(batch, max(size + 1, at // 8))
    width, recall = _measured(points, lengths, edges, order, held, k)
    for at in range(0, len(held), batch):
        _insert(points, edges, held[at : at + batch], order[:ENTRIES], beam, relax)
    return edges, width, recall


def _measured(points: np.ndarray, lengths: np.ndarray, edges: np.ndarray, inside: np.ndarray, held: np.ndarray, k: int) -> tuple[int, float]:
    """The least width of SEARCH_BEAM times a power of two at which searches for the held points find WANTED of their k nearest inside the graph (or
    that takes in all of it), and what they find."""
    k = min(k, len(inside))
    if not len(held) or not k:
        return SEARCH_BEAM, 1.0
    scale, exact = np.append(lengths, 0.0), points.astype(np.float64)
    scores = np.matmul(exact[held], exact[inside].T) * scale[inside]
    least = np.partition(scores, len(inside) - k, 1)[:, len(inside) - k]
    width = SEARCH_BEAM
    entries = inside[entry_points(lengths[inside])]
    while True:
        found, far, _ = _beam(points, scale, edges, entries, points[held], max(width, 2 * k))
        rows, slots = np.nonzero(np.isfinite(far))
        hits = np.zeros(len(held), np.int64)
        own = np.einsum("nd,nd->n", exact[held[rows]], exact[found[rows, slots]]) * scale[found[rows, slots]]
        np.add.at(hits, rows, own >= least[rows] - 1e-12 * np.abs(least[rows]))
        recall = float(np.minimum(hits, k).mean() / k)
        if recall >= WANTED or width >= len(inside):
            return width, recall
        width *= 2


def entry_points(lengths: np.ndarray, most: int = ENTRIES, seed: int = 7) -> np.ndarray:
    """The numbers of the longest vectors and of as many others, drawn by a fixed seed."""
    longest = np.argsort(-lengths, kind="stable")[: most // 2]
    return np.unique(np.concatenate([longest, np.random.default_rng(seed).permutation(len(lengths))[: most // 2]])).astype(np.int32)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array of double) of the rows that take part: those with an id and a finite, non-zero vector without nulls.
    Rows that are equal in both columns count once; all dimensions stay; other columns are not read."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter("vec_id IS NOT NULL")
    sane: Column = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return rows.filter(sane).dropDuplicates(["vec_id", "embedding"])


def _dealt(rows: DataFrame, size: int | Column, name: str) -> DataFrame:
    """rows (with embedding) and width, parts (how many parts of about `size` rows, which may depend on _width, the vectors of that dimension need) and the row's part.

    The table of part numbers has MOST_WIDTHS rows at most, whatever the input.
    """
    width = F.least(F.size("embedding"), F.lit(MOST_WIDTHS))
    parts = rows.groupBy(width.alias("_width")).count().select("_width", F.ceil(F.col("count") / F.lit(size)).cast("int").alias("_parts"))
    placed = rows.withColumn("_width", width).join(F.broadcast(parts), "_width")
    key = F.xxhash64("vec_id") if name == "block" else F.xxhash64("embedding")
    return placed.select(*rows.columns, F.size("embedding").alias("width"), F.pmod(key, F.col("_parts")).cast("int").alias(name), F.col("_parts").alias(f"{name}s"))


INDEX = "width int, shard int, shards int, n int, beam int, recall double, vectors binary, edges binary, entries binary, id_ends binary, ids binary"


def build_index(rows: DataFrame, k: int, shard_rows: int | None = None, degree: int = DEGREE, beam: int = BUILD_BEAM) -> DataFrame:
    """One row per shard of usable() rows: its dimension and number, the width of beam it needs and the recall measured at it, and as bytes its distinct vectors, their edges, the entry points, and the ids.

    Of equal vectors one is a point of the graph, with the smallest k + 1 of their ids: no answer of k can need more. A group of equal
    vectors is cut down to those before it is gathered, and no shard holds many more than shard_rows points; unless that is given, SHARD_ROWS or fewer
    if they are wide: as many as have SHARD_VALUES components, but at least LEAST_ROWS.
    """
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    points = rows.withColumn("rank", rank).filter(F.col("rank") <= k + 1).groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([("first", "ascending")]).combine_chunks()
        n = table.num_rows
        vectors = table["embedding"].combine_chunks().flatten().to_numpy().reshape(n, -1)
        ids = table["ids"].combine_chunks()
        units, lengths = directions(vectors)
        edges, width, recall = build_graph(units, lengths, k, degree, beam)
        columns = [vectors, edges, entry_points(lengths), np.cumsum(ids.value_lengths().to_numpy()).astype(np.int64), ids.flatten().to_numpy().astype(np.int64)]
        numbers = [table[c][0].as_py() for c in ("width", "shard", "shards")]
        schema = pa.schema([*((x, pa.int32()) for x in ("width", "shard", "shards", "n", "beam")), ("recall", pa.float64()), *((x, pa.binary()) for x in ("vectors", "edges", "entries", "id_ends", "ids"))])
        return pa.Table.from_arrays([pa.array([x], t.type) for x, t in zip([*numbers, n, width, recall, *(c.tobytes() for c in columns)], schema, strict=True)], schema=schema)

    size = F.lit(shard_rows) if shard_rows else F.greatest(F.least(F.lit(SHARD_ROWS), F.floor(F.lit(SHARD_VALUES) / F.col("_width"))), F.lit(LEAST_ROWS))
    dealt = _dealt(points, size, "shard").select("width", "shard", "shards", "embedding", "ids", F.element_at("ids", 1).alias("first"))
    return dealt.groupBy("width", "shard").applyInArrow(build, INDEX)


def _search(shard: dict, own: np.ndarray, asked: np.ndarray, k: int, beam: int | None, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, vec_ids, scores): up to k of the shard's nearest found of each query id (own) by its vectors (asked)."""
    read = lambda name, kind: np.frombuffer(shard[name], kind)
    vectors = read("vectors", np.float64).reshape(shard["n"], -1)
    edges, entries, ends, ids = read("edges", np.int32).reshape(shard["n"] + 1, -1), read("entries", np.int32), read("id_ends", np.int64), read("ids", np.int64)
    if exact:
        with np.errstate(over="ignore", invalid="ignore"):
            all_scores = np.nan_to_num(asked @ vectors.T, nan=-np.inf)
        # An id may have several vectors, and its own is no answer to a query: so many points hold k others.
        most = min((k + 1) * int(np.unique(ids, return_counts=True)[1].max()), len(vectors))
        q, point = np.nonzero(all_scores >= np.partition(all_scores, len(vectors) - most, 1)[:, [len(vectors) - most]])
    else:
        units, lengths = directions(vectors)
        units, lengths = np.vstack([units, np.zeros((1, units.shape[1]), np.float32)]), np.append(lengths, 0.0)
        found, far, _ = _beam(units, lengths, edges, entries, directions(asked)[0], max(beam or shard["beam"], 2 * k))
        q, slot = np.nonzero(np.isfinite(far))
        point = found[q, slot]
    with np.errstate(over="ignore", invalid="ignore"):
        score = np.einsum("nd,nd->n", vectors[point], asked[q])
    first = np.concatenate([[0], ends[:-1]])[point]
    counts = ends[point] - first
    at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    q, score, vec = np.repeat(own[q], counts), np.repeat(score, counts), ids[at]
    order = np.lexsort((-score, vec, q))  # of several vectors of an id, its best counts
    q, score, vec = q[order], score[order], vec[order]
    keep = (vec != q) & np.append(True, (q[1:] != q[:-1]) | (vec[1:] != vec[:-1]))[: len(q)]
    q, score, vec = q[keep], score[keep], vec[keep]
    order = np.lexsort((vec, -score, q))
    q, score, vec = q[order], score[order], vec[order]
    best = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[best], vec[best], score[best]


def search_index(index: DataFrame, queries: DataFrame, k: int, beam: int | None = None, exact: bool = False) -> DataFrame:
    """The k nearest found of each query (vec_id, embedding, as usable() gives them): query_id, rank, vec_id, score.

    Beams are as wide as each shard needs, or `beam`; exact compares each query with all points of each shard instead.

    Nearest first, ties to the smaller vec_id. Rows of one vec_id are one thing with several vectors: its best inner product counts, it has
    one ranking, and it is no answer to itself. Inner products too large for a double are infinite, those too small are zeros (which of those are
    found is left open); sums of infinite parts that are no numbers come
    last. Queries go to every shard of their dimension in blocks, so a task holds one shard and one block at a time: blocks are
    copied for each shard and shards for each block, and nothing passes through the driver.
    """
    shards = F.broadcast(index.select("width", "shards").filter(F.col("width") <= MOST_WIDTHS).distinct())
    wide = index.filter(F.col("width") > MOST_WIDTHS).select(F.max("shards").alias("_wide"))
    dealt = _dealt(queries.select("vec_id", "embedding"), BLOCK_QUERIES, "block")
    blocks = F.broadcast(dealt.groupBy(F.least("width", F.lit(MOST_WIDTHS)).alias("_width")).agg(F.max("blocks").alias("blocks")))
    asked = dealt.drop("blocks").join(shards, "width", "left").join(F.broadcast(wide), how="left").withColumn("shards", F.coalesce("shards", "_wide", F.lit(0))).drop("_wide")
    asked = asked.filter("shards > 0").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards")
    copies = index.withColumn("_width", F.least("width", F.lit(MOST_WIDTHS))).join(blocks, "_width").drop("_width")
    copies = copies.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "shards")

    def run(block: pa.Table, shard: pa.Table) -> pa.Table:
        found = []
        if block.num_rows and shard.num_rows:
            own = block["vec_id"].to_numpy()
            order = np.argsort(own, kind="stable")
            own = own[order]
            vectors = block["embedding"].combine_chunks().flatten().to_numpy().reshape(len(own), -1)[order]
            one = {c: shard[c][0].as_py() for c in ("n", "beam", "vectors", "edges", "entries", "id_ends", "ids")}
            # A query id's vectors are searched in one step together.
            cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            cuts = [*cuts[:: IN_STEP], len(own)]
            found = [_search(one, own[a:b], vectors[a:b], k, beam, exact) for a, b in zip(cuts, cuts[1:], strict=False)]
        columns = [np.concatenate([f[j] for f in found]) if found else np.zeros(0, t) for j, t in enumerate((np.int64, np.int64, np.float64))]
        return pa.Table.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    key = ["width", "shard", "block"]
    found = asked.groupBy(*key).cogroup(copies.groupBy(*key)).applyInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.isnan("score"), F.desc("score"), "vec_id"))
    best = found.groupBy("query_id", "vec_id").agg(F.max(F.when(~F.isnan("score"), F.col("score"))).alias("score")).withColumn("score", F.coalesce("score", F.lit(float("nan"))))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
