"""Temperature mixing: sources get the normalised power of their token shares as weights, realised as budgeted block permutations.

The exponent is bisected until the weights have a target entropy, or until no source is repeated more often than allowed. A
source's documents are dealt by hash over blocks; each epoch takes them in an own pseudo-random order of blocks, and of
documents in a block. A source has many blocks, so it is spread over the order that all blocks of an epoch have together. Whole epochs take every document; the last one stops where the source's budget of tokens ends: all
blocks before one, and of that one the documents before another. So each source needs a few numbers only, and texts are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, exp, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_dir, written

#: Tokens of a block, the fewest blocks of a source, and the most sources whose plan is broadcast.
BLOCK_TOKENS, LEAST_BLOCKS, MOST_BROADCAST = 1 << 20, 64, 10_000


def words(text: Column) -> Column:
    """The number of words as a measure of tokens; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def weights(shares: list[float], exponent: float, counts: list[int] | None = None) -> list[float]:
    """Normalised powers; a source without tokens gets no weight. counts: how many sources there are of each share."""
    raw = [exp(exponent * log(p)) if p > 0 else 0.0 for p in shares]
    total = sum(x * c for x, c in zip(raw, counts or [1] * len(raw), strict=True))
    return [x / (total or 1.0) for x in raw]


def entropy(w: list[float], counts: list[int] | None = None) -> float:
    return -sum(c * x * log(x) for x, c in zip(w, counts or [1] * len(w), strict=True) if x > 0)


def bisect(too_flat, low: float = 0.0, high: float = 1.0, rounds: int = 60) -> float:
    """The smallest exponent in [low, high] that isn't too flat; high if all are."""
    if not too_flat(low):
        return low
    for _ in range(rounds):
        mid = (low + high) / 2
        low, high = (mid, high) if too_flat(mid) else (low, mid)
    return high


@dataclass(frozen=True)
class Mix:
    """exponent, the budget in tokens, and each source's weight."""

    exponent: float
    budget: float
    weights: dict[str, float]


def plan(tokens: dict[str, int], budget: float | None = None, target_entropy: float | None = None, max_epochs: float | None = None) -> Mix:
    """The flattest mix within the limits.

    target_entropy: the exponent (0 to 8) is the smallest whose weights have at most this entropy (nats); if sources would then be
    repeated more than max_epochs times, the budget is lowered. Without a target the exponent (0 to 1) is the smallest that repeats no source
    more than max_epochs times; a budget above max_epochs times all tokens is lowered to that. budget None: as few tokens as
    give every document once.
    """
    names = sorted(tokens)
    exponent, size, w = _plan([tokens[s] for s in names], [1] * len(names), budget, target_entropy, max_epochs)
    return Mix(exponent, size, dict(zip(names, w, strict=True)))


def _plan(sizes: list[int], counts: list[int], budget: float | None, target_entropy: float | None, max_epochs: float | None) -> tuple[float, float, list[float]]:
    """(exponent, budget, weight of a source of each size); counts: how many sources have that size."""
    total = sum(n * c for n, c in zip(sizes, counts, strict=True))
    shares = [n / total if total else 0.0 for n in sizes]

    def size(w: list[float]) -> float:
        return budget if budget is not None else max((p * total / x for p, x in zip(shares, w, strict=True) if x > 0), default=0.0)

    if target_entropy is not None:
        exponent = bisect(lambda e: entropy(weights(shares, e, counts), counts) > target_entropy, 0.0, 8.0)
        w = weights(shares, exponent, counts)
        most = min((max_epochs * p * total / x for p, x in zip(shares, w, strict=True) if x > 0), default=0.0) if max_epochs is not None else float("inf")
        return exponent, min(size(w), most), w

    if budget is not None and max_epochs is not None:
        budget = min(budget, max_epochs * total)

    def too_flat(exponent: float) -> bool:
        w = weights(shares, exponent, counts)
        return max_epochs is not None and any(x * size(w) > max_epochs * p * total * (1 + 1e-12) for x, p in zip(w, shares, strict=True))

    exponent = bisect(too_flat)
    w = weights(shares, exponent, counts)
    return exponent, size(w), w


def mix(docs: DataFrame, budget: float | None = None, target_entropy: float | None = None, max_epochs: float | None = 2.0, seed: int = 1, block_tokens: int = BLOCK_TOKENS, places: bool = True) -> DataFrame:
    """docs (doc_id, text, source and any others), each row as often as its source's budget takes it, with mix_epoch (from 0), mix_slot (its block's place in that epoch's order) and mix_place (its own place in the block), which replace columns of those names; without them if places is false.

    A reader that goes by (mix_epoch, mix_slot, mix_place) reads the mixture: blocks of all sources come in a pseudo-random order.

    Null sources are one source of their own. Documents without words cost nothing and come once; so do all of a source without
    words. Rows of equal doc_id and source are taken or left together in a last epoch. The driver sees one
    row for each different size of a source, at most the root of twice the tokens; no document and no source by name.
    """
    spark, folder = docs.sparkSession, shared_dir(docs.sparkSession)
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    narrow = written(docs.select(name.alias("_name"), F.col("doc_id"), words(F.col("text")).alias("_tokens")), folder, "tokens")
    sizes = written(narrow.groupBy("_name").agg(F.sum("_tokens").alias("_size")), folder, "sizes")
    of_size = {r["_size"]: r["count"] for r in sizes.groupBy("_size").count().collect()}
    counts, n_sources, rows = sorted(of_size), sum(of_size.values()), []
    _, total, shares = _plan(counts, [of_size[n] for n in counts], budget, target_entropy, max_epochs)
    for n, share in zip(counts, shares, strict=True):
        quota = share * total
        whole = int(quota / n + 1e-9) if n else 1
        rows.append((n, whole, max(0.0, quota - whole * n), max(LEAST_BLOCKS, ceil(n / block_tokens))))
    planned = spark.createDataFrame(rows, "_size long, _whole int, _rest double, _blocks int").coalesce(1)
    sources = written(sizes.join(_sent(planned, len(rows)), "_size").drop("_size"), folder, "sources")

    block = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("_blocks")).cast("int")
    slot = lambda epoch: F.xxhash64(F.lit(seed), epoch, F.col("_name"), F.col("_block"))
    place = lambda epoch: F.xxhash64(F.lit(seed), epoch, F.col("doc_id"))
    last = F.col("_whole")

    # Where the last epoch of each source ends: the block, and the document in it.
    dealt = narrow.filter("_tokens > 0").join(_sent(sources, n_sources), "_name").withColumn("_block", block)
    sums = dealt.groupBy("_name", "_block", "_whole", "_rest").agg(F.sum("_tokens").alias("_sum")).withColumn("_slot", slot(last))
    before = F.sum("_sum").over(Window.partitionBy("_name").orderBy("_slot", "_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_sum")
    cuts = sums.withColumn("_before", before).filter((F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_sum") > F.col("_rest")))
    cuts = written(cuts.select("_name", F.col("_block").alias("_cut_block"), F.col("_slot").alias("_cut_slot"), "_before"), folder, "cuts")
    inside = dealt.join(_sent(cuts, n_sources), "_name").filter("_block = _cut_block").withColumn("_place", place(last))
    running = F.col("_before") + F.sum("_tokens").over(Window.partitionBy("_name", "_block").orderBy("_place", "doc_id"))
    ends = inside.withColumn("_run", running).filter("_run <= _rest").groupBy("_name").agg(F.max(F.struct("_place", F.col("doc_id").alias("_id"))).alias("_end"))
    limits = written(sources.join(cuts, "_name", "left").join(ends, "_name", "left"), folder, "limits")

    own = docs.withColumns({"_name": name, "_any": words(F.col("text")) > 0}).join(_sent(limits, n_sources), "_name").withColumn("_block", block)
    earlier = F.struct(slot(last).alias("s"), F.col("_block").alias("b")) < F.struct(F.col("_cut_slot").alias("s"), F.col("_cut_block").alias("b"))
    within = (F.col("_block") == F.col("_cut_block")) & (F.struct(place(last).alias("_place"), F.col("doc_id").alias("_id")) <= F.col("_end"))
    in_last = (F.col("_rest") > 0) & (F.col("_cut_slot").isNull() & (F.col("_rest") >= 1) | F.coalesce(earlier, F.lit(False)) | F.coalesce(within, F.lit(False)))
    times = F.when(~F.col("_any"), 1).otherwise(F.col("_whole") + in_last.cast("int"))
    repeated = own.withColumn("_epoch", F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))))
    if not places:
        return repeated.select(*docs.columns)
    return repeated.select(*[c for c in docs.columns if c not in ("mix_epoch", "mix_slot", "mix_place")], F.col("_epoch").alias("mix_epoch"), slot(F.col("_epoch")).alias("mix_slot"), place(F.col("_epoch")).alias("mix_place"))


def _sent(sources: DataFrame, n: int) -> DataFrame:
    """A table of one row per source, broadcast if those are few; else Spark chooses the join."""
    return F.broadcast(sources) if n <= MOST_BROADCAST else sources
