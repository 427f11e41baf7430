"""Selection under quotas, budgets and batches. Two rules look at what was taken before (quotas, budgets): they run over one group's rows in order."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Turns whose counts are summed up together.
TURNS = 10_000


@dataclass(frozen=True)
class Quotas:
    """Most per category, neighbourhood and venue, and how many cheap, timeless and seasonal ones there must be."""

    category: int = 2
    neighbourhood: int = 2
    venue: int = 1
    cheap: int = 1
    timeless: int = 1
    seasonal: int = 1


def diversify(rows: DataFrame, limit: int, threshold: float = 62, fallback: float = 55, quotas: Quotas = Quotas(), by: str | None = None) -> DataFrame:  # noqa: B008
    """rows (ord, total, category, neighbourhood, venue, cheap, timeless, vetoed) with pick (place from 1, or null) and outcome.

    First pass, by total downwards and ord: rows from the threshold on that break no quota. Second pass, for each unmet minimum: the
    best of the rows left that serve it, not vetoed, from the fallback on; quotas don't hold there. Each group of `by` is selected on
    its own. Before the groups are gathered, rows that no pass could reach are set apart by rank, so a group has a number of rows
    that `limit` and the number of categories bound; their outcome is "not reached" (or "below threshold"), not the quota that
    they would have broken.

    Why those bounds: all better rows of a row's class (category, cheap, timeless, vetoed, above the threshold) were picked or stand in a
    venue or neighbourhood that is used up, and picks use up `limit` venues and neighbourhoods at most. So in a class a neighbourhood's
    first limit + 1 venues count, a venue's first limit + 1 neighbourhoods, and of what is left as many as that many venues and
    neighbourhoods can cover, and one. The second pass takes the best rows of a class that are left, which are among its first `limit`.
    """
    key = [by] if by else []
    out_type = "pick int, outcome string"
    # In a class of equal (category, neighbourhood, venue, cheap, timeless, vetoed, above the threshold) at most `limit` rows can be picked.
    w = Window.partitionBy(*key, "category", "neighbourhood", "venue", "cheap", "timeless", "vetoed", F.col("total") >= threshold).orderBy(F.desc("total"), "ord")
    ranked = rows.withColumn("_rank", F.row_number().over(w))
    near = ranked.filter((F.col("_rank") <= limit) & (F.col("total") >= min(fallback, threshold)))
    kind_of = [*key, "category", "cheap", "timeless", "vetoed", F.col("total") >= threshold]
    cell = F.to_json(F.struct(*key, "category", "neighbourhood", "venue", "cheap", "timeless", "vetoed", (F.col("total") >= threshold).alias("above")), {"ignoreNullFields": "false"})
    place = lambda *on: F.row_number().over(Window.partitionBy(*kind_of, *on).orderBy(F.desc("total"), "ord"))
    cells = near.filter("_rank = 1").withColumns({"_cell": cell, "_venues": place("neighbourhood"), "_places": place("venue")}).filter((F.col("_venues") <= limit + 1) & (F.col("_places") <= limit + 1))
    cells = cells.withColumn("_all", place()).filter(F.col("_all") <= 2 * limit * (limit + 1) + 1)
    near = near.withColumn("_cell", cell).join(cells.select("_cell"), "_cell", "left_semi").drop("_cell")
    names = ["ord", "total", "category", "neighbourhood", "venue", "cheap", "timeless", "vetoed"]

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["total", "ord"], ascending=[False, True])
        used: dict[tuple[str, str], int] = {}
        have = {"cheap": 0, "timeless": 0, "seasonal": 0}
        picks: dict[int, int] = {}
        why: dict[int, str] = {}
        left = []

        def take(r) -> None:
            picks[r.ord] = len(picks) + 1
            why[r.ord] = "selected"
            for k in ("category", "neighbourhood", "venue"):
                used[k, getattr(r, k)] = used.get((k, getattr(r, k)), 0) + 1
            have["cheap"] += bool(r.cheap)
            have["timeless" if r.timeless else "seasonal"] += 1

        for r in pdf.itertuples(index=False):
            if len(picks) >= limit:
                why[r.ord] = "limit"
            elif r.total < threshold:
                why[r.ord] = "below threshold"
                left.append(r)
            elif broken := next((k for k in ("category", "neighbourhood", "venue") if used.get((k, getattr(r, k)), 0) >= getattr(quotas, k)), None):
                why[r.ord] = f"quota: {broken}"
                left.append(r)
            else:
                take(r)
        for need, serves in (("cheap", lambda r: r.cheap), ("timeless", lambda r: r.timeless), ("seasonal", lambda r: not r.timeless)):
            while have[need] < getattr(quotas, need) and len(picks) < limit:
                filler = next((r for r in left if r.ord not in picks and serves(r) and not r.vetoed and r.total >= fallback), None)
                if filler is None:
                    break
                take(filler)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] * len(why) for k in key}, "ord": list(why), "pick": pd.array([picks.get(o) for o in why], "Int32"), "outcome": list(why.values())})

    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*(f"{k} {kind[k]}" for k in key), "ord long", out_type])
    grouped = near.select(*key, *names).groupBy(*key) if key else near.select(*names).groupBy()
    chosen = grouped.applyInPandas(choose, schema)
    joined = rows.join(chosen, [*key, "ord"], "left")
    return joined.withColumn("outcome", F.coalesce("outcome", F.when(F.col("total") < threshold, "below threshold").otherwise("not reached")))


def coverage(selected: DataFrame) -> DataFrame:
    """Counts by category and by neighbourhood, of one pass: (dimension, value, n)."""
    sets = selected.groupingSets([("category",), ("neighbourhood",)], "category", "neighbourhood").agg(F.count("*").alias("n"), F.grouping("category").alias("g"))
    return sets.select(F.when(F.col("g") == 0, "category").otherwise("neighbourhood").alias("dimension"), F.when(F.col("g") == 0, F.col("category")).otherwise(F.col("neighbourhood")).alias("value"), "n")


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], most: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= most)


def round_robin(rows: DataFrame, key: list[str], order: str, size: int) -> DataFrame:
    """rows with turn (their place in their key's queue), and batch: queues take turns, in the order of their first rows, and every `size` rows are a batch.

    The place over all rows is a count of rows of earlier turns, and of earlier queues in the same turn. Counts by turn are summed up in
    parts of TURNS turns, so the only window over everything has one row for each part.
    """
    turn = F.row_number().over(Window.partitionBy(*key).orderBy(order))
    first = F.min(order).over(Window.partitionBy(*key))
    placed = rows.withColumns({"turn": turn, "_first": first})
    per_turn = placed.groupBy("turn").count().withColumn("_part", F.floor(F.col("turn") / TURNS))
    per_part = per_turn.groupBy("_part").agg(F.sum("count").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_part").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_turn.join(per_part, "_part").select("turn", (F.col("_start") + F.coalesce(F.sum("count").over(within), F.lit(0))).alias("_before"))
    seat = F.row_number().over(Window.partitionBy("turn").orderBy("_first", *key))
    return placed.withColumn("_seat", seat).join(starts, "turn").withColumn("batch", F.floor((F.col("_before") + F.col("_seat") - 1) / size)).drop("_first", "_seat", "_before")
