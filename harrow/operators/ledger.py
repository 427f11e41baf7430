"""Spending: costs, totals by month and model, settled batches, the budget guard, and when a warning was due."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from harrow.functions.text import half_up
from harrow.sources.shared import shared_folder

#: Euros a month, the share at which to warn, euros a dollar, characters a token.
BUDGET, WARN_AT, EUR_PER_USD, CHARS_PER_TOKEN = 5.0, 0.7, 0.93, 3.6


def approximate_tokens(text: Column) -> Column:
    return F.ceil(F.length(text) / CHARS_PER_TOKEN)


def cost(calls: DataFrame, pricing: DataFrame) -> DataFrame:
    """calls (model, input_tokens, output_tokens) with usd and eur by pricing (model, input_usd, output_usd per million tokens); unknown models get null."""
    usd = F.col("input_tokens") / 1e6 * F.col("input_usd") + F.col("output_tokens") / 1e6 * F.col("output_usd")
    return calls.join(pricing, "model", "left").withColumn("usd", usd).withColumn("eur", F.col("usd") * EUR_PER_USD).drop("input_usd", "output_usd")


def totals(calls: DataFrame) -> DataFrame:
    """Per month: euros, calls, and a map of euros by model with its keys in order."""
    by_model = calls.groupBy(F.date_format("at", "yyyy-MM").alias("month"), "model").agg(F.sum("eur").alias("eur"), F.count("*").alias("n"))
    entries = F.array_sort(F.collect_list(F.struct("model", half_up(F.col("eur"), 4).alias("eur"))))
    return by_model.groupBy("month").agg(half_up(F.sum("eur"), 4).alias("eur"), F.sum("n").alias("calls"), F.map_from_entries(entries).alias("by_model"))


def settled(calls: DataFrame) -> DataFrame:
    """Per batch the settled call if there is one, else the pending; calls without a batch stay."""
    w = Window.partitionBy("batch_id").orderBy("pending", F.desc("at"))
    batched = calls.filter("batch_id IS NOT NULL").withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    return calls.filter("batch_id IS NULL").unionByName(batched)


#: Calls of a month that are judged one after the other at once, and how near to the budget a sum may come and still be left to that: more than
#: what adding doubles may lose.
LOOP_CALLS, NEAR = 10_000, Decimal("0.000001")
_ORDER = ("ord", "amount", "id")


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _before(rows: DataFrame, value: Column) -> DataFrame:
    """(month, part, before) of rows dealt by ranges of month and order: what `value`, an aggregate's column _t, comes to over the month's ranges before
    each; null for the first. One row a range."""
    ahead = Window.partitionBy("month").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("month", "part", value.over(ahead).alias("before"))


def guard(calls: DataFrame, budget: float = BUDGET, loop_calls: int = LOOP_CALLS) -> DataFrame:
    """calls (month, ord, eur) with admitted and spent (after the call): a call goes through if its month's budget still holds it; one that doesn't spends nothing.

    Calls are taken by ord, then amount, and summed as doubles in that order. What was admitted decides about later calls, so only a loop can do it, but
    most calls can't go through whatever happens, and those leave first: up to where running sums reach a month's budget all calls go through, and of
    those behind it only the ones that fit the rest stay. Rounds of running sums over ranges, exact in decimals, take a month on from refusal to
    refusal, until at most loop_calls of its calls are left or a sum comes too NEAR the budget to say. What stays (as many calls as the budget pays
    for, and those few) streams through the loop month by month, in order and without being held. No month is one task before.
    A null or NaN amount is refused; one below zero is an error, as then what didn't fit could fit later. A null month is a month of its own.
    """
    folder, limit, no_month = shared_folder(calls.sparkSession), Decimal(budget), "\0"
    amount = F.when(F.col("eur") < 0, F.raise_error(F.lit("an amount below zero"))).when(F.isnan("eur"), None).otherwise(F.least("eur", F.lit(2.0 * budget + 1)).cast("decimal(38,18)"))
    ranges = int(calls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows are dealt once, by ranges of month and order, so a range holds a part of a month at most; equal ones share a range, where ids tell them apart.
    dealt = calls.select(F.coalesce("month", F.lit(no_month)).alias("month"), "ord", "eur", amount.alias("amount")).repartitionByRange(ranges, "month", "ord", "amount")
    rows = _stored(dealt.withColumns({"part": F.spark_partition_id(), "id": F.monotonically_increasing_id()}), f"{folder}/calls")
    columns = ["month", "part", *_ORDER, "eur"]
    inside = Window.partitionBy("month", "part").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    left = rows.filter(F.col("amount") <= F.lit(limit + NEAR)).select(*columns, F.lit(0).cast("decimal(38,18)").alias("base"))
    kept, number = [], 0
    while True:
        sizes = left.groupBy("month").agg(F.count("*").alias("_n"))
        few, many = (left.join(sizes.filter(c).select("month"), "month", "left_semi") for c in (F.col("_n") <= loop_calls, F.col("_n") > loop_calls))
        kept.append(few.select(*columns))
        if sizes.filter(F.col("_n") > loop_calls).limit(1).count() == 0:
            break
        # Where a month's sum passes the limit is found by the ranges' sums, and then inside the ranges that those before leave room for.
        sums = many.groupBy("month", "part").agg(F.sum("amount").alias("_t"))
        open_ranges = _before(sums, F.sum("_t")).withColumn("before", F.coalesce("before", F.lit(0)))
        summed = many.join(open_ranges, ["month", "part"]).withColumn("_ahead", (F.col("base") + F.col("before")).cast("decimal(38,18)")).filter(F.col("_ahead") <= F.lit(limit - NEAR))
        summed = summed.withColumn("so_far", (F.col("_ahead") + F.sum("amount").over(inside)).cast("decimal(38,18)"))
        reached = summed.filter(F.col("so_far") > F.lit(limit - NEAR)).groupBy("month").agg(F.min(F.struct(*_ORDER, "so_far")).alias("_stop"))
        marked = many.join(_stored(reached, f"{folder}/reached{number}"), "month", "left")
        stop, own = F.struct(*[F.col(f"_stop.{c}") for c in _ORDER]), F.struct(*_ORDER)
        spent = F.col("_stop.so_far") - F.col("_stop.amount")
        unsure = F.col("_stop.so_far") <= F.lit(limit + NEAR)
        fits = F.col("amount") <= F.lit(limit + NEAR) - spent
        kept.append(marked.filter(F.col("_stop").isNull() | (own < stop) | (unsure & fits)).select(*columns))
        left = _stored(marked.filter(F.col("_stop").isNotNull() & ~unsure & (own > stop) & fits).select(*columns, spent.cast("decimal(38,18)").alias("base")), f"{folder}/left{number}")
        number += 1

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        month, spent = None, 0.0
        for batch in batches:
            taken, sums = [], []
            for n, (own, eur) in enumerate(zip(batch.column("month").to_pylist(), batch.column("eur").to_pylist(), strict=True)):
                month, spent = own, spent if own == month else 0.0
                if spent + eur <= budget:
                    spent += eur
                    taken.append(n)
                    sums.append(spent)
            own = batch.take(pa.array(taken, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(own.column(c) for c in keys), pa.array(sums, pa.float64())], [*keys, "spent"])

    stream = kept[0]
    for more in kept[1:]:
        stream = stream.unionByName(more)
    stream = stream.repartition(F.col("month")).sortWithinPartitions("month", *_ORDER)
    keys = ["month", "part", *_ORDER]
    told = _stored(stream.mapInArrow(loop, StructType([*(rows.schema[c] for c in keys), StructField("spent", DoubleType())])), f"{folder}/told")
    # What was told of a call goes right before it, so one pass over each range gives both what became of a call and what was spent until then.
    both = rows.select(*keys, "eur", F.lit(None).cast("double").alias("spent"), F.lit(1).alias("_call")).unionByName(told.withColumn("_call", F.lit(0)), allowMissingColumns=True)
    order = Window.partitionBy("month", "part").orderBy(*_ORDER, "_call")
    judged = both.withColumns({"admitted": F.coalesce(F.lag("_call").over(order) == 0, F.lit(False)), "_inside": F.max("spent").over(order.rowsBetween(Window.unboundedPreceding, 0))}).filter("_call = 1")
    ahead = _before(both.groupBy("month", "part").agg(F.max("spent").alias("_t")), F.max("_t"))
    spent = F.coalesce(F.greatest("before", "_inside"), F.lit(0.0))
    return judged.join(ahead, ["month", "part"]).select(F.nullif("month", F.lit(no_month)).alias("month"), "ord", "eur", "admitted", spent.alias("spent"))


def warnings(calls: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Per month: when spending (month, at, ord, eur) reached the warning share, and when the whole budget; null if never."""
    running = F.sum("eur").over(Window.partitionBy("month").orderBy("at", "ord").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = calls.withColumn("cum", running)
    reached = lambda share: F.min(F.when(F.col("cum") >= share * budget, F.col("at")))
    return rows.groupBy("month").agg(reached(WARN_AT).alias("warned_at"), reached(1.0).alias("exhausted_at"))
