"""Health of sources: medians over the last runs, degradation, and the states that follow, as windows over the runs of each source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values.
LEAST_SHARE, EMPTY_JUMP, RUNS, DAYS_TO_DISABLE = 0.3, 0.4, 7, 7


def judged(runs: DataFrame) -> DataFrame:
    """runs (source_id, run, extracted, empty_rate, error) with median7 (of the seven runs before), degraded, streak (degraded runs in a row) and status.

    Degraded: an error; nothing where there was something; under 30 % of the median; or 40 points more empty fields than the run before.
    """
    order = Window.partitionBy("source_id").orderBy("run")
    before = F.expr(f"percentile(extracted, 0.5) OVER (PARTITION BY source_id ORDER BY run ROWS BETWEEN {RUNS} PRECEDING AND 1 PRECEDING)")
    rows = runs.withColumn("median7", F.coalesce(before, F.lit(0.0))).withColumn("jump", F.col("empty_rate") - F.lag("empty_rate").over(order))
    low = (F.col("median7") > 0) & ((F.col("extracted") == 0) | (F.col("extracted") < LEAST_SHARE * F.col("median7")))
    rows = rows.withColumn("degraded", F.col("error").isNotNull() | low | F.coalesce(F.col("jump") > EMPTY_JUMP, F.lit(False)))
    runs_ok = F.sum((~F.col("degraded")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    island = Window.partitionBy("source_id", "_island").orderBy("run").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_island", runs_ok).withColumn("streak", F.sum(F.col("degraded").cast("int")).over(island).cast("int")).drop("_island", "jump")
    return rows.withColumn("status", F.when(F.col("streak") >= DAYS_TO_DISABLE, "disabled").when(F.col("degraded"), "degraded").otherwise("ok"))


def with_blocks(rows: DataFrame, blocked: DataFrame) -> DataFrame:
    """judged() rows where sources (source_id, since) are blocked from then on, whatever they do; with the edges just_degraded and just_disabled."""
    order = Window.partitionBy("source_id").orderBy("run")
    joined = rows.join(blocked.groupBy("source_id").agg(F.min("since").alias("_since")), "source_id", "left")
    joined = joined.withColumn("status", F.when(F.col("run") >= F.col("_since"), "blocked").otherwise(F.col("status"))).drop("_since")
    was = F.coalesce(F.lag("status").over(order), F.lit("ok"))
    return joined.withColumn("just_degraded", (F.col("status") == "degraded") & (was != "degraded")).withColumn("just_disabled", (F.col("status") == "disabled") & (was != "disabled"))


def latest(rows: DataFrame) -> DataFrame:
    """The last run of each source with its status and the median of its last seven runs."""
    own = F.expr(f"percentile(extracted, 0.5) OVER (PARTITION BY source_id ORDER BY run ROWS BETWEEN {RUNS - 1} PRECEDING AND CURRENT ROW)")
    last = F.row_number().over(Window.partitionBy("source_id").orderBy(F.desc("run")))
    return rows.withColumn("median_extracted", own).withColumn("_n", last).filter("_n = 1").drop("_n")


def stale(sources: DataFrame, now, days: int = 180) -> DataFrame:
    """Sources (id, verified_at) never verified (age null) or more than so many days ago."""
    age = F.datediff(F.lit(now).cast("date"), F.col("verified_at").cast("date"))
    return sources.withColumn("age_days", age).filter(F.col("age_days").isNull() | (F.col("age_days") > days))
