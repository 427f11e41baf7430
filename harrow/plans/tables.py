"""The tables that queries read, and records made out of them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOW = datetime(2001, 6, 15, 12)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with its zoneless times read as UTC instants."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.withColumns({c: F.col(c).cast("timestamp") for c, kind in rows.dtypes if kind == "timestamp_ntz"})


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt to as many tasks as a shuffle has, by key: where each small row is much work, a file of few megabytes would be one task. The number is
    given, so that adaptive execution doesn't put small partitions together again."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def candidate_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What candidates are made of: one row for each part, supplier and month of shipping, in which no long text stands yet. Dealt by part, which serves
    the counting, the join and what goes by part and month afterwards."""
    months = dealt(table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", F.date_trunc("month", "l_shipdate").alias("m")), "l_partkey")
    counted = months.groupBy("l_partkey", "l_suppkey", "m").agg(F.count("*").alias("n"))
    return counted.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select("l_partkey", "l_suppkey", "m", "n", "p_name", "p_brand", "p_type")


def candidate_ord() -> Column:
    return (F.col("l_partkey") * 1_000_000 + F.col("l_suppkey") * 1000 + (F.year("m") - 1990) * 12 + F.month("m")).cast("long")


def as_candidates(facts: DataFrame, *kept: str) -> DataFrame:
    """Candidates out of their facts, and columns that are kept."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    return facts.select(
        candidate_ord().alias("ord"), F.concat(F.lit("s"), supp % 20).alias("source_id"),
        F.when(supp % 3 == 0, "A").when(supp % 3 == 1, "B").otherwise("C").alias("tier"), ((supp % 11) / 10.0).alias("trust"),
        F.concat(F.lit("https://s"), supp % 20, F.lit(".example.org/"), F.when(part % 50 == 0, "promo/").otherwise(""), part).alias("url"),
        F.when(part % 3 == 0, "plans").when(part % 3 == 1, "shows").otherwise("museums").alias("collection"), F.concat_ws(" ", "p_name", "p_brand", part.cast("string")).alias("title"),
        F.expr("repeat(concat(p_type, ' ', p_name, '. '), cast(l_suppkey % 15 + 1 as int))").alias("description"), F.col("m").alias("start_at"),
        F.when(supp % 4 != 0, F.col("m") + F.expr("INTERVAL 20 DAYS")).alias("end_at"), (F.lit(41.15) + (part % 300) * F.lit(0.0015) + (supp % 3) * F.lit(0.0005)).alias("lat"),
        (F.lit(1.95) + (part * 7 % 350) * F.lit(0.001)).alias("lng"), "n", *kept,
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates out of the star schema: one for each part, supplier and month of shipping."""
    return as_candidates(candidate_facts(spark, sf_dir))
