"""Sinks: sorted line-delimited JSON, appended logs, and keyed upserts of partitioned tables. Spark's commit protocol makes each write whole or absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sorted_ndjson(rows: DataFrame, path: str, key: list[str]) -> None:
    """Overwrites a folder with rows in the order of key; a range partitioning keeps the order over all files."""
    rows.repartitionByRange(*key).sortWithinPartitions(*key).write.mode("overwrite").json(path)


def pretty_json(rows: DataFrame, path: str) -> None:
    """Overwrites a folder with one indented JSON document for each row, nulls left out."""
    rows.select(F.to_json(F.struct(*rows.columns), {"pretty": "true"})).write.mode("overwrite").text(path)


def append_log(rows: DataFrame, path: str, at: str = "at") -> None:
    """Appends to a log partitioned by month."""
    rows.withColumn("month", F.date_format(at, "yyyy-MM")).write.mode("append").partitionBy("month").parquet(path)


def upserted(old: DataFrame, new: DataFrame, key: list[str], keep: list[str] = ()) -> DataFrame:
    """old with the rows of new by key; columns in keep (such as first_seen) stay as they were. Nulls in a key match each other."""
    o, n = old.alias("o"), new.alias("n")
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key]
    both = o.withColumn("_o", F.lit(True)).alias("o").join(n.withColumn("_n", F.lit(True)).alias("n"), on, "full_outer")
    pick = lambda c: F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")) if c in keep else F.when(F.col("n._n"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    return both.select(*[pick(c).alias(c) for c in old.columns])


def inserted_if_absent(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    fresh = new.dropDuplicates(key).join(old.select(*key), key, "left_anti")
    return old.unionByName(fresh.select(*old.columns))


def deleted(old: DataFrame, gone: DataFrame, key: list[str]) -> DataFrame:
    return old.join(gone.select(*key).distinct(), key, "left_anti")


def moved(cards: DataFrame, slugs: DataFrame, to: str) -> DataFrame:
    """cards (slug, status) with the status of the given slugs changed: how a card is archived or restored."""
    hit = slugs.select("slug").distinct().withColumn("_hit", F.lit(True))
    return cards.join(hit, "slug", "left").withColumn("status", F.when(F.col("_hit"), F.lit(to)).otherwise(F.col("status"))).select(*cards.columns)


def sorted_map(m: Column) -> Column:
    """A map with its keys in order."""
    return F.map_from_entries(F.array_sort(F.map_entries(m)))
