"""Keyed tables: an upsert rewrites only the parts it touches, a reader sees a whole version, and rows past their time count as absent.

A table is a folder with two Parquet tables. `data` holds the rows by part (a hash of the key) and version; a write adds folders and changes none.
`versions` says which version of each part is in force as of each write; a write adds its one file last, and that is its commit. So a reader sees the
table before or after a write, a write that fails leaves rows that nobody reads, and files of untouched parts stay as they are. One writer at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from harrow.sources.writers import upserted

VERSIONS = "number long, part int, version string"


@dataclass(frozen=True)
class KeyedTable:
    """A table of `schema` at a path that driver and executors share, with one row for each key.

    parts is fixed when a table is first written; choose it so that a part fits a few tasks: it bounds both the table of versions and what the write of one row costs.
    """

    spark: SparkSession
    path: str
    schema: str | StructType
    key: tuple[str, ...]
    parts: int = 256
    _columns: list[str] = field(init=False, repr=False)

    def __post_init__(self):
        object.__setattr__(self, "_columns", self.spark.createDataFrame([], self.schema).columns)

    def create(self) -> KeyedTable:
        """Writes an empty table where there is none; an error where there is one."""
        self._with_part(self.spark.createDataFrame([], self.schema)).withColumn("version", F.lit("")).write.partitionBy("part", "version").parquet(f"{self.path}/data")
        self.spark.createDataFrame([], VERSIONS).write.parquet(f"{self.path}/versions")
        return self

    def current(self) -> DataFrame:
        """The rows in force now."""
        return self._rows(self._in_force()).select(*self._columns)

    def upsert(self, new: DataFrame, at: str | None = None, keep: tuple[str, ...] = ()) -> None:
        """The rows of new take the place of those with their keys; columns in keep (such as first_seen) stay as they were.

        Of several rows of one key the one with the greatest `at` counts, of equals the greatest as JSON. Null is a key like others. Columns of
        new that the table hasn't got are left out.
        """
        rows = new.select(*self._columns)
        order = F.struct(*([F.col(at)] if at else []), F.to_json(F.struct(*self._columns), {"ignoreNullFields": "false"}))
        best = rows.groupBy(*self.key).agg(F.max_by(F.struct(*self._columns), order).alias("_row")).select("_row.*")
        self._write(best, lambda old: upserted(old, best, list(self.key), list(keep)))

    def delete(self, gone: DataFrame) -> None:
        """Takes out the rows whose keys gone holds."""
        keys = gone.select(*self.key).distinct()
        self._write(keys, lambda old: old.alias("o").join(keys.alias("n"), self._same(), "left_anti"))

    def lookup(self, wanted: DataFrame, at: str | None = None, hours: float | None = None, now: Column | None = None) -> DataFrame:
        """wanted (the key's columns, any others) with the table's other columns and `hit`. With at, hours and now a row whose time is `hours` or
        more before now, or null, is absent. Rows of wanted that repeat stay; an absent row's columns are null."""
        others = [c for c in self._columns if c not in self.key]
        rows = self._rows(self._in_force(), wanted).select(*self._columns)
        if hours is not None:
            rows = rows.filter(F.col(at) > now - F.make_dt_interval(secs=F.lit(hours * 3600)))
        both = wanted.alias("o").join(rows.withColumn("_hit", F.lit(True)).alias("n"), self._same(), "left")
        return both.select("o.*", *[F.col(f"n.{c}").alias(c) for c in others], F.col("n._hit").isNotNull().alias("hit"))

    def rewritten(self, path: str) -> KeyedTable:
        """A copy at another path without the rows that are no longer in force."""
        out = KeyedTable(self.spark, path, self.schema, self.key, self.parts).create()
        out.upsert(self.current())
        return out

    def _same(self) -> Column:
        on = F.lit(True)
        for k in self.key:
            on = on & F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
        return on

    def _with_part(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("part", F.pmod(F.xxhash64(*self.key), F.lit(self.parts)).cast("int"))

    def _versions(self) -> DataFrame:
        return self.spark.read.schema(VERSIONS).parquet(f"{self.path}/versions")

    def _in_force(self) -> DataFrame:
        """part and version of the last write; at most one row for each part."""
        last = F.max("number").over(Window.partitionBy("part"))
        return self._versions().withColumn("_last", last).filter("number = _last").select("part", "version")

    def _rows(self, versions: DataFrame, of: DataFrame | None = None) -> DataFrame:
        """Rows of these versions; only folders of parts that hold keys of `of`. The broadcast side has at most one row a part, so Spark prunes folders by it."""
        if of is not None:
            versions = versions.join(F.broadcast(self._with_part(of).select("part").distinct()), "part", "left_semi")
        schema = self.spark.createDataFrame([], self.schema).schema.add("part", "integer").add("version", "string")
        return self.spark.read.schema(schema).parquet(f"{self.path}/data").join(F.broadcast(versions), ["part", "version"], "left_semi")

    def _write(self, touching: DataFrame, change) -> None:
        number = (self._versions().agg(F.max("number")).first()[0] or 0) + 1
        version = f"{number}-{uuid.uuid4().hex}"
        old = self._rows(self._in_force(), touching).select(*self._columns)
        out = self._with_part(change(old).select(*self._columns)).withColumn("version", F.lit(version))
        out.hint("rebalance", "part").write.mode("append").partitionBy("part", "version").parquet(f"{self.path}/data")
        touched = self._with_part(touching).select(F.lit(number).cast("long").alias("number"), "part", F.lit(version).alias("version")).distinct()
        touched.coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
