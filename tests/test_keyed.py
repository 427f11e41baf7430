"""Keyed tables: only touched parts change, readers see whole versions, freshness, keys with nulls and repeats, failed writes."""

from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from harrow.sources.keyed import KeyedTable

SCHEMA = "k string, n int, first int, at timestamp"
NOW = datetime(2026, 1, 10)


def files(path: Path) -> set[str]:
    return {str(f) for f in (path / "data").rglob("*.parquet")}


def rows_of(t: KeyedTable) -> dict:
    return {r.k: (r.n, r.first) for r in t.current().collect()}


def test_upsert_touches_its_parts(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), 8).create()
    assert t.current().count() == 0 and t.lookup(spark.createDataFrame([("a",)], "k string")).first().hit is False
    rows = [(f"k{i}", i, i, NOW) for i in range(40)] + [(None, -1, -1, None)]
    t.upsert(spark.createDataFrame(rows, SCHEMA))
    before, want = files(tmp_path / "t"), {r[0]: r[1:3] for r in rows}
    assert rows_of(t) == want
    reader = t.current()
    new = [("k3", 300, 9, NOW), ("k3", 301, 9, NOW + timedelta(hours=1)), ("k3", 299, 9, NOW), (None, 7, 7, None)]
    t.upsert(spark.createDataFrame(new, SCHEMA).withColumn("extra", F.lit(1)), "at", ("first",))
    want |= {"k3": (301, 3), None: (7, -1)}
    assert rows_of(t) == want
    assert before < files(tmp_path / "t"), "no file that was there is gone or has another name"
    parts = lambda fs: {Path(f).parents[1].name for f in fs}
    assert len(parts(files(tmp_path / "t") - before)) <= 2 < len(parts(before))
    assert reader.count() == 41 and {r.n for r in reader.filter("k = 'k3'").collect()} == {3}, "who had begun sees the old version"
    t.delete(spark.createDataFrame([("k1",), (None,), ("none",)], "k string"))
    assert rows_of(t) == {k: v for k, v in want.items() if k not in ("k1", None)}
    t.upsert(spark.createDataFrame([], SCHEMA))
    assert len(rows_of(t)) == 39
    small = t.rewritten(str(tmp_path / "copy"))
    assert rows_of(small) == rows_of(t) and len(files(tmp_path / "copy")) < len(files(tmp_path / "t"))


def test_failed_write_is_not_seen(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), 4).create()
    t.upsert(spark.createDataFrame([("a", 1, 1, NOW), ("b", 2, 2, NOW)], SCHEMA))
    # What a writer leaves that dies between data and commit.
    orphan = t._with_part(spark.createDataFrame([("a", 9, 9, NOW)], SCHEMA)).withColumn("version", F.lit("2-dead"))
    orphan.write.mode("append").partitionBy("part", "version").parquet(str(tmp_path / "t" / "data"))
    assert rows_of(t) == {"a": (1, 1), "b": (2, 2)}
    t.upsert(spark.createDataFrame([("a", 3, 3, NOW)], SCHEMA))
    assert rows_of(t) == {"a": (3, 3), "b": (2, 2)}


def test_lookup_by_age(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), 4).create()
    ages = {"new": 1, "edge": 24, "old": 25}
    t.upsert(spark.createDataFrame([(k, h, h, NOW - timedelta(hours=h)) for k, h in ages.items()] + [("never", 0, 0, None)], SCHEMA))
    wanted = spark.createDataFrame([(k, i) for i, k in enumerate(["new", "edge", "old", "never", "gone", None, "new"])], "k string, i int")
    got = {r.i: (r.hit, r.n) for r in t.lookup(wanted, "at", 24, F.lit(NOW)).collect()}
    assert got == {0: (True, 1), 1: (False, None), 2: (False, None), 3: (False, None), 4: (False, None), 5: (False, None), 6: (True, 1)}
    assert sum(r.hit for r in t.lookup(wanted).collect()) == 5
    plan = t.lookup(spark.createDataFrame([("new",)], "k string"))._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower()
