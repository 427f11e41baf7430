"""Streams in pieces: batches that expire, repeats within a bound, logs and replays that are run again after a crash."""

import os
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from harrow.streaming import flows

T0 = datetime(2024, 1, 1)


def at(hours):
    return T0 + timedelta(hours=hours)


class Fed:
    """A folder that a stream reads, one file a micro-batch."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.n = spark, str(folder), schema, 0
        os.makedirs(f"{self.folder}/in")

    def add(self, *rows):
        self.n += 1
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/in")


def drained(fed, stream):
    """All rows so far, and the rows of state that are left."""
    query = stream.writeStream.format("parquet").option("path", f"{fed.folder}/out").option("checkpointLocation", f"{fed.folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    left = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    return sorted(map(tuple, fed.spark.read.schema(stream.schema).parquet(f"{fed.folder}/out").collect()), key=str), left[-1] if left else None


@pytest.fixture
def batches(spark, tmp_path):
    return Fed(spark, tmp_path, flows.BATCH_EVENTS)


def test_batches_expire(batches):
    batches.add(("a", "submitted", at(0), ["i1", "i2"]), ("b", "submitted", at(0), ["i3"]), ("c", "submitted", at(1), None), ("d", "ready", at(1), None), ("e", "ready", at(2), None), (None, "submitted", at(0), []), ("x", "submitted", None, []))
    batches.add(("a", "ready", at(26), None), ("a", "ready", at(27), None), ("d", "submitted", at(0), ["i4"]), ("a", "submitted", at(3), ["again"]))
    got, _ = drained(batches, flows.batch_outcomes(batches.stream()))
    assert got == sorted([("a", "ready", at(26), None), ("d", "ready", at(1), None)], key=str)
    # A restart goes on from the state: b and c expire by what comes now, with their items back in the queue, and a result after that is late.
    batches.add(("z", "submitted", at(30), ["i9"]))
    batches.add(("b", "ready", at(31), None))
    due = lambda hours: at(hours + 26) + timedelta(milliseconds=1)
    got, held = drained(batches, flows.batch_outcomes(batches.stream()))
    more = [("b", "expired", due(0), None), ("b", "requeued", due(0), "i3"), ("b", "late", at(31), None), ("c", "expired", due(1), None), (None, "expired", due(0), None), ("e", "unknown", at(2), None)]
    assert got == sorted([("a", "ready", at(26), None), ("d", "ready", at(1), None), *more], key=str)
    batches.add(("y", "submitted", at(400), ["i8"]))
    got, left = drained(batches, flows.batch_outcomes(batches.stream()))
    assert [r[:2] for r in got if r[0] == "z"] == [("z", "expired"), ("z", "requeued")] and left < held and left <= 2


def test_late_in_one_batch(batches):
    batches.add(("a", "submitted", at(0), ["i1"]), ("a", "ready", at(27), None), ("b", "ready", at(3), None), ("b", "submitted", at(1), ["i2"]))
    batches.add(("w", "submitted", at(60), []))
    got, _ = drained(batches, flows.batch_outcomes(batches.stream()))
    assert [r[:2] for r in got if r[0] != "w"] == [("a", "expired"), ("a", "late"), ("a", "requeued"), ("b", "ready")]


def test_batches_share_groups(batches):
    """Many batches in few groups of state: each has its own outcome, and what is told and over leaves its group."""
    n = 300
    batches.add(*[(f"b{i}", "submitted", at(i % 5), [f"i{i}"]) for i in range(n)], *[(f"b{i}", "ready", at(i % 5 + 2), None) for i in range(0, n, 3)])
    batches.add(*[(f"b{i}", "ready", at(40), None) for i in range(1, n, 3)], ("z", "submitted", at(40), []))
    got, held = drained(batches, flows.batch_outcomes(batches.stream(), groups=4))
    want = [(f"b{i}", "ready") for i in range(0, n, 3)] + [(f"b{i}", o) for i in range(1, n, 3) for o in ("late", "expired", "requeued")] + [(f"b{i}", o) for i in range(2, n, 3) for o in ("expired", "requeued")]
    assert sorted(r[:2] for r in got) == sorted(want) and held <= 4
    batches.add(("y", "submitted", at(400), []))
    drained(batches, flows.batch_outcomes(batches.stream(), groups=4))
    batches.add(("y", "submitted", at(401), []))
    assert drained(batches, flows.batch_outcomes(batches.stream(), groups=4))[1] <= 2


def test_sights_within(spark, tmp_path):
    fed = Fed(spark, tmp_path, "k string, ts timestamp, n int")
    flow = lambda: flows.first_sights_within(fed.stream(), ["k"], "ts", "1 hour")
    fed.add(("a", at(0), 1), ("a", at(0), 1), (None, at(0), 2), (None, at(0), 2), ("b", None, 3))
    fed.add(("a", at(0.5), 4), ("c", at(10), 5))
    got, held = drained(fed, flow())
    assert [(r[0], r[2]) for r in got] == [("a", 1), ("c", 5), (None, 2)]
    fed.add(("a", at(9.5), 6), ("a", at(2), 7), ("d", at(40), 8))
    got, left = drained(fed, flow())
    assert sorted((r[0] or "", r[2]) for r in got) == [("", 2), ("a", 1), ("a", 6), ("c", 5), ("d", 8)]
    assert left <= held  # the keys whose time is over went


def test_log_is_written_once(spark, tmp_path):
    fed = Fed(spark, tmp_path, "id int, at timestamp, note struct<x: int>")
    fed.add((1, at(0), (1,)), (2, at(24 * 40), None))
    fed.add((3, None, (2,)))
    log = flows.logged(fed.stream(), fed.folder)
    assert sorted((r.id, r.month, r.batch) for r in log.collect()) == [(1, "2024-01", 0), (2, "2024-02", 0), (3, "none", 1)]
    # A crash between the write and the stream's commit: batch 1 runs again, over what half of it left behind.
    os.remove(f"{fed.folder}/checkpoint/commits/1")
    os.path.exists(f"{fed.folder}/checkpoint/commits/.1.crc") and os.remove(f"{fed.folder}/checkpoint/commits/.1.crc")
    shutil.copytree(f"{fed.folder}/log/batch=1/month=none", f"{fed.folder}/log/batch=1/month=2024-03")
    fed.add((4, at(1), None))
    log = flows.logged(fed.stream(), fed.folder)
    assert sorted((r.id, r.month, r.batch) for r in log.collect()) == [(1, "2024-01", 0), (2, "2024-02", 0), (3, "none", 1), (4, "2024-01", 2)]
    assert "PartitionFilters: [isnotnull(month" in log.filter("month = '2024-01'")._jdf.queryExecution().toString()


def test_empty_log(spark, tmp_path):
    fed = Fed(spark, tmp_path, "id int, at timestamp")
    assert flows.logged(fed.stream(), fed.folder).count() == 0


def test_replay(spark, tmp_path):
    fed = Fed(spark, tmp_path, "custom_id string, n int, v string")
    fed.add(("a", 2, "x"), ("a", 1, "y"), ("a", 1, "b"), (None, 5, "x"), (None, 4, "x"))
    fed.add(("a", 0, "z"), ("b", 1, "x"), ("b", 1, "x"), (None, 0, "x"))
    want = [("", 4, "x"), ("a", 1, "b"), ("b", 1, "x")]
    read = lambda: sorted((r.custom_id or "", r.n, r.v) for r in flows.replayed(fed.stream(), fed.folder, order=["n"]).collect())
    assert read() == want and read() == want
    os.remove(f"{fed.folder}/checkpoint/commits/1")
    os.path.exists(f"{fed.folder}/checkpoint/commits/.1.crc") and os.remove(f"{fed.folder}/checkpoint/commits/.1.crc")
    fed.add(("b", 0, "late"), ("c", 1, "x"))
    assert read() == [*want, ("c", 1, "x")]
    folders = [p for p in os.listdir(f"{fed.folder}/results") if p.startswith("batch=")]
    assert sorted(folders) == ["batch=-1", "batch=0", "batch=1", "batch=2"]
    assert spark.read.parquet(f"{fed.folder}/results").filter(F.col("custom_id") == "a").count() == 1
