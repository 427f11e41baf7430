"""The incremental flows as Structured Streaming: counts by day, first sights of a key, batches that are ready or expire, a log by month that a
repeated batch doesn't double, results that come again, and health of sources as keyed state.

Each takes a streaming DataFrame and runs what is available, so a scheduled run picks up where the last one ended.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from statistics import median

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from harrow.operators.batches import EXPIRY_HOURS
from harrow.operators.health import DAYS_TO_DISABLE, EMPTY_JUMP, LEAST_SHARE, RUNS


def files(spark: SparkSession, path: str, schema: StructType, glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(path)


def drained(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is available and returns what it wrote. With mode complete each batch replaces the table."""
    out, checkpoint = f"{folder}/table", f"{folder}/checkpoint"
    if mode == "append":
        writer = stream.writeStream.format("parquet").option("path", out)
    else:
        writer = stream.writeStream.foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(out))
    query = writer.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def daily_counts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Events (ts, event_type) by day and type; events later than that are left out of finished days."""
    days = events.withWatermark("ts", late).groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"))
    return days.select(F.col("window.start").alias("day"), "event_type", "n")


def first_sights(rows: DataFrame, key: list[str]) -> DataFrame:
    """Each key once, when it is first seen; its state is kept for good."""
    return rows.select(*key).dropDuplicates(key)


def first_sights_within(rows: DataFrame, key: list[str], at: str, span: str) -> DataFrame:
    """rows, of each key the first to arrive within `span` of event time `at`. A key's state goes when the watermark, `span` behind the latest time,
    passes its row's time by that much: what comes again after that counts as new, and what is older than the watermark is left out. Rows of one
    batch with the same key give one of them; nulls in a key are equal to each other; a row without a time is left out."""
    return rows.filter(F.col(at).isNotNull()).withWatermark(at, span).dropDuplicatesWithinWatermark(key)


def _ddl(schema: StructType, more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), more])


def _by_batch(stream: DataFrame, out: str, checkpoint: str, part: str, make: Callable[[DataFrame, int], DataFrame]) -> None:
    """Runs a stream; what `make` gives of micro-batch n becomes the folder batch=n of out, by `part`. Spark's commit writes it whole or not at all and
    a batch that is run again overwrites it, so a crash before the stream's own commit doubles nothing."""

    def add(rows: DataFrame, number: int) -> None:
        make(rows, number).write.mode("overwrite").partitionBy(part).parquet(f"{out}/batch={number}")

    make(stream.sparkSession.createDataFrame([], stream.schema), -1).limit(0).write.mode("ignore").partitionBy(part).parquet(f"{out}/batch=-1")
    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def logged(stream: DataFrame, folder: str, at: str = "at") -> DataFrame:
    """Appends a stream to a log in folder, each micro-batch once, and returns the log with the columns month and batch.

    The log is partitioned by both, so a month is read from its own folders. Rows without a time go to the month 'none'.
    """
    out = f"{folder}/log"
    _by_batch(stream, out, f"{folder}/checkpoint", "month", lambda rows, _: rows.withColumn("month", F.coalesce(F.date_format(at, "yyyy-MM"), F.lit("none"))))
    return stream.sparkSession.read.schema(_ddl(stream.schema, "month string, batch long")).option("basePath", out).parquet(out)


#: Folders that the keys of results are dealt over.
KEY_PARTS = 64


def replayed(results: DataFrame, folder: str, key: str = "custom_id", order: list[str] = ()) -> DataFrame:
    """Writes each key's first result once, however often its files are read again, and returns the table.

    First is the micro-batch that brings it first, and in that the row with the least values of `order`, then of all columns (which can be compared,
    so no maps). Stored rows lie in folders by hash of the key; a batch reads the keys of those folders that its own keys can be in, and of batches
    before it, so one that is run again doesn't take its own rows for done. Null is a key like any other.
    """
    out, columns = f"{folder}/results", results.columns
    schema = _ddl(results.schema, "key_part int, batch long")

    def new(rows: DataFrame, number: int) -> DataFrame:
        first = F.min_by(F.struct(*columns), F.struct(*order, *columns)).alias("r")  # combined before the shuffle, so a key of many rows does no harm
        own = rows.groupBy(key).agg(first).select("r.*").withColumn("key_part", F.pmod(F.xxhash64(key), F.lit(KEY_PARTS)).cast("int"))
        if number <= 0:
            return own
        parts = [r.key_part for r in rows.select(F.pmod(F.xxhash64(key), F.lit(KEY_PARTS)).cast("int").alias("key_part")).distinct().collect()]  # KEY_PARTS at most
        done = rows.sparkSession.read.schema(schema).option("basePath", out).parquet(out).filter(F.col("key_part").isin(parts) & (F.col("batch") < number))
        known = done.select(F.col(key).alias("_key"), F.col("key_part").alias("_part"))
        return own.join(known, F.col("_key").eqNullSafe(F.col(key)) & (F.col("_part") == F.col("key_part")), "left_anti")

    _by_batch(results, out, f"{folder}/checkpoint", "key_part", new)
    return results.sparkSession.read.schema(schema).option("basePath", out).parquet(out).select(*columns)


BATCH_EVENTS = "batch_id string, kind string, at timestamp, items array<string>"
#: Groups that batches are dealt over by hash; a group's state holds its batches, as a call of Python for each batch would cost more than its work.
BATCH_GROUPS = 4096


def batch_outcomes(events: DataFrame, hours: int = EXPIRY_HOURS, late: str = "1 hour", groups: int = BATCH_GROUPS) -> DataFrame:
    """events (batch_id, kind 'submitted' with items or 'ready', at) of batches to (batch_id, outcome, at, item).

    A result up to `hours` after its submission (that instant too) makes the batch 'ready', at the result's time. Without one it is 'expired' at the
    instant after, when the watermark (`late` behind the latest event) has passed it, and each item goes back, as a row 'requeued'; then its state is
    dropped but for the time of submission, which goes after another `hours`. A result for an expired batch is 'late' and changes nothing, as is one
    whose time is beyond the span; a second result for a batch that is ready gives nothing, nor does a second submission while state is held.
    A result that comes before its submission waits for it, and is 'unknown' once the span has passed without one. Events without a time are left out.
    """
    span = hours * 3_600_000

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Of each batch, in milliseconds: when submitted, when its result came (both -1 if not yet), what was told of it, its items, and when its time is up.
        held = {k: [*v] for k, *v in zip(*state.get, strict=True)} if state.exists else {}
        out: list[tuple] = []
        now = state.getCurrentWatermarkMs()
        come: dict[str | None, list[tuple]] = {}
        for part in () if state.hasTimedOut else parts:
            for batch, kind, ms, sent in zip(part["batch_id"], part["kind"], part["ms"], part["sent"], strict=True):
                come.setdefault(batch, []).append((int(ms), kind != "submitted", list(sent), kind))
        for batch, rows in come.items():
            submitted, result, told, items, _ = held.get(batch, (-1, -1, "", [], 0))
            for ms, _, sent, kind in sorted(rows, key=lambda r: r[:3]):
                if kind == "submitted" and submitted < 0:
                    submitted, items = ms, sent
                elif kind == "ready" and told == "expired" or kind == "ready" and submitted >= 0 and not told and ms > submitted + span:
                    out.append((batch, "late", ms, None))
                elif kind == "ready" and result < 0:
                    result = ms
                if submitted >= 0 and not told and 0 <= result <= submitted + span:
                    told = "ready"
                    out.append((batch, told, result, None))
            since = submitted if submitted >= 0 else result
            if since >= 0:
                held[batch] = [submitted, result, told, items if not told else [], max(since + span + 1 + (span if told else 0), now + 1)]
        for batch in [k for k, v in held.items() if v[4] < now and k not in come]:
            submitted, result, told, items, _ = held[batch]
            if told or submitted < 0:
                if not told:
                    out.append((batch, "unknown", result, None))
                del held[batch]
            else:
                out += [(batch, "expired", submitted + span + 1, None), *((batch, "requeued", submitted + span + 1, item) for item in items)]
                held[batch] = [submitted, result, "expired", [], max(submitted + 2 * span + 1, now + 1)]
        if held:
            state.update(tuple(map(list, zip(*((k, *v) for k, v in held.items()), strict=True))))
            state.setTimeoutTimestamp(max(min(v[4] for v in held.values()), now + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["batch_id", "outcome", "ms", "item"])

    timed = events.filter(F.col("at").isNotNull()).withWatermark("at", late)
    timed = timed.select(F.pmod(F.xxhash64("batch_id"), F.lit(groups)).alias("_group"), "batch_id", "kind", "at", F.unix_millis("at").alias("ms"), F.coalesce("items", F.array().cast("array<string>")).alias("sent"))
    held = "ids array<string>, submitted array<bigint>, results array<bigint>, told array<string>, items array<array<string>>, due array<bigint>"
    told = timed.groupBy("_group").applyInPandasWithState(step, "batch_id string, outcome string, ms long, item string", held, "append", GroupStateTimeout.EventTimeTimeout)
    return told.select("batch_id", "outcome", F.timestamp_millis("ms").alias("at"), "item")


HEALTH = "source_id string, run timestamp, extracted bigint, empty_rate double, degraded boolean, streak int, status string"


def source_health(runs: DataFrame) -> DataFrame:
    """runs (source_id, run, extracted, empty_rate, error) judged one after the other; the state of a source is its last seven counts, empty rate and streak."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        counts, rate, streak = state.get if state.exists else ([], None, 0)
        counts, out = list(counts), []
        for r in pd.concat(list(batches)).sort_values("run").itertuples(index=False):
            usual = median(counts) if counts else 0
            low = usual > 0 and (r.extracted == 0 or r.extracted < LEAST_SHARE * usual)
            bad = bool(isinstance(r.error, str) or low or (rate is not None and r.empty_rate - rate > EMPTY_JUMP))
            streak = streak + 1 if bad else 0
            counts, rate = [*counts, int(r.extracted)][-RUNS:], float(r.empty_rate)
            out.append((key[0], r.run, r.extracted, r.empty_rate, bad, streak, "disabled" if streak >= DAYS_TO_DISABLE else "degraded" if bad else "ok"))
        state.update((counts, rate, streak))
        yield pd.DataFrame(out, columns=["source_id", "run", "extracted", "empty_rate", "degraded", "streak", "status"])

    return runs.groupBy("source_id").applyInPandasWithState(step, HEALTH, "counts array<bigint>, rate double, streak int", "append", GroupStateTimeout.NoTimeout)
