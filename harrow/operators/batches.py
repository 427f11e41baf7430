"""Batches of model calls as tables: decisions for the log, results against stored jobs, what is missing, expired or seen already; and a crawl's bookkeeping."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.functions.identity import PROMPT_VERSIONS, job_key

#: Fixed value: hours after which a batch without results is given up.
EXPIRY_HOURS = 26
_DECISION = ("at", "cluster_id", "collection", "stage", "outcome", "reason", "score", "model", "prompt_version", "input_tokens", "output_tokens")


def _decided(rows: DataFrame, stage: str, passed: str, reason: Column, at: Column, version: str | None, **more: Column) -> DataFrame:
    kinds = {"score": "double", "model": "string", "input_tokens": "long", "output_tokens": "long"}
    columns = {"at": at, "stage": F.lit(stage), "outcome": F.when(F.coalesce(F.col(passed), F.lit(False)), "passed").otherwise("rejected"), "reason": reason, "prompt_version": F.lit(version).cast("string")}
    columns |= {c: more.get(c, F.lit(None)).cast(kind) for c, kind in kinds.items()}
    return rows.select(*[columns.get(c, F.col(c)).alias(c) for c in _DECISION])


def model_decisions(rows: DataFrame, task: str, at: Column) -> DataFrame:
    """Log rows of a screening or writing (cluster_id, collection, digest, model, passed, input_tokens, output_tokens): the reason is the job's key, so the log is the cache."""
    more = {c: F.col(c) for c in ("model", "input_tokens", "output_tokens")}
    return _decided(rows, task, "passed", job_key(F.col("digest"), task, F.col("model")), at, PROMPT_VERSIONS[task], **more)


def stage_decisions(rows: DataFrame, stage: str, at: Column) -> DataFrame:
    """Log rows of a stage without a model (cluster_id, collection, passed, reason, score)."""
    return _decided(rows, stage, "passed", F.col("reason"), at, None, score=F.col("score"))


def collected(results: DataFrame, jobs: DataFrame) -> DataFrame:
    """results (custom_id, card) with the stored job's (custom_id, slug) slug, and outcome: no-job (nothing stored: to be warned of), unreadable (no card), or card."""
    joined = results.join(jobs.select("custom_id", "slug", F.lit(True).alias("_job")), "custom_id", "left")
    return joined.withColumn("outcome", F.when(F.col("_job").isNull(), "no-job").when(F.col("card").isNull(), "unreadable").otherwise("card")).drop("_job")


def missing(sent: DataFrame, returned: DataFrame, key: str) -> DataFrame:
    """What was sent and has no answer."""
    return sent.join(returned.select(key), key, "left_anti")


def batch_states(batches: DataFrame, now: datetime, hours: int = EXPIRY_HOURS) -> DataFrame:
    """batches (batch_id, submitted_at, ready) with state: ready, expired (too old and not ready), or waiting."""
    late = F.col("submitted_at") + F.make_interval(hours=F.lit(hours)) < F.lit(now).cast("timestamp")
    return batches.withColumn("state", F.when(F.coalesce("ready", F.lit(False)), "ready").when(F.coalesce(late, F.lit(False)), "expired").otherwise("waiting"))


def requeued(items: DataFrame, states: DataFrame) -> DataFrame:
    """The items (batch_id, ...) of expired batches: they go back to the queue."""
    return items.join(states.filter("state = 'expired'").select("batch_id"), "batch_id", "left_semi")


def unseen(results: DataFrame, done: DataFrame, key: str = "custom_id") -> DataFrame:
    """One row of each key that isn't done yet: a second run over the same results adds nothing."""
    return results.dropDuplicates([key]).join(done.select(key), key, "left_anti")


def requested(sources: DataFrame, collections: list[str]) -> DataFrame:
    """The sources (collections: array) of which some collection is asked for."""
    return sources.filter(F.arrays_overlap("collections", F.array(*[F.lit(c) for c in collections]).cast("array<string>")))


def crawl_totals(observations: DataFrame) -> DataFrame:
    """Sums of discovered, fetched and not_modified; zeros without rows."""
    return observations.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("discovered", "fetched", "not_modified")])


def pages_on(index: DataFrame, day: Column) -> DataFrame:
    """Per source how many of its pages (source_id, last_seen, status) were fetched that day; unchanged ones (304) don't count."""
    return index.groupBy("source_id").agg(F.count_if((F.to_date("last_seen") == day) & ~F.col("status").eqNullSafe(304)).alias("pages"))


def within(rows: DataFrame, day: str, now: datetime, days: int) -> DataFrame:
    """Rows whose day (text, yyyy-MM-dd) is at most so many days before now; later ones stay, days that don't exist go."""
    at = F.try_to_timestamp(F.col(day), F.lit("yyyy-MM-dd"))
    return rows.filter(at >= F.lit(now).cast("timestamp") - F.make_interval(days=F.lit(days)))
