"""Queries over event logs, spending and health of sources, and the streaming flows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.operators import health, ledger, metrics
from harrow.plans.tables import table
from harrow.sources.shared import shared_folder as _folder
from harrow.streaming import flows


def funnel_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("event_type").alias("stage"), F.when(F.col("value") > 5, "passed").otherwise("rejected").alias("outcome"))
    return metrics.funnel(rows)


def _runs(spark: SparkSession, d: str) -> DataFrame:
    """Per event type and day a run: its events, the share with values under 2, and an error on some days."""
    day = F.date_trunc("day", "ts")
    rows = table(spark, d, "events").groupBy(F.col("event_type").alias("source_id"), day.alias("run")).agg(F.count("*").alias("n"), F.avg((F.col("value") < 2).cast("int")).alias("empty_rate"))
    k = F.dayofmonth("run")
    extracted = F.when(k.between(10, 18), F.lit(0)).when(k % 11 == 0, (F.col("n") / 10).cast("long")).otherwise(F.col("n"))
    return rows.select("source_id", "run", extracted.cast("long").alias("extracted"), F.round("empty_rate", 6).alias("empty_rate"), F.when(k == 25, "timeout").alias("error"))


_RUNS = """runs AS (SELECT event_type AS source_id, date_trunc('day', ts)::TIMESTAMP AS run, CASE WHEN day(any_value(ts)) BETWEEN 10 AND 18 THEN 0 WHEN day(any_value(ts)) % 11 = 0 THEN count(*) // 10 ELSE count(*) END AS extracted, round(avg((value < 2)::INT), 6) AS empty_rate, CASE WHEN day(any_value(ts)) = 25 THEN 'timeout' END AS error FROM events GROUP BY event_type, date_trunc('day', ts)),
m AS (SELECT *, coalesce(quantile_cont(extracted, 0.5) OVER (PARTITION BY source_id ORDER BY run ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS median7, empty_rate - lag(empty_rate) OVER (PARTITION BY source_id ORDER BY run) AS jump FROM runs),
g AS (SELECT *, error IS NOT NULL OR (median7 > 0 AND (extracted = 0 OR extracted < 0.3 * median7)) OR coalesce(jump > 0.4, false) AS degraded FROM m),
i AS (SELECT *, sum((NOT degraded)::INT) OVER (PARTITION BY source_id ORDER BY run) AS island FROM g),
judged AS (SELECT *, sum(degraded::INT) OVER (PARTITION BY source_id, island ORDER BY run) AS streak FROM i),
stated AS (SELECT *, CASE WHEN streak >= 7 THEN 'disabled' WHEN degraded THEN 'degraded' ELSE 'ok' END AS status FROM judged)"""


def health_rolling_median(spark: SparkSession, d: str) -> DataFrame:
    return health.judged(_runs(spark, d)).select("source_id", "run", "extracted", "median7", "degraded", F.col("streak").cast("long").alias("streak"), "status")


def health_blocks(spark: SparkSession, d: str) -> DataFrame:
    blocked = spark.createDataFrame([("click", "2024-01-20 00:00:00")], "source_id string, since string").select("source_id", F.col("since").cast("timestamp").alias("since"))
    rows = health.with_blocks(health.judged(_runs(spark, d)), blocked)
    return rows.select("source_id", "run", "status", "just_degraded", "just_disabled")


def health_latest(spark: SparkSession, d: str) -> DataFrame:
    return health.latest(health.judged(_runs(spark, d))).select("source_id", "run", "status", "median_extracted")


def health_tier_override(spark: SparkSession, d: str) -> DataFrame:
    from harrow.operators import scoring

    status = health.judged(_runs(spark, d)).filter("run = timestamp'2024-01-17 00:00:00'").select("source_id", "status")
    rows = table(spark, d, "events").select(F.col("event_type").alias("source_id"), F.lit("A").alias("tier"), F.lit(0.8).alias("trust"))
    return scoring.degraded_trust(rows, status).groupBy("source_id", "tier", "trust").agg(F.count("*").alias("n"))


def _calls(spark: SparkSession, d: str) -> DataFrame:
    """Orders as calls of a model: their price as tokens."""
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("ord"), F.col("o_orderdate").alias("at"), F.col("o_orderstatus").alias("model"), (F.col("o_orderkey") * 37 % 90_000).alias("input_tokens"), (F.col("o_orderkey") * 11 % 20_000).alias("output_tokens"), F.col("o_custkey").alias("customer"))


def _priced(spark: SparkSession, d: str) -> DataFrame:
    pricing = spark.createDataFrame([("F", 0.1, 0.4), ("O", 1.0, 4.0), ("P", 3.0, 15.0)], "model string, input_usd double, output_usd double")
    return ledger.cost(_calls(spark, d), F.broadcast(pricing))


_CALLS = "calls AS (SELECT o_orderkey AS ord, o_orderdate AS ts, strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus AS model, o_custkey AS customer, (((o_orderkey * 37 % 90000) / 1e6 * CASE o_orderstatus WHEN 'F' THEN 0.1 WHEN 'O' THEN 1.0 ELSE 3.0 END + (o_orderkey * 11 % 20000) / 1e6 * CASE o_orderstatus WHEN 'F' THEN 0.4 WHEN 'O' THEN 4.0 ELSE 15.0 END) * 0.93)::DOUBLE AS eur FROM orders)"


def ledger_by_model(spark: SparkSession, d: str) -> DataFrame:
    rows = ledger.totals(_priced(spark, d))
    return rows.select("month", F.round("eur", 3).alias("eur"), "calls", F.array_join(F.map_keys("by_model"), ",").alias("models"))


def ledger_budget_guard(spark: SparkSession, d: str) -> DataFrame:
    rows = _priced(spark, d).select(F.date_format("at", "yyyy-MM").alias("month"), "ord", F.round("eur", 4).alias("eur"))
    return ledger.guard(rows).groupBy("month").agg(F.count_if("admitted").alias("admitted"), F.round(F.max("spent"), 4).alias("spent"))


def ledger_settle(spark: SparkSession, d: str) -> DataFrame:
    """Calls in batches by customer and month: pending ones are replaced by the settled one of their batch."""
    rows = _priced(spark, d).select("ord", "at", F.round("eur", 6).alias("eur"), F.when(F.col("ord") % 5 != 0, F.concat_ws("-", "customer", F.date_format("at", "yyyy-MM"))).alias("batch_id"), (F.col("ord") % 3 != 0).alias("pending"))
    return ledger.settled(rows).groupBy("pending").agg(F.count("*").alias("n"), F.count("batch_id").alias("batches"))


def ledger_warnings(spark: SparkSession, d: str) -> DataFrame:
    rows = _priced(spark, d).select(F.date_format("at", "yyyy-MM").alias("month"), "at", "ord", F.round("eur", 4).alias("eur"))
    return ledger.warnings(rows)


def approximate_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", ledger.approximate_tokens(F.col("text")).alias("tokens"))


def stale_sources(spark: SparkSession, d: str) -> DataFrame:
    from harrow.plans.tables import NOW

    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderdate")).alias("verified_at"))
    return health.stale(rows, NOW).select("id", F.col("age_days").cast("long").alias("age_days"))


def _stream(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/events.parquet")
    return flows.files(spark, d, rows.schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def stream_daily_counts(spark: SparkSession, d: str) -> DataFrame:
    return flows.drained(flows.daily_counts(_stream(spark, d)), _folder(spark), "complete")


def stream_first_sights(spark: SparkSession, d: str) -> DataFrame:
    return flows.drained(flows.first_sights(_stream(spark, d), ["event_type", "user_id"]), _folder(spark))


def stream_sights_within(spark: SparkSession, d: str) -> DataFrame:
    """The table is one batch, before which no watermark stands: of each key one row, whatever the span."""
    rows = flows.first_sights_within(_stream(spark, d).select("event_type", "user_id", "ts"), ["event_type", "user_id"], "ts", "2 days")
    return flows.drained(rows, _folder(spark)).select("event_type", "user_id")


def stream_month_log(spark: SparkSession, d: str) -> DataFrame:
    rows = _stream(spark, d).withColumn("ts", F.expr("ts + make_interval(0, cast(user_id % 3 as int))"))
    return flows.logged(rows, _folder(spark), "ts").groupBy("month").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


def stream_batch_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """A user's events of one day are a batch, submitted at the first; most get a result up to 40 hours later. They arrive in four parts by time."""
    folder = _folder(spark)
    sent = table(spark, d, "events").groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(F.min("ts").alias("at"), F.min("event_id").alias("low"))
    sent = sent.select(F.concat_ws("-", "user_id", F.date_format("day", "dd")).alias("batch_id"), "at", "user_id", F.array(F.concat(F.lit("i"), "low")).alias("items"))
    sent.write.parquet(f"{folder}/sent")
    sent = spark.read.schema(sent.schema).parquet(f"{folder}/sent")
    ready = sent.filter("user_id % 4 <> 0").select("batch_id", F.lit("ready").alias("kind"), F.expr("at + make_interval(0, 0, 0, 0, cast(user_id * 7 % 41 as int))").alias("at"), F.lit(None).cast("array<string>").alias("items"))
    events = sent.select("batch_id", F.lit("submitted").alias("kind"), "at", "items").unionByName(ready)
    week = F.least(F.lit(3), F.floor((F.dayofyear("at") - 1) / 8))
    for k in range(4):
        events.filter(week == k).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(flows.BATCH_EVENTS).parquet(f"{folder}/in")
        told = flows.drained(flows.batch_outcomes(stream), folder)  # a run a part, so that parts come in order, each whole
    return told.withColumn("at", F.date_trunc("second", "at"))


_OUTCOMES = """s AS (SELECT user_id || '-' || strftime(ts, '%d') AS batch_id, any_value(user_id) AS user_id, min(ts) AS sent, 'i' || min(event_id) AS item FROM events GROUP BY 1),
b AS (SELECT *, CASE WHEN user_id % 4 <> 0 THEN sent + to_hours((user_id * 7 % 41)::INT) END AS result, date_trunc('milliseconds', sent) + INTERVAL '26 hours 1 millisecond' AS due FROM s),
w AS (SELECT greatest(max(sent), max(result)) - INTERVAL 1 HOUR AS passed FROM b),
o AS (SELECT batch_id, 'ready' AS outcome, result AS moment, NULL AS item FROM b WHERE result < due UNION ALL SELECT batch_id, 'late', result, NULL FROM b WHERE result >= due
  UNION ALL SELECT batch_id, unnest(['expired', 'requeued']), due, unnest([NULL, item]) FROM b, w WHERE due < passed AND NOT coalesce(result < due, false))"""


def stream_health(spark: SparkSession, d: str) -> DataFrame:
    folder = _folder(spark)
    runs = _runs(spark, d)
    runs.write.parquet(f"{folder}/runs")
    rows = flows.drained(flows.source_health(flows.files(spark, f"{folder}/runs", runs.schema)), folder)
    return rows.select("source_id", "run", "degraded", F.col("streak").cast("long").alias("streak"), "status")


QUERIES = {
    "funnel_counts": (funnel_counts, "SELECT event_type AS stage, CASE WHEN value > 5 THEN 'passed' ELSE 'rejected' END AS outcome, count(*) AS n FROM events GROUP BY 1, 2"),
    "health_rolling_median": (health_rolling_median, f"WITH {_RUNS} SELECT source_id, run, extracted, median7, degraded, streak, status FROM stated"),
    "health_blocks": (health_blocks, f"WITH {_RUNS}, b AS (SELECT source_id, run, CASE WHEN source_id = 'click' AND run >= TIMESTAMP '2024-01-20' THEN 'blocked' ELSE status END AS status FROM stated), w AS (SELECT *, coalesce(lag(status) OVER (PARTITION BY source_id ORDER BY run), 'ok') AS was FROM b) SELECT source_id, run, status, status = 'degraded' AND was <> 'degraded' AS just_degraded, status = 'disabled' AND was <> 'disabled' AS just_disabled FROM w"),
    "health_latest": (health_latest, f"WITH {_RUNS} SELECT source_id, run, status, med AS median_extracted FROM (SELECT *, quantile_cont(extracted, 0.5) OVER (PARTITION BY source_id ORDER BY run ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS med, row_number() OVER (PARTITION BY source_id ORDER BY run DESC) AS rn FROM stated) WHERE rn = 1"),
    "health_tier_override": (health_tier_override, f"WITH {_RUNS}, x AS (SELECT source_id FROM stated WHERE run = TIMESTAMP '2024-01-17' AND status <> 'ok') SELECT event_type AS source_id, CASE WHEN event_type IN (FROM x) THEN 'C' ELSE 'A' END AS tier, CASE WHEN event_type IN (FROM x) THEN 0.0 ELSE 0.8 END::DOUBLE AS trust, count(*) AS n FROM events GROUP BY 1, 2, 3"),
    "ledger_by_model": (ledger_by_model, f"WITH {_CALLS} SELECT month, round(floor(sum(eur) * 10000 + 0.5) / 10000, 3) AS eur, count(*) AS calls, string_agg(DISTINCT model, ',' ORDER BY model) AS models FROM calls GROUP BY 1"),
    "ledger_budget_guard": (ledger_budget_guard, f"WITH RECURSIVE {_CALLS}, c AS (SELECT month, round(eur, 4) AS eur, row_number() OVER (PARTITION BY month ORDER BY ord) AS rn FROM calls), g AS (SELECT month, rn, eur <= 5 AS ok, CASE WHEN eur <= 5 THEN eur ELSE 0 END AS spent FROM c WHERE rn = 1 UNION ALL SELECT c.month, c.rn, g.spent + c.eur <= 5, g.spent + CASE WHEN g.spent + c.eur <= 5 THEN c.eur ELSE 0 END FROM g JOIN c ON c.month = g.month AND c.rn = g.rn + 1) SELECT month, count(*) FILTER (ok) AS admitted, round(max(spent), 4) AS spent FROM g GROUP BY 1"),
    "ledger_settle": (ledger_settle, f"WITH {_CALLS}, k AS (SELECT *, CASE WHEN ord % 5 <> 0 THEN customer || '-' || month END AS batch_id, ord % 3 <> 0 AS pending FROM calls), s AS (SELECT pending, batch_id FROM k WHERE batch_id IS NULL UNION ALL SELECT pending, batch_id FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY pending, ts DESC) AS rn FROM k WHERE batch_id IS NOT NULL) WHERE rn = 1) SELECT pending, count(*) AS n, count(batch_id) AS batches FROM s GROUP BY 1"),
    "ledger_warnings": (ledger_warnings, f"WITH {_CALLS}, r AS (SELECT month, ts, sum(round(eur, 4)) OVER (PARTITION BY month ORDER BY ts, ord ROWS UNBOUNDED PRECEDING) AS cum FROM calls) SELECT month, min(ts) FILTER (cum >= 0.7 * 5.0) AS warned_at, min(ts) FILTER (cum >= 5.0) AS exhausted_at FROM r GROUP BY 1"),
    "approximate_tokens": (approximate_tokens, "SELECT doc_id, ceil(length(text) / 3.6)::BIGINT AS tokens FROM documents"),
    "stale_sources": (stale_sources, "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 6 <> 0 THEN date_diff('day', o_orderdate, TIMESTAMP '2001-06-15') END AS age_days FROM orders WHERE o_orderkey % 6 = 0 OR date_diff('day', o_orderdate, TIMESTAMP '2001-06-15') > 180"),
    "stream_daily_counts": (stream_daily_counts, "SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2"),
    "stream_first_sights": (stream_first_sights, "SELECT DISTINCT event_type, user_id FROM events"),
    "stream_sights_within": (stream_sights_within, "SELECT DISTINCT event_type, user_id FROM events"),
    "stream_month_log": (stream_month_log, "SELECT strftime(ts + to_months((user_id % 3)::INT), '%Y-%m') AS month, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1"),
    "stream_batch_outcomes": (stream_batch_outcomes, f"WITH {_OUTCOMES} SELECT batch_id, outcome, date_trunc('second', moment)::TIMESTAMP AS \"at\", item FROM o"),
    "stream_health": (stream_health, f"WITH {_RUNS} SELECT source_id, run, degraded, streak, status FROM stated"),
}
