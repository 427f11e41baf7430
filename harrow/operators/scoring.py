"""Scores by agreement of sources, completeness, freshness and reputation; verdict points; vetoes; and the filter that names its first failing step."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.functions import text as T
from harrow.functions import values as V

# --- Fixed values ---------------------------------------------------------------------------------------------------------------
CONSENSUS_BASE = {1: 10, 2: 18, 3: 23, 4: 25}
POINTS_PER_FIELD, FRESHNESS, MAX_REPUTATION = 2, ((14, 5), (30, 3), (60, 1)), 5
THRESHOLD, FALLBACK, SINGLE_SOURCE_MIN, USEFUL_TEXT = 62, 55, 20, 200
VERDICT_CAPS = (("worth_the_trip", 15), ("typical", 15), ("no_language_barrier", 10), ("no_tourist_trap", 15))
HARD_VETOES = ("is_tourist_trap", "is_generic", "needs_a_local", "is_a_brand")
BLOCKED_URL = r"(?i)/(publirreportaje|branded|patrocinado|sponsored|sorteo|promo|casino|apuestas|betting)/"
AD_MARKS = r"\b(contenido patrocinado|contingut patrocinat|en colaboracion con|en col·laboracio amb|#ad|codigo descuento|codi descompte|publirreportaje)\b"
# ---------------------------------------------------------------------------------------------------------------------------------


def good(sources: Column) -> Column:
    return F.filter(sources, lambda s: s["tier"].isin("A", "B"))


def _mean(values: Column) -> Column:
    """The mean, to nine decimals: so the order of summing can't tip a rounding."""
    return F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values), 9)


def consensus(sources: Column) -> Column:
    """A base by the number of good sources (four at most) times their mean trust, rounded."""
    g = good(sources)
    base = F.create_map(*[F.lit(v) for kv in CONSENSUS_BASE.items() for v in kv])[F.least(F.size(g), F.lit(4))]
    return F.when(F.size(g) == 0, F.lit(0)).otherwise(T.half_up(base * _mean(F.transform(g, lambda s: s["trust"])))).cast("int")


def completeness(has: list[Column]) -> Column:
    return sum((F.coalesce(h, F.lit(False)).cast("int") * POINTS_PER_FIELD for h in has), F.lit(0))


def freshness(collection: Column, start_at: Column, now: datetime) -> Column:
    days = V.days_until(start_at, now)
    out = F.when(collection == "museums", FRESHNESS[0][1]).when(start_at.isNull(), 0)
    for most, points in FRESHNESS:
        out = out.when(days <= most, points)
    return out.otherwise(0)


def reputation(sources: Column, effective: Column | None = None) -> Column:
    """Mean trust of the good sources, of 5 points; effective: a map from source to its adjusted trust."""
    g = good(sources)
    trust = F.transform(g, lambda s: s["trust"] if effective is None else F.coalesce(effective[s["id"]], s["trust"]))
    return F.when(F.size(g) == 0, F.lit(0)).otherwise(T.half_up(_mean(trust) * MAX_REPUTATION)).cast("int")


def verdict_points(v: Column) -> Column:
    return sum((F.least(v[name], F.lit(cap)) for name, cap in VERDICT_CAPS[1:]), F.least(v[VERDICT_CAPS[0][0]], F.lit(VERDICT_CAPS[0][1])))


def hard_veto(v: Column) -> Column:
    """The first veto that a verdict has."""
    return F.coalesce(*[F.when(v[name], F.lit(name)) for name in HARD_VETOES])


def passes(collection: Column, vetoed: Column, total: Column) -> Column:
    return (collection == "museums") | (~F.coalesce(vetoed, F.lit(False)) & (total >= THRESHOLD))


def prefilter_reason(now: datetime, c=F.col) -> Column:
    """Why a cluster is dropped before any verdict, or null. Columns: known, vetoed, covered (booleans of joined sets), collection, start_at, end_at, lat, lng, sources,
    title, description, extracts, deterministic. The steps are one CASE, so their order stays what it says."""
    museum = c("collection") == "museums"
    running = F.coalesce((c("end_at") >= F.lit(now)) & (c("start_at") <= F.lit(now)), F.lit(False))
    text = F.aggregate(c("extracts"), F.lit(0), lambda n, e: n + F.length(e["text"])) + F.length(c("description"))
    return (
        F.when(c("known"), "sin-cambios")
        .when(c("vetoed"), "vetado")
        .when(~museum & c("start_at").isNull(), "sin-fecha")
        .when(~museum & ~V.in_window(c("start_at"), now) & ~running, "fuera-de-ventana")
        .when(~V.in_box(c("lat"), c("lng")), "fuera-de-barcelona")
        .when(F.exists(c("sources"), lambda s: s["url"].rlike(BLOCKED_URL)), "url-en-lista-negra")
        .when(T.norm(F.concat_ws(" ", c("title"), c("description"))).rlike(AD_MARKS), "marcadores-publicitarios")
        .when(text < USEFUL_TEXT, "material-insuficiente")
        .when((c("collection") == "plans") & (F.size(good(c("sources"))) <= 1) & (c("deterministic") < SINGLE_SOURCE_MIN), "sin-consenso-ni-ficha")
        .when(c("covered"), "ya-cubierto-por-planonmap")
    )


def flagged(rows: DataFrame, keys: DataFrame | None, on: str, name: str) -> DataFrame:
    """rows with a boolean: whether their key is in a set of keys (none: never)."""
    if keys is None:
        return rows.withColumn(name, F.lit(False))
    hit = keys.select(F.col(on).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    return rows.join(hit, rows[on] == F.col("_k"), "left").withColumn(name, F.coalesce("_hit", F.lit(False))).drop("_k", "_hit")


def degraded_trust(rows: DataFrame, health: DataFrame) -> DataFrame:
    """rows (source_id, tier, trust) where sources that aren't ok (health: source_id, status) fall to tier C and trust 0."""
    bad = health.filter("status <> 'ok'").select("source_id").distinct().withColumn("_bad", F.lit(True))
    joined = rows.join(bad, "source_id", "left")
    return joined.withColumns({"tier": F.when(F.col("_bad"), "C").otherwise(F.col("tier")), "trust": F.when(F.col("_bad"), 0.0).otherwise(F.col("trust"))}).drop("_bad")


def confusion(rows: DataFrame) -> DataFrame:
    """Counts of golden rows (accept, veto_expected) against verdicts (points, veto; null: missed): accepted means no veto and at least 32 points."""
    says = F.coalesce(F.col("veto").isNull() & (F.col("points") >= THRESHOLD - 30), F.lit(False)) & F.col("points").isNotNull()
    return rows.agg(
        F.count("*").alias("n"), F.count_if(says == F.col("accept")).alias("correct"), F.count_if(says & ~F.col("accept")).alias("false_positives"), F.count_if(F.col("veto_expected").isNotNull() & F.col("veto").isNull()).alias("missed_vetoes")
    )
