"""What changed since last time: pages by their bytes, museums by their volatile fields, and whether a card is written again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_changes(pages: DataFrame, index: DataFrame) -> DataFrame:
    """pages (url, body) against the index (url, etag): new, changed or unchanged, by the digest of the body."""
    joined = pages.withColumn("digest", F.sha2("body", 256)).join(index.select("url", "etag"), "url", "left")
    return joined.withColumn("change", F.when(F.col("etag").isNull(), "new").when(F.col("etag") == F.col("digest"), "unchanged").otherwise("changed"))


def since(index: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Per source the time of the last visit, so many days before now if there is none."""
    return index.groupBy("source_id").agg(F.coalesce(F.max("last_seen"), now - F.expr(f"INTERVAL {days} DAYS")).alias("since"))


def museum_changes(published: DataFrame, fresh: DataFrame) -> DataFrame:
    """(slug, kind, changed) of fresh against published (slug, hours, price, free, exhibition: keys of their volatile fields).

    A museum without a card, or with another exhibition, is written anew; other changes are structured only. Published ones without fresh data are gone.
    """
    p, f = published.alias("p"), fresh.alias("f")
    parts = (("hours", "horarios"), ("price", "precio"), ("free", "gratuidades"), ("exhibition", "exposición temporal"))
    other = lambda c: ~F.col(f"p.{c}").eqNullSafe(F.col(f"f.{c}"))
    changed = F.array_compact(F.array(*[F.when(other(c), F.lit(label)) for c, label in parts]))
    is_new, gone = F.col("p.slug").isNull(), F.col("f.slug").isNull()
    kind = F.when(is_new, "needs-rewrite").when(gone, "gone").when(F.size(changed) == 0, "none").when(other("exhibition"), "needs-rewrite").otherwise("structured-only")
    joined = p.join(f, F.col("p.slug") == F.col("f.slug"), "full_outer")
    return joined.select(F.coalesce("f.slug", "p.slug").alias("slug"), kind.alias("kind"), F.when(is_new, F.array(F.lit("ficha nueva"))).when(gone, F.array().cast("array<string>")).otherwise(changed).alias("changed"))


def rewrite_decision(version: str) -> Column:
    """Why a card is written or not: locked, paid, new, prompt, changed; the first that holds. Columns: locked, paid, prompt_version (null: no card)."""
    return F.when(F.col("locked"), "locked").when(F.col("paid"), "paid").when(F.col("prompt_version").isNull(), "new").when(F.col("prompt_version") != version, "prompt").otherwise("changed")


def cached_verdicts(clusters: DataFrame, log: DataFrame, fresh: DataFrame) -> DataFrame:
    """clusters (job_key) with a verdict: the last logged one (job_key, at, verdict), else a fresh one (job_key, verdict); missing where neither is."""
    last = log.groupBy("job_key").agg(F.max_by("verdict", "at").alias("_old"))
    new = fresh.select("job_key", F.col("verdict").alias("_new"))
    joined = clusters.join(last, "job_key", "left").join(new, "job_key", "left")
    return joined.withColumn("verdict", F.coalesce("_old", "_new")).withColumn("origin", F.when(F.col("_old").isNotNull(), "cache").when(F.col("_new").isNotNull(), "fresh").otherwise("missing")).drop("_old", "_new")
