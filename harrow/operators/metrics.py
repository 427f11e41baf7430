"""Editorial figures: precision, omissions, coverage, funnels, and proposed changes of trust."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.functions.text import half_up

#: Fixed values.
MIN_PROPOSALS, ZERO_BELOW, HALVE_BELOW, BOOST_ABOVE, BOOST = 20, 0.3, 0.5, 0.85, 1.1


def share(a: Column, b: Column) -> Column:
    """a / b, 0 if there is nothing to divide by."""
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def funnel(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("stage", "outcome").agg(F.count("*").alias("n"))


def approved(proposed: DataFrame, published: DataFrame, vetoed: DataFrame) -> DataFrame:
    """Slugs that were proposed, are published and not vetoed."""
    return proposed.select("slug").distinct().join(published.select("slug"), "slug", "left_semi").join(vetoed.select("slug"), "slug", "left_anti")


def withdrawn(proposed: DataFrame, present: DataFrame) -> DataFrame:
    """Proposed slugs that are gone: what a reviewer vetoed by deleting them."""
    return proposed.select("slug").distinct().join(present.select("slug"), "slug", "left_anti")


def precision(proposed: DataFrame, published: DataFrame, vetoed: DataFrame, spent_eur: float) -> DataFrame:
    ok = approved(proposed, published, vetoed).agg(F.count("*").alias("approved"))
    return proposed.agg(F.count_distinct("slug").alias("proposed")).crossJoin(ok).select("proposed", "approved", share(F.col("approved"), F.col("proposed")).alias("precision"), share(F.lit(spent_eur), F.col("approved")).alias("cost_per_card"))


def source_precision(cards: DataFrame) -> DataFrame:
    """Per source of cards (sources: array of ids, vetoed): proposed, approved and their share."""
    rows = cards.select(F.explode("sources").alias("source_id"), "vetoed").groupBy("source_id").agg(F.count("*").alias("proposed"), F.count_if(~F.col("vetoed")).alias("approved"))
    return rows.withColumn("precision", share(F.col("approved"), F.col("proposed")))


def omission_rate(cards: DataFrame, checks: list[str]) -> DataFrame:
    missing = sum((F.count_if(~F.coalesce(F.col(c), F.lit(False))) for c in checks[1:]), F.count_if(~F.coalesce(F.col(checks[0]), F.lit(False))))
    return cards.agg(share(missing, F.lit(len(checks)) * F.count("*")).alias("omission_rate"))


def by_collection(cards: DataFrame) -> DataFrame:
    return cards.groupBy("collection").agg(F.count("*").alias("n"), F.count_distinct(F.coalesce("neighbourhood", "district")).alias("neighbourhoods"))


def trust_changes(stats: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources (source_id, trust) whose precision over 20 proposals or more asks for another trust: none below 30 %, half below 50 %, a tenth more above 85 %."""
    p, t = F.col("precision"), F.col("trust")
    new = F.when(p < ZERO_BELOW, F.lit(0.0)).when(p < HALVE_BELOW, half_up(t * 0.5, 2)).when(p > BOOST_ABOVE, half_up(F.least(F.lit(1.0), t * BOOST), 2))
    return sources.join(stats.filter(F.col("proposed") >= MIN_PROPOSALS), "source_id").withColumn("new_trust", new).filter("new_trust IS NOT NULL AND new_trust <> trust").select("source_id", "trust", "new_trust", "precision", "proposed")
