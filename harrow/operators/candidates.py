"""From extracted records to candidates: coalesced fields, and a reason for every record that can't become one."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.functions import text as T
from harrow.functions import values as V


def to_candidates(extracts: DataFrame, now: datetime) -> tuple[DataFrame, DataFrame]:
    """(candidates, rejected) of extracts with EXTRACT's columns, source_id, tier, trust, url, collection, retrieved_at, ord, and seed_name, seed_address, seed_slug (null without a catalogue entry).

    The first reason that applies is given: sin-titulo, sin-coordenadas, fuera-de-barcelona, sin-fecha.
    """
    museum = F.col("collection") == "museums"
    title = T.strip_html(F.coalesce("seed_name", "title"))
    start, end = V.parse_date("start_date"), V.parse_date("end_date")
    opens, closes = V.museum_window(F.lit(now))
    reason = (
        F.when(title == "", "sin-titulo").when(F.col("lat").isNull() | F.col("lng").isNull(), "sin-coordenadas").when(~V.in_box(F.col("lat"), F.col("lng")), "fuera-de-barcelona").when(~museum & start.isNull(), "sin-fecha")
    )
    address = F.coalesce(F.nullif(T.strip_html(F.coalesce("seed_address", "address")), F.lit("")), title)
    description = T.clip(T.strip_html(F.coalesce("description", "body_text")), 2000)
    body = T.strip_html(F.coalesce("body_text", "description"))
    kind = V.classify(F.concat_ws(" ", title, description), F.col("collection"))
    rows = extracts.withColumn("reason", reason)
    passed = rows.filter("reason IS NULL").select(
        "ord", "source_id", "tier", "trust", "url", "collection", title.alias("title"), description.alias("description"),
        F.when(museum, opens).otherwise(start["iso"]).alias("start_date"), F.when(museum, closes).otherwise(end["iso"]).alias("end_date"),
        F.when(museum, "day").otherwise(start["confidence"]).alias("time_confidence"), V.schedule_slots(F.coalesce("schedule_lines", F.array().cast("array<string>"))).alias("schedule"),
        T.strip_html(F.coalesce("seed_name", "venue_name", "title")).alias("venue_name"), address.alias("address"), "lat", "lng", F.coalesce(V.guess_district(address), V.guess_district(description)).alias("district"),
        V.guess_town(address).alias("municipality"), kind["category"].alias("category"), V.best_price([F.col("price_text"), F.substring(body, 1, 1500)]).alias("price"),
        F.array_compact(F.concat(F.array("price_text"), F.coalesce("schedule_lines", F.array().cast("array<string>")))).alias("price_texts"), "official_url", body.alias("body_text"), "retrieved_at", "seed_slug",
    )
    return passed, rows.filter("reason IS NOT NULL")


def with_catalogue(pages: DataFrame, catalogue: DataFrame, most: int = 10_000) -> DataFrame:
    """pages (url, …) with the catalogue entry (slug, official_url, hours_url) that either of its addresses names. A catalogue of at most `most` entries is broadcast."""
    from harrow.functions.identity import canonical_url

    keys = catalogue.select("slug", F.explode(F.array("official_url", "hours_url")).alias("_url")).filter("_url IS NOT NULL")
    keys = keys.groupBy(canonical_url("_url").alias("_key")).agg(F.min("slug").alias("seed_slug"))
    keys = F.broadcast(keys) if catalogue.limit(most + 1).count() <= most else keys
    return pages.withColumn("_key", canonical_url("url")).join(keys, "_key", "left").drop("_key")
