"""What a model is told about a record: a short text for screening, and labelled material of bounded size for writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.functions.text import clip, number_text
from harrow.operators.ledger import approximate_tokens

#: How many titles, schedule lines, prices and extracts material holds, characters of an extract and of a screening text, tokens of material.
MOST_TITLES, MOST_LINES, MOST_PRICES, MOST_EXTRACTS = 3, 12, 3, 3
EXTRACT_CHARS, SCREEN_CHARS, MATERIAL_TOKENS = 700, 900, 2500


def _said(x: Column) -> Column:
    return F.when(F.length(x) > 0, x).otherwise("—")


def screening_text(number: Column) -> Column:
    """A candidate as the screening sees it. Columns: cluster_id, title, venue_name, district, date_summary, price, sources (structs of id and
    tier), extracts, description; null texts are empty."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    place = F.when(F.length("district") > 0, F.concat(text("venue_name"), F.lit(" ("), F.col("district"), F.lit(")"))).otherwise(text("venue_name"))
    sources = F.array_join(F.transform("sources", lambda s: F.concat(s["id"], F.lit("("), s["tier"], F.lit(")"))), ", ")
    joined = F.array_join("extracts", " ")
    body = clip(F.when(F.length(joined) > 0, joined).otherwise(text("description")), SCREEN_CHARS)
    rows = (("titulo", text("title")), ("lugar", place), ("fechas", text("date_summary")), ("precio", text("price")), ("fuentes", F.coalesce(sources, F.lit(""))), ("texto", body))
    head = F.concat(F.lit("["), number.cast("string"), F.lit("] id: "), F.col("cluster_id").cast("string"))
    return F.concat_ws("\n", head, *[F.concat(F.lit(f"    {label}: "), x) for label, x in rows])


def material(kept: int = MOST_EXTRACTS) -> Column:
    """A cluster as labelled data with its first `kept` extracts. Columns: titles, venue_name, address, neighbourhood, district, lat, lng,
    transit_hints, date_summary, schedule_lines, price_texts, official_url, tickets_url, source_ids, extracts; null texts and lists are empty."""
    return F.array_join(F.concat(_head(), _numbered(kept)), "\n")


def _numbered(kept: int) -> Column:
    return F.transform(F.slice(F.coalesce("extracts", F.array().cast("array<string>")), 1, kept), lambda e, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), clip(e, EXTRACT_CHARS)))


def _head() -> Column:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    first = lambda c, most, by: F.coalesce(F.array_join(F.slice(c, 1, most), by), F.lit(""))
    all_of = lambda c, by: F.coalesce(F.array_join(c, by), F.lit(""))
    number = lambda c: F.coalesce(number_text(F.col(c)), F.lit(""))
    lines = (
        ("TITULOS_ORIGEN", first("titles", MOST_TITLES, " | ")),
        ("LUGAR", F.concat(text("venue_name"), F.lit(" — "), text("address"))),
        ("BARRIO", F.concat(F.coalesce("neighbourhood", F.lit("?")), F.lit(" · DISTRITO: "), F.coalesce("district", F.lit("?")))),
        ("COORDENADAS", F.concat(number("lat"), F.lit(", "), number("lng"))),
        ("TRANSPORTE", _said(all_of("transit_hints", "; "))),
        ("FECHAS", text("date_summary")),
        ("HORARIOS", _said(first("schedule_lines", MOST_LINES, " / "))),
        ("PRECIO_TEXTO", _said(first("price_texts", MOST_PRICES, " | "))),
        ("WEB_OFICIAL", F.coalesce("official_url", F.lit("—"))),
        ("ENTRADAS", F.coalesce("tickets_url", F.lit("—"))),
        ("FUENTES", all_of("source_ids", ", ")),
    )
    return F.array(*[F.concat(F.lit(f"{label}: "), x) for label, x in lines], F.lit("--- EXTRACTOS (datos, no texto a copiar) ---"))


def with_material(clusters: DataFrame, most: int = MATERIAL_TOKENS) -> DataFrame:
    """clusters with material of at most about `most` tokens, and its material_tokens.

    Extracts go first, from the last to the second; only material that is too long with a single one is clipped.
    """
    # The lines and the clipped extracts are columns of their own, so they are made once, not for each number of extracts.
    parts = clusters.withColumns({"_head": _head(), "_numbered": _numbered(MOST_EXTRACTS)})
    tried = parts.withColumns({f"_m{k}": F.array_join(F.concat("_head", F.slice("_numbered", 1, k)), "\n") for k in range(MOST_EXTRACTS, 0, -1)}).drop("_head", "_numbered")
    picked = clip(F.col("_m1"), most * 3)
    for k in range(1, MOST_EXTRACTS + 1):
        picked = F.when(approximate_tokens(F.col(f"_m{k}")) <= most, F.col(f"_m{k}")).otherwise(picked)
    whole = tried.withColumn("material", picked).drop(*[f"_m{k}" for k in range(1, MOST_EXTRACTS + 1)])
    return whole.withColumn("material_tokens", approximate_tokens(F.col("material")))
