"""Identifiers, hashes and URL parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, fixed, fold, norm, number_text, title_key

#: Versions that take part in job keys.
PROMPT_VERSIONS = {"screen": "screen-v1", "write": "write-v1"}


def make_id(*parts: Column) -> Column:
    return F.substring(F.regexp_replace(F.lower(F.concat_ws("|", *parts)), "[^a-z0-9|]", "-"), 1, 64)


def curated_id(collection: Column, slug: Column) -> Column:
    return make_id(F.lit("curated"), collection, slug)


def slugify(x: Column | str, most: int = 60) -> Column:
    """ASCII words joined by hyphens; fewer than three characters get a suffix."""
    base = F.regexp_replace(F.regexp_replace(fold(x), "['’`]", ""), "[^a-z0-9]+", "-")
    base = F.regexp_replace(F.substring(F.regexp_replace(base, "^-+|-+$", ""), 1, most), "-+$", "")
    return F.when(F.length(base) >= 3, base).otherwise(F.substring(F.concat(base, F.lit("-ficha")), 1, most))


def is_valid_slug(x: Column | str) -> Column:
    return F.coalesce(col(x).rlike("^[a-z0-9-]{3,60}$"), F.lit(False))


def show_slug(title: Column | str, year: Column) -> Column:
    return slugify(F.concat_ws("-", col(title), year.cast("string")))


def bytes_hash(x: Column | str) -> Column:
    return F.sha2(col(x), 256)


def dedupe_key(title: Column, start: Column, lat: Column, lng: Column) -> Column:
    """Title key, local day, and the place to about a kilometre."""
    return F.concat_ws("|", title_key(title), F.substring(start, 1, 10), fixed(lat, 2), fixed(lng, 2))


def price_fingerprint(price: Column) -> Column:
    """paid:amount[-most] for paid prices, else the kind of price."""
    paid = F.concat(F.lit("paid:"), number_text(price["amount"]), F.when(price["amount_max"].isNotNull(), F.concat(F.lit("-"), number_text(price["amount_max"]))).otherwise(""))
    return F.when(price["type"] == "paid", paid).otherwise(price["type"])


def slots_key(slots: Column) -> Column:
    """Opening hours in an order of their own, folded."""
    return F.array_join(F.array_sort(F.transform(slots, lambda s: F.concat(norm(s["days"]), F.lit("@"), norm(s["hours"])))), ";")


def semantic_hash(title: Column, start: Column, end: Column, price: Column, venue: Column, lat: Column, lng: Column, slots: Column, description: Column, separator: str = "") -> Column:
    """A digest that stays when only accents, case, the order of hours or the tail of the description change."""
    parts = [norm(title), F.coalesce(F.substring(start, 1, 10), F.lit("")), F.coalesce(F.substring(end, 1, 10), F.lit("")), price_fingerprint(price), norm(venue), fixed(lat, 4), fixed(lng, 4), slots_key(slots), F.substring(norm(description), 1, 600)]
    return F.sha2(F.concat_ws(separator, *parts) if separator else F.concat(*parts), 256)


def job_key(digest: Column, task: str, model: Column | str) -> Column:
    model = F.lit(model) if isinstance(model, str) else model
    return F.sha2(F.concat_ws("|", F.lit(task), F.lit(PROMPT_VERSIONS[task]), model, digest), 256)


def change_hash(slots: Column, price: Column, free_lines: Column, exhibition: Column, ends_on: Column) -> Column:
    """A digest of what changes often on a museum's page."""
    e = F.when(exhibition.isNotNull(), F.concat_ws("|", norm(exhibition), ends_on)).otherwise("")
    hours = F.array_sort(F.transform(slots, lambda s: F.concat(norm(s["days"]), F.lit("@"), norm(s["hours"]))))
    return F.sha2(F.to_json(F.struct(hours.alias("h"), price_fingerprint(price).alias("p"), F.array_sort(F.transform(free_lines, norm)).alias("f"), e.alias("e"))), 256)


def host(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))


def path(url: Column | str) -> Column:
    return F.regexp_extract(col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def without_fragment(url: Column | str) -> Column:
    return F.substring_index(col(url), "#", 1)


def canonical_url(url: Column | str) -> Column:
    """Host without www and path without its last slash: what stays equal between links to one page."""
    return F.concat(F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), "/+$", ""))


def segments(url: Column | str) -> Column:
    return F.filter(F.split(path(url), "/"), lambda x: x != "")
