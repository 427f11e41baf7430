"""Cards: nested documents whose absent parts are left out, their images, and updates that keep the written text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.functions.identity import curated_id, host
from harrow.functions.text import clip, half_up, norm
from harrow.functions.values import derive_tags, museum_window

#: Hosts whose images may be shown (with a dot: their subdomains too), and parts of hosts whose images never are.
RENDERABLE_HOSTS = ("upload.wikimedia.org", "res.cloudinary.com", ".barcelona.cat", ".macba.cat", ".diba.cat", ".cultura.gencat.cat")
NEVER_HOSTS = ("timeout.es", "timeout.com", "barcelonasecreta.com", "lavanguardia.com", "elperiodico.com", "shutterstock", "gettyimages", "istockphoto", "unsplash.com")
#: How free admission is spoken of, how many such lines a card has, and their characters.
FREE_LINE, FREE_LINES, FREE_CHARS = r"\b(gratu[ai]t\w*|gratis|entrada lliure|entrada libre|free)\b[^.;]{0,90}", 6, 120
#: Months in Spanish.
MONTHS_ES = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")


def renderable(url: Column | str) -> Column:
    """Whether an image of this address may be shown; not if it has no host."""
    name = host(url)
    shown = [F.endswith(name, F.lit(h[1:])) if h.startswith(".") else name == h for h in RENDERABLE_HOSTS]
    never = [F.contains(name, F.lit(h)) for h in NEVER_HOSTS]
    any_of = lambda xs: F.coalesce(F.array_contains(F.array(*xs), True), F.lit(False))
    return any_of(shown) & ~any_of(never)


def resolved_image(allow_commons: bool = True) -> Column:
    """struct(url, credit, source) or null: the venue's own image (candidate_url, venue_name) if it may be shown, else the found one (commons_url, commons_credit)."""
    own = F.when(renderable("candidate_url"), F.struct(F.col("candidate_url").alias("url"), F.col("venue_name").alias("credit"), F.lit("venue").alias("source")))
    if not allow_commons:
        return own
    return F.coalesce(own, F.when(F.col("commons_url").isNotNull(), F.struct(F.col("commons_url").alias("url"), F.col("commons_credit").alias("credit"), F.lit("wikimedia").alias("source"))))


def free_admission(price_texts: Column, extracts: Column) -> Column:
    """The distinct folded passages that speak of free admission, as found."""
    found = F.regexp_extract_all(norm(F.concat_ws(" ", price_texts, extracts)), F.lit(FREE_LINE), F.lit(0))
    return F.transform(F.slice(F.array_distinct(F.transform(found, F.trim)), 1, FREE_LINES), lambda x: F.substring(x, 1, FREE_CHARS))


def structured_update(cards: DataFrame, fresh: DataFrame, at: Column) -> DataFrame:
    """cards (slug, price, schedule, curated) with fresh (slug, price, hours, free) prices, hours and free admission; all else, the text too, stays.
    A card without a museum part gets
    one; cards without fresh data stay as they are."""
    f = fresh.select("slug", F.col("price").alias("_price"), F.col("hours").alias("_hours"), F.col("free").alias("_free"), F.lit(True).alias("_hit"))
    empty = F.from_json(F.lit("{}"), cards.schema["curated"].dataType["museum"].dataType)
    museum = F.coalesce("curated.museum", empty).withField("openingHours", F.col("_hours")).withField("freeAdmission", F.col("_free"))
    curated = F.col("curated").withField("curatedAt", at).withField("museum", museum)
    pick = lambda new, old: F.when(F.col("_hit"), new).otherwise(F.col(old))
    joined = cards.join(f, "slug", "left")
    return joined.select(*[{"price": pick(F.col("_price"), "price"), "schedule": pick(F.col("_hours"), "schedule"), "curated": pick(curated, "curated")}.get(c, F.col(c)).alias(c) for c in cards.columns])


def _present(**fields: Column) -> Column:
    """A struct of these fields, or null if all of them are."""
    return F.when(F.array_contains(F.array(*[x.isNotNull() for x in fields.values()]), True), F.struct(*[x.alias(k) for k, x in fields.items()]))


def _text(x: str, most: int | None = None) -> Column:
    return F.when(F.length(x) > 0, clip(F.col(x), most) if most else F.col(x))


def _two(es: str, en: str, most: int | None = None) -> Column:
    """A text in Spanish with its English version; null without the Spanish one."""
    return F.when(F.length(es) > 0, F.struct(_text(es, most).alias("es"), _text(en, most).alias("en")))


def _some(x: str) -> Column:
    return F.when(F.size(x) > 0, F.col(x))


# How sources are called where cards name them.
PUBLISHERS = {
    "timeout-bcn": "Time Out Barcelona",
    "barcelona-secreta": "Barcelona Secreta",
    "lecool-bcn": "Le Cool Barcelona",
    "beteve-agenda": "betevé",
    "lavanguardia-quehacer": "La Vanguardia",
    "teatre-barcelona": "Teatre Barcelona",
    "enderrock-agenda": "Enderrock",
    "visit-barcelona": "Barcelona Turisme",
    "bcn-cultura": "Barcelona Cultura",
    "articket": "Articket BCN",
    "museus-bcn": "Museus de Barcelona",
    "venue-official": "Web oficial del recinto",
}


def publisher(source: Column) -> Column:
    """What a source is called, or its id."""
    names = F.create_map(*[F.lit(x) for pair in PUBLISHERS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, source), source)


def assembled(rows: DataFrame, now: datetime, version: str) -> DataFrame:
    """(slug, card): each row as a nested card; to_json() leaves its null parts out.

    rows has flat columns: slug, collection, total, temporality, sources (structs of id, tier, url, retrieved_at), start_date, end_date, official_url,
    tickets_url, title_*, summary_*, why_*, transit_*, includes_* (each _es and _en), minutes, booking, lead_days, languages, audience,
    hours (structs of days and hours), free, exhibition, exhibition_until, visit_minutes, book_ahead, artist, room, surtitles, image (as
    resolved_image()), schedule, verified (a struct of booleans, schedule among them), venue (a struct, name and neighborhood among its fields), category, price, dedupe_key, merge_hint, locked. Museums run for
    a year from now; rows of other collections without a start date have no card.
    """
    year_from, year_to = museum_window(F.lit(now).cast("timestamp"))
    museum = F.col("collection") == "museums"
    start, end = F.when(museum, year_from).otherwise(F.col("start_date")), F.when(museum, year_to).otherwise(F.col("end_date"))
    good = F.filter("sources", lambda s: s["tier"].isin("A", "B"))
    backing = F.when(F.size(good) > 0, good).otherwise(F.slice("sources", 1, 1))
    exhibition = F.when(F.col("exhibition").isNotNull(), F.struct(clip(F.col("exhibition"), 200).alias("title"), F.col("exhibition_until").alias("endsOn")))
    practical = F.struct(
        F.col("minutes").alias("durationMinutes"), F.col("booking").alias("booking"), F.col("lead_days").alias("bookingLeadDays"), F.col("languages").alias("activityLang"),
        _two("transit_es", "transit_en", 200).alias("transit"), _two("includes_es", "includes_en", 200).alias("priceIncludes"),
    )
    of_museum = F.when(museum, _present(
        openingHours=_some("hours"), freeAdmission=F.when(F.size("free") > 0, F.transform("free", lambda x: clip(x, FREE_CHARS))), currentExhibition=exhibition,
        visitMinutes=F.col("visit_minutes"), bookAhead=F.col("book_ahead"),
    ))
    of_show = F.when(F.col("collection") == "shows", _present(artistOrCompany=_text("artist", 120), room=_text("room", 120), surtitles=_some("surtitles")))
    provenance = F.transform("sources", lambda s: F.struct(s["url"].alias("url"), publisher(s["id"]).alias("publisher"), s["tier"].alias("tier"), s["retrieved_at"].alias("retrievedAt")))
    curated = F.struct(
        F.col("collection"), F.col("slug"), F.lit(1).alias("schemaVersion"), F.lit(now.strftime("%Y-%m-%dT%H:%M:%S.000Z")).alias("curatedAt"), F.lit(version).alias("promptVersion"),
        half_up(F.col("total")).cast("long").alias("score"), F.col("temporality"), F.struct(F.size(backing).alias("sourceCount"), F.transform(backing, lambda s: s["id"]).alias("sources")).alias("consensus"),
        _two("why_es", "why_en", 160).alias("whyWorthIt"), practical.alias("practical"), of_show.alias("show"), of_museum.alias("museum"), provenance.alias("provenance"), F.col("verified"),
        F.struct(F.col("dedupe_key").alias("dedupeKey"), F.col("merge_hint").alias("mergeHint")).alias("keys"), F.when(F.col("locked"), F.lit(True)).alias("locked"),
    )
    tags = derive_tags(F.col("title_es"), F.col("category"), F.col("venue.neighborhood"))
    card = F.struct(
        curated_id(F.col("collection"), F.col("slug")).alias("id"), F.lit("curated").alias("source"), F.col("slug").alias("sourceId"), F.coalesce("official_url", F.get(F.col("sources.url"), F.lit(0)), F.lit("")).alias("sourceUrl"),
        F.col("official_url").alias("officialUrl"), F.col("tickets_url").alias("ticketsUrl"), F.lit("es").alias("contentLang"), F.col("title_es").alias("title"), F.col("summary_es").alias("description"),
        F.col("image.url").alias("image"), F.when(F.col("image.url").isNotNull(), F.lit("venue")).alias("imageSource"), F.col("image.credit").alias("imageCredit"), F.when(F.col("audience").isNotNull(), F.slice("audience", 1, 20)).alias("audience"),
        start.alias("startDate"), end.alias("endDate"), F.when(F.col("verified.schedule"), _some("schedule")).alias("schedule"), F.col("venue"),
        F.col("category"), F.col("price"), tags.alias("tags"), F.struct(_two("title_es", "title_en").alias("title"), _two("summary_es", "summary_en").alias("description")).alias("i18n"), curated.alias("curated"),
    )
    return rows.filter(museum | F.col("start_date").isNotNull()).select("slug", card.alias("card"))


def long_date(day: Column | str) -> Column:
    """A date as Spanish prose writes it: 3 de mayo de 2001."""
    day = F.col(day) if isinstance(day, str) else day
    return F.concat(F.dayofmonth(day).cast("string"), F.lit(" de "), F.element_at(F.array(*[F.lit(m) for m in MONTHS_ES]), F.month(day)), F.lit(" de "), F.year(day).cast("string"))


def escaped_pipes(x: Column) -> Column:
    """A text for a cell of a Markdown table."""
    return F.replace(x, F.lit("|"), F.lit("\\|"))


def manifest(proposals: DataFrame, discarded: DataFrame, date: str, version: str, run_cost_eur: float) -> DataFrame:
    """One row for each slug proposed (slug, collection, kind, score) or discarded (slug, reason) in a run, with the run's date, prompt version and cost in cents' precision."""
    run = [F.lit(date).alias("date"), F.lit(version).alias("prompt_version"), half_up(F.lit(run_cost_eur), 2).alias("run_cost_eur")]
    proposed = proposals.select(*run, F.lit("proposed").alias("state"), "slug", "collection", "kind", F.col("score").cast("long").alias("score"), F.lit(None).cast("string").alias("reason"))
    return proposed.unionByName(discarded.select(*run, F.lit("discarded").alias("state"), "slug", "reason"), allowMissingColumns=True)
