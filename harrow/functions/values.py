"""Prices, dates, places and categories out of free text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACES, col, let, norm, number_text, strip_html

ZONE = "Europe/Madrid"
DAY_US = 86_400_000_000

# --- Fixed values: price grammar, category rules, months, districts, the area's box -------------------------------------------------
FREE = r"\b(gratu[ai]t\w*|gratis|entrada lliure|entrada libre|free entry|free admission|acces lliure)\b"
FREE_WITH_BOOKING = r"\b(gratu[ai]t\w*|gratis|free)\b[^.]{0,40}\b(amb reserva|con reserva|reserva previa|previa reserva|inscripcio|inscripcion|booking required)\b"
INVITATION = r"\b(amb invitacio|con invitacion|invitation only|nomes convidats|solo invitados)\b"
INCLUDED = r"\b(inclos amb l entrada|incluido con la entrada|inclos en l entrada|included with admission|amb l entrada del museu)\b"
SURCHARGE = r"\b(despeses de gestio|gastos de gestion|booking fee|mes despeses|\+ despeses|\+ gastos)\b"
PAID_HINT = r"\b(preu|precio|price|entrada|entrades|entradas|tarifa|ticket|venda|venta)\b"
AMOUNT = r"(\d{1,4}(?:[.,]\d{1,2})?)"
RANGE = AMOUNT + r"\s*(?:€|eur|euros?)?\s*(?:a|-|–|—|fins a|hasta|to|y|i)\s*" + AMOUNT + r"\s*(?:€|eur|euros?)"
SINGLE = r"(?:€\s*" + AMOUNT + r")|" + AMOUNT + r"\s*(?:€|eur\b|euros?\b)"
PRICE_RANK = {"paid": 6, "free": 5, "free-with-booking": 5, "included-with-admission": 4, "invitation": 4, "paid-unknown": 2, "unknown": 0}
CATEGORY_RULES = (
    (r"\b(exposicio|exposicion|exhibition|mostra|retrospectiva)\b", "exhibitions", "strong"),
    (r"\b(museu|museo|museum|coleccio|coleccion|collection permanent)\b", "museums", "strong"),
    (r"\b(concert|concierto|gig|recital|festival de musica|live music|dj set)\b", "music", "strong"),
    (r"\b(teatre|teatro|theatre|dansa|danza|dance|opera|musical|circ|circo|monoleg|monologo)\b", "arts", "strong"),
    (r"\b(taller infantil|familiar|familias|families|nens|ninos|kids|children)\b", "family", "strong"),
    (r"\b(mercat|mercado|market|restaurant|tast|degustacio|degustacion|gastronomi|tapas|vermut|showcooking)\b", "food", "strong"),
    (r"\b(ruta|itinerari|itinerario|parc|parque|platja|playa|mirador|excursio|excursion|senderisme|senderismo|jardi|jardin)\b", "outdoors", "strong"),
    (r"\b(partit|partido|match|marato|maraton|cursa|carrera|torneig|torneo|esport|deporte|sport)\b", "sports", "strong"),
    (r"\b(art|arte|galeria|galleria|escultura|pintura|fotografia)\b", "arts", "weak"),
    (r"\b(musica|music|jazz|flamenco|rock|electronica)\b", "music", "weak"),
    (r"\b(cultura|patrimoni|patrimonio|historia|heritage|conferencia|xerrada|charla)\b", "culture", "weak"),
)
PUBLIC_GROUPS = {"music": ("music",), "family": ("family",), "food": ("food",), "cultura": ("museums", "exhibitions", "arts", "culture"), "deporte-naturaleza": ("sports", "outdoors")}
TITLE_TAGS = (("gaudi", "gaudi"), ("modernis", "modernismo"), ("picasso", "picasso"), ("miro", "miro"), ("gotic", "gotico"), ("romanic", "romanico"))
MONTHS = (
    "gener enero january gen ene jan", "febrer febrero february feb", "marc marzo march mar", "abril april abr apr", "maig mayo may mai", "juny junio june jun",
    "juliol julio july jul", "agost agosto august ago aug", "setembre septiembre september set sep", "octubre october oct", "novembre noviembre november nov", "desembre diciembre december des dic dec",
)
DISTRICTS = ("Ciutat Vella", "Eixample", "Sants-Montjuïc", "Les Corts", "Sarrià-Sant Gervasi", "Gràcia", "Horta-Guinardó", "Nou Barris", "Sant Andreu", "Sant Martí")
TOWNS = (("hospitalet", "lhospitalet"), ("badalona", "badalona"), ("santa coloma", "santacoloma"), ("cornella", "cornella"), ("esplugues", "esplugues"), ("sant adria", "santadria"))
BOX = {"min_lat": 41.2, "max_lat": 41.6, "min_lng": 1.9, "max_lng": 2.35}
EARTH_M = 6_371_000.0
# ------------------------------------------------------------------------------------------------------------------------------------

PRICE_TYPE = "struct<type:string,amount:double,amount_max:double,currency:string,has_surcharge:boolean>"


def _price(kind: Column | str, amount: Column | None = None, most: Column | None = None, surcharge: Column | None = None) -> Column:
    null = F.lit(None)
    return F.struct(
        (F.lit(kind) if isinstance(kind, str) else kind).alias("type"), (null if amount is None else amount).cast("double").alias("amount"), (null if most is None else most).cast("double").alias("amount_max"),
        (null if amount is None else F.lit("EUR")).cast("string").alias("currency"), (null if surcharge is None else F.when(surcharge, True)).cast("boolean").alias("has_surcharge"),
    )


def _number(x: Column) -> Column:
    """A price's number from 0 to below 10 000, else null; the empty string is none."""
    n = F.expr("null").cast("double") if x is None else F.replace(x, F.lit(","), F.lit(".")).try_cast("double")
    return F.when((n >= 0) & (n < 10_000), n)


def parse_price(x: Column | str) -> Column:
    """The price that a text tells, as a PRICE_TYPE struct. The rules are tried in order: included, by invitation, free with booking, range, single amount, free, paid."""
    return let(norm(x), _price_of)


def _price_of(t: Column) -> Column:
    low, high = _number(F.regexp_extract(t, RANGE, 1)), _number(F.regexp_extract(t, RANGE, 2))
    one = _number(F.concat(F.regexp_extract(t, SINGLE, 1), F.regexp_extract(t, SINGLE, 2)))
    surcharge = t.rlike(SURCHARGE)
    return (
        F.when(t == "", _price("unknown"))
        .when(t.rlike(INCLUDED), _price("included-with-admission"))
        .when(t.rlike(INVITATION), _price("invitation"))
        .when(t.rlike(FREE_WITH_BOOKING), _price("free-with-booking"))
        .when(high >= low, _price("paid", low, high, surcharge))
        .when(one == 0, _price(F.when(t.rlike(FREE), "free").otherwise("unknown")))
        .when(one.isNotNull(), _price("paid", one, None, surcharge))
        .when(t.rlike(FREE), _price("free"))
        .when(t.rlike(PAID_HINT), _price("paid-unknown"))
        .otherwise(_price("unknown"))
    )


def price_rank(price: Column) -> Column:
    return F.create_map(*[F.lit(v) for kv in PRICE_RANK.items() for v in kv])[price["type"]]


def best_price(texts: list[Column]) -> Column:
    """The most telling price of several texts; the first of equally telling ones."""
    best = parse_price(texts[0])
    for t in texts[1:]:
        p = parse_price(t)
        best = F.when(price_rank(p) > price_rank(best), p).otherwise(best)
    return best


def price_amount(price: Column) -> Column:
    return F.when(price["type"].isin("free", "free-with-booking"), F.lit(0.0)).when(price["type"] == "paid", price["amount"])


def is_cheap(price: Column, below: float = 10.0) -> Column:
    return F.coalesce(price_amount(price) < below, F.lit(False))


def price_label(price: Column) -> Column:
    amounts = F.concat_ws("–", number_text(price["amount"]), number_text(price["amount_max"]))
    labels = (("free", "gratis"), ("free-with-booking", "gratis con reserva"), ("included-with-admission", "incluido con la entrada"), ("invitation", "con invitación"), ("paid-unknown", "de pago"))
    out = F.when(price["type"] == "paid", F.concat(amounts, F.lit(" €")))
    for kind, label in labels:
        out = out.when(price["type"] == kind, label)
    return out.otherwise("precio sin confirmar")


# --- Time: `now` is always given; instants are UTC timestamps, local times ISO strings with their offset -----------------------------


def instant(iso: Column | str) -> Column:
    return F.try_to_timestamp(col(iso))


def local_iso(at: Column | str) -> Column:
    """An instant as ISO text in the zone, with its offset."""
    at = col(at)
    local = F.from_utc_timestamp(at, ZONE)
    minutes = ((F.unix_micros(local) - F.unix_micros(at)) / 60_000_000).cast("int")
    offset = F.concat(F.when(minutes < 0, "-").otherwise("+"), F.lpad((F.abs(minutes) / 60).cast("int").cast("string"), 2, "0"), F.lit(":"), F.lpad((F.abs(minutes) % 60).cast("string"), 2, "0"))
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSS"), offset)


def local_day(at: Column | str) -> Column:
    return F.date_format(F.from_utc_timestamp(col(at), ZONE), "yyyy-MM-dd")


def local_month(at: Column | str) -> Column:
    return F.date_format(F.from_utc_timestamp(col(at), ZONE), "yyyy-MM")


def _local_time(y: Column, m: Column, d: Column, hh: Column, mm: Column) -> Column:
    """The instant of a local wall-clock time; null for an impossible one."""
    text = F.concat(F.lpad(y, 4, "0"), F.lit("-"), F.lpad(m, 2, "0"), F.lit("-"), F.lpad(d, 2, "0"), F.lit(" "), F.lpad(hh, 2, "0"), F.lit(":"), F.lpad(mm, 2, "0"))
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")), ZONE)


def parse_date(x: Column | str) -> Column:
    """struct(iso, confidence) of a date in one of four forms, else null: ISO with offset, ISO local, day/month/year, and with the month's name (ca, es, en).

    Days, months and times that don't exist give null.
    """
    return let(F.regexp_replace(F.coalesce(col(x), F.lit("")), "^" + SPACES + "|" + SPACES + "$", ""), lambda raw: let(norm(raw), lambda t: _date_of(raw, t)))


def _date_of(raw: Column, t: Column) -> Column:
    part = lambda text, pattern, k, default=None: F.coalesce(F.nullif(F.regexp_extract(text, pattern, k), F.lit("")), F.lit(default))
    full = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2})?([.]\d+)?([+-]\d{2}:\d{2}|Z)$"
    naive = r"^(\d{4})-(\d{2})-(\d{2})(?:[T ](\d{1,2}):(\d{2}))?"
    dmy = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})(?:\D{1,3}(\d{1,2})[:.](\d{2}))?"
    named = r"(\d{1,2})\s*(?:de\s+|d[’']\s*)?([a-z]+)\s*(?:de\s+|del\s+)?(\d{4})"
    clock = r"(\d{1,2})[:.h](\d{2})"
    months = F.create_map(*[F.lit(v) for k, names in enumerate(MONTHS, 1) for name in names.split() for v in (name, str(k))])
    timed = F.when(raw.rlike(full), True).when(raw.rlike(naive), part(raw, naive, 4).isNotNull()).when(raw.rlike(dmy), part(raw, dmy, 4).isNotNull()).otherwise(t.rlike(clock))
    at = (
        F.when(raw.rlike(full), F.try_to_timestamp(raw))
        .when(raw.rlike(naive), _local_time(*(part(raw, naive, k) for k in (1, 2, 3)), part(raw, naive, 4, "0"), part(raw, naive, 5, "0")))
        .when(raw.rlike(dmy), _local_time(part(raw, dmy, 3), part(raw, dmy, 2), part(raw, dmy, 1), part(raw, dmy, 4, "0"), part(raw, dmy, 5, "0")))
        .when(t.rlike(named), _local_time(part(t, named, 3), months[part(t, named, 2)], part(t, named, 1), part(t, clock, 1, "0"), part(t, clock, 2, "0")))
    )
    return let(at, lambda a: F.when(a.isNotNull(), F.struct(local_iso(a).alias("iso"), F.when(timed, "exact").otherwise("day").alias("confidence"))))


def _now_us(now: datetime) -> Column:
    return F.unix_micros(F.lit(now))


def in_window(at: Column, now: datetime, ahead: int = 60) -> Column:
    """From a day before now to so many days after it, both included; null is outside."""
    us = F.unix_micros(at)
    return F.coalesce((us >= _now_us(now) - DAY_US) & (us <= _now_us(now) + ahead * DAY_US), F.lit(False))


def is_active(start: Column, end: Column, now: datetime) -> Column:
    return F.coalesce(F.unix_micros(F.coalesce(end, start)) >= _now_us(now) - DAY_US, F.lit(False))


def days_until(at: Column, now: datetime) -> Column:
    """Days to an instant, rounded up; null if there is none."""
    return F.ceil((F.unix_micros(at) - _now_us(now)) / DAY_US)


def days_between(a: Column, b: Column) -> Column:
    return F.floor((F.unix_micros(b) - F.unix_micros(a)) / DAY_US)


def summarize_dates(start: Column, end: Column, temporality: Column) -> Column:
    a, b = F.substring(start, 1, 10), F.substring(end, 1, 10)
    return F.when(temporality == "atemporal", "permanente").when(start.isNull(), "sin fecha").when(end.isNull() | (a == b), a).otherwise(F.concat(F.lit("del "), a, F.lit(" al "), b))


def museum_window(now: Column) -> tuple[Column, Column]:
    """A rolling year from the local start of today: (start, end) as ISO texts."""
    day = F.date_trunc("day", F.from_utc_timestamp(now, ZONE))
    return local_iso(F.to_utc_timestamp(day, ZONE)), local_iso(F.to_utc_timestamp(day + F.expr("INTERVAL 1 YEAR"), ZONE))


# --- Places -----------------------------------------------------------------------------------------------------------------------


def in_box(lat: Column, lng: Column) -> Column:
    return F.coalesce(lat.between(BOX["min_lat"], BOX["max_lat"]) & lng.between(BOX["min_lng"], BOX["max_lng"]), F.lit(False))


def metres(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def guess_district(x: Column | str) -> Column:
    """The first district in the list that the text names."""
    return let(norm(x), lambda t: F.coalesce(*[F.when(F.contains(t, norm(F.lit(d))), F.lit(d)) for d in DISTRICTS]))


def guess_town(x: Column | str) -> Column:
    return let(norm(x), lambda t: F.coalesce(*[F.when(F.contains(t, F.lit(word)), F.lit(town)) for word, town in TOWNS], F.lit("barcelona")))


# --- Categories -------------------------------------------------------------------------------------------------------------------


def classify(x: Column | str, collection: Column) -> Column:
    """struct(category, confidence, secondary): the first strong rule that fits, else the first weak one, else the collection's default."""
    return let(norm(x), lambda t: classified(t, collection))


def classified(t: Column, collection: Column) -> Column:
    """classify() of a text that is folded already."""
    rules = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(s).alias("confidence"), t.rlike(p).alias("fits")) for p, c, s in CATEGORY_RULES])
    return let(F.filter(rules, lambda r: r["fits"]), lambda fits: _best_rule(fits, collection))


def _best_rule(fits: Column, collection: Column) -> Column:
    first = F.coalesce(F.get(F.filter(fits, lambda r: r["confidence"] == "strong"), F.lit(0)), F.get(fits, F.lit(0)))
    none = F.array().cast("array<string>")
    answer = lambda c, s, o: F.struct(c.alias("category"), F.lit(s).alias("confidence") if isinstance(s, str) else s.alias("confidence"), o.alias("secondary"))
    others = F.array_except(F.array_distinct(F.transform(fits, lambda r: r["category"])), F.array(first["category"]))
    return (
        F.when(collection == "museums", answer(F.lit("museums"), "strong", none))
        .when(first.isNull(), answer(F.when(collection == "shows", "arts").otherwise("culture"), "default", none))
        .otherwise(answer(first["category"], first["confidence"], others))
    )


def public_group(category: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(v) for g, cs in PUBLIC_GROUPS.items() for c in cs for v in (c, g)])[category], F.lit("other"))


def derive_tags(title: Column, category: Column, neighbourhood: Column) -> Column:
    t, place = norm(title), F.regexp_replace(F.regexp_replace(norm(neighbourhood), "[^a-z0-9]+", "-"), "^-|-$", "")
    tags = F.array(category, F.when(F.length(place) >= 3, place), *[F.when(F.contains(t, F.lit(word)), F.lit(tag)) for word, tag in TITLE_TAGS])
    return F.array_distinct(F.array_compact(tags))


def schedule_slots(lines: Column) -> Column:
    """Opening lines as (days, hours): the first twelve, those under three characters left out."""
    pattern = r"^(.{2,40}?)\s*[:·—–-]\s*(.{2,60})$"
    clean = F.filter(F.transform(F.slice(lines, 1, 12), strip_html), lambda x: F.length(x) >= 3)
    return F.transform(clean, lambda x: F.struct(F.when(x.rlike(pattern), F.trim(F.regexp_extract(x, pattern, 1))).otherwise("").alias("days"), F.when(x.rlike(pattern), F.trim(F.regexp_extract(x, pattern, 2))).otherwise(x).alias("hours")))
