"""Written cards against their material: literal evidence, figures, parity of languages, copied runs of words, lengths and banned terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.functions import text as T

# --- Fixed values ---------------------------------------------------------------------------------------------------------------
FIELD_GROUPS = {
    "price": ("precio", "price", "queincluye", "priceincludes", "gratuidades"),
    "schedule": ("horario", "horarios", "schedule", "duracion", "duracionmin", "minutosvisita", "reserva"),
    "dates": ("fecha", "fechas", "dates", "exposicionvigente"),
    "location": ("comollegar", "transit", "lugar"),
}
NUMERIC = ("precio", "price", "duracion", "duracionmin", "minutosvisita", "reservadiasantelacion")
DROPS = (("duracion", ("duration",)), ("duracionmin", ("duration",)), ("reserva", ("booking", "booking_days")), ("comollegar", ("transit",)), ("transit", ("transit",)), ("queincluye", ("includes",)), ("precio", ("includes",)))
PARITY, COPY_WORDS, SUMMARY_WORDS, WHY_WORDS, TRANSIT_WORDS = 0.6, 8, (90, 130), 22, 25
# ---------------------------------------------------------------------------------------------------------------------------------


def digits(x: Column) -> Column:
    """The distinct numbers in a text, decimals with a point."""
    return F.array_distinct(F.transform(F.regexp_extract_all(x, F.lit(r"(\d+(?:[.,]\d+)?)"), 1), lambda d: F.replace(d, F.lit(","), F.lit("."))))


def field_key(x: Column) -> Column:
    return F.regexp_replace(T.norm(x), "[^a-z]", "")


def field_group(x: Column) -> Column:
    return F.create_map(*[F.lit(v) for g, names in FIELD_GROUPS.items() for n in names for v in (n, g)])[field_key(x)]


def evidence(cards: DataFrame) -> DataFrame:
    """Per card (card_id, material, evidence: array of (field, fragment)): the groups that a literal fragment proves, the fields that none does, and the fields to drop.

    A fragment counts if it stands in the material; for figures it must have a digit too.
    """
    items = F.transform("evidence", lambda e: F.struct(field_key(e["field"]).alias("key"), (T.is_literal_part(e["fragment"], "material") & (~field_key(e["field"]).isin(*NUMERIC) | (F.size(digits(e["fragment"])) > 0))).alias("ok")))
    groups = F.create_map(*[F.lit(v) for g, names in FIELD_GROUPS.items() for n in names for v in (n, g)])
    rows = cards.withColumn("_e", items)
    proved = F.array_sort(F.array_distinct(F.array_compact(F.transform(F.filter("_e", lambda e: e["ok"]), lambda e: groups[e["key"]]))))
    unproved = F.array_sort(F.array_distinct(F.transform(F.filter("_e", lambda e: ~e["ok"]), lambda e: e["key"])))
    rows = rows.withColumns({"proved": proved, "unproved": unproved}).drop("_e")
    gone = [F.when(F.array_contains("unproved", k), F.lit(f)) for k, fields in DROPS for f in fields]
    return rows.withColumn("dropped", F.array_distinct(F.array_compact(F.array(*gone))))


def parity(a: Column, b: Column) -> Column:
    """Why two languages' texts don't match in length, or null: es-empty, en-empty, or ratio under 0.6."""
    x, y = T.word_count(a), T.word_count(b)
    return F.when(x == 0, "es-empty").when(y == 0, "en-empty").when(F.least(x, y) / F.greatest(x, y) < PARITY, "ratio")


def copied(generated: Column, material: Column) -> Column:
    """The first five runs of eight words that a text shares with its material."""
    return F.slice(T.shared_ngrams(generated, material, COPY_WORDS), 1, 5)


def banned(x: Column, terms: list[str]) -> Column:
    t = T.norm(x)
    return F.array_compact(F.array(*[F.when(F.contains(t, T.norm(F.lit(w))), F.lit(w)) for w in terms]))


def length_problems(summary: Column, why: Column, transit: Column) -> Column:
    s, w, t = T.word_count(summary), T.word_count(why), T.word_count(transit)
    return F.array_compact(F.array(F.when((s > 0) & ~s.between(*SUMMARY_WORDS), "summary"), F.when(w > WHY_WORDS, "why"), F.when(t > TRANSIT_WORDS, "transit")))


def outcome(rows: DataFrame) -> DataFrame:
    """What becomes of a card, in this order: no job for it, copied, essential fields missing, locked, needs a human, written. Columns: job, copied, missing, locked, parity."""
    return rows.withColumn("outcome", F.when(~F.col("job"), "no-job").when(F.size("copied") > 0, "copied").when(F.size("missing") > 0, "discarded").when(F.col("locked"), "locked").when(F.col("parity").isNotNull(), "needs-human").otherwise("written"))


def corpus_overlap(generated: DataFrame, sources: DataFrame, n: int = COPY_WORDS) -> DataFrame:
    """(id, source_id, shared): how many runs of n words a text (id, text) shares with each source (source_id, text). Runs meet by hash and are compared as text."""
    grams = lambda df, key: df.select(key, F.explode(T.word_ngrams("text", n)).alias("gram")).withColumn("h", F.xxhash64("gram"))
    return grams(generated, "id").join(grams(sources, "source_id"), ["h", "gram"]).groupBy("id", "source_id").agg(F.count("*").alias("shared"))
