from datetime import datetime

import pytest
from pyspark.sql import functions as F

from harrow.functions import identity as I
from harrow.functions import loose_json
from harrow.functions import text as T
from harrow.functions import values as V

NOW = datetime(2026, 9, 3, 2, 30)


def one(spark, column, **values):
    kinds = {str: "string", float: "double", int: "long", list: "array<string>", datetime: "timestamp", type(None): "string"}
    values = values or {"unused": 0}
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()))
    return row.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [("  Crème  Brûlée ", "creme brulee"), (None, ""), ("SANT ANDREU", "sant andreu"), ("a\tb", "a b")])
def test_norm(spark, text, expected):
    assert one(spark, T.norm("x"), x=text) == expected
    assert one(spark, T.exact_fold("x"), x=text) == expected


def test_similarity(spark):
    assert one(spark, T.title_similarity("x", "y"), x="Fundació Joan Miró", y="Fundacio Joan Miro") == 1.0
    assert one(spark, T.title_similarity("x", "y"), x="Museu Picasso", y="Museu Picasso de Barcelona") < 0.82
    assert one(spark, T.title_similarity("x", "y"), x="", y="") == 1.0
    assert one(spark, T.trigrams("x"), x="ab") == ["ab"]
    assert one(spark, T.shared_ngrams("x", "y", 3), x="a b c d", y="z b c d") == ["b c d"]
    assert one(spark, T.is_literal_part("x", "y"), x="", y="abc") is False


def test_clip_and_slug(spark):
    assert one(spark, T.clip("x", 10), x="short") == "short"
    assert one(spark, T.clip("x", 10), x="abcdefg hijklm") == "abcdefg…"
    assert one(spark, T.clip("x", 10), x="a bcdefghijklm") == "a bcdefghi…"
    assert one(spark, I.slugify("x"), x="Museu d’Història — Barcelona!") == "museu-dhistoria-barcelona"
    assert one(spark, I.slugify("x"), x="A") == "a-ficha"
    assert one(spark, I.make_id(F.lit("Curated"), F.lit("Museums"), F.col("x")), x="Museu Picassó") == "curated|museums|museu-picass-"
    assert one(spark, T.strip_html("x"), x="<p>a&nbsp;&amp;<script>x</script> b</p>") == "a & b"


def test_dedupe_key(spark):
    key = I.dedupe_key(F.lit('Concert "Sina Bathaie"'), F.lit("2026-09-10T19:30:00.000+02:00"), F.lit(41.39462416093732), F.lit(2.1490629497204705))
    assert one(spark, key) == "concertsinabathaie|2026-09-10|41.39|2.15"


def test_semantic_hash_ignores_what_means_nothing(spark):
    price = F.struct(F.lit("free").alias("type"), F.lit(None).cast("double").alias("amount"), F.lit(None).cast("double").alias("amount_max"))
    slot = lambda d, h: F.struct(F.lit(d).alias("days"), F.lit(h).alias("hours"))
    h = lambda title, slots, lat, tail: I.semantic_hash(F.lit(title), F.lit("2026-01-01T10"), F.lit(None).cast("string"), price, F.lit("V"), F.lit(lat), F.lit(2.1), F.array(*slots), F.concat(F.lit("d" * 600), F.lit(tail)))
    a, b = [slot("Dl", "10"), slot("Dm", "11")], [slot("dm", "11"), slot("DL", "10")]
    assert one(spark, h("Miró", a, 41.38512, "x")) == one(spark, h("MIRO", b, 41.38509, "y"))
    assert one(spark, h("Miró", a, 41.3851, "x")) != one(spark, h("Miro 2", a, 41.3851, "x"))


@pytest.mark.parametrize(
    "text,kind,low,high",
    [
        ("de 29,99 a 49,99 € (+ despeses de gestió)", "paid", 29.99, 49.99), ("0 €", "unknown", None, None), ("0 € · entrada gratuita", "free", None, None), ("Gratuït amb reserva", "free-with-booking", None, None), ("1.500 €", "paid", 500.0, None),
        ("amb invitació", "invitation", None, None), ("Preu a consultar", "paid-unknown", None, None), (None, "unknown", None, None), ("€ 12", "paid", 12.0, None), ("inclòs amb l entrada", "included-with-admission", None, None),
    ],
)
def test_price(spark, text, kind, low, high):
    p = one(spark, V.parse_price("x"), x=text)
    assert (p.type, p.amount, p.amount_max) == (kind, low, high)


@pytest.mark.parametrize(
    "text,iso,confidence",
    [
        ("2026-07-01T10:00:00Z", "2026-07-01T12:00:00.000+02:00", "exact"), ("2026-01-15", "2026-01-15T00:00:00.000+01:00", "day"), ("5/9/2026 21:30", "2026-09-05T21:30:00.000+02:00", "exact"),
        ("12 de setembre de 2026", "2026-09-12T00:00:00.000+02:00", "day"), ("3 march 2026, 20h30", "2026-03-03T20:30:00.000+01:00", "exact"), ("31/02/2026", None, None), ("soon", None, None), (None, None, None),
    ],
)
def test_dates(spark, text, iso, confidence):
    p = one(spark, V.parse_date("x"), x=text)
    assert (p and p.iso, p and p.confidence) == (iso, confidence)


def test_time(spark):
    assert one(spark, V.local_day("x"), x=datetime(2026, 8, 30, 23, 30)) == "2026-08-31"
    assert one(spark, V.local_iso("x"), x=datetime(2026, 1, 1, 12)) == "2026-01-01T13:00:00.000+01:00"
    assert one(spark, V.days_until(F.col("x"), NOW), x=datetime(2026, 9, 4, 2, 31)) == 2
    assert one(spark, V.in_window(F.col("x"), NOW), x=datetime(2026, 9, 2, 2, 30)) is True
    assert one(spark, V.in_window(F.col("x"), NOW), x=datetime(2026, 11, 3, 2, 30)) is False


def test_places_and_categories(spark):
    d = V.metres(F.lit(41.368), F.lit(2.16), F.lit(41.3681), F.lit(2.1601))
    assert 10 < one(spark, d) < 20
    assert one(spark, V.guess_district("x"), x="Carrer de Gràcia, GRACIA") == "Gràcia"
    assert one(spark, V.guess_town("x"), x="L'Hospitalet") == "lhospitalet" and one(spark, V.guess_town("x"), x=None) == "barcelona"
    c = one(spark, V.classify("x", F.lit("plans")), x="Concert al parc amb arte")
    assert (c.category, c.confidence, sorted(c.secondary)) == ("music", "strong", ["arts", "outdoors"])
    assert one(spark, V.classify("x", F.lit("shows")), x="zzz").category == "arts"
    slots = one(spark, V.schedule_slots(F.col("x")), x=["Dilluns: 10-14", "ab", "<b>Tancat</b> dimarts"])
    assert [(s.days, s.hours) for s in slots] == [("Dilluns", "10-14"), ("", "Tancat dimarts")]


@pytest.mark.parametrize("text,json,via", [('{"a":1}', '{"a":1}', "direct"), ('```json\n{"a":1}\n```', '{"a":1}', "fence"), ('so: {"a":"}"} end', '{"a":"}"}', "balanced"), ('{"a":1', None, "failed"), (None, None, "failed"), ("plain", None, "failed")])
def test_loose_json(spark, text, json, via):
    r = one(spark, loose_json.parse(F.col("x")), x=text)
    assert (r.json, r.via) == (json, via)
