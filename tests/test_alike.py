"""Alike titles are found however they begin, and copies are paired once each."""

import random

from pyspark.sql import functions as F

from harrow.functions import text as T
from harrow.operators import matching
from harrow.plans import catalog


def sets(t):
    t = t.replace(" ", "")
    return {t[i : i + 3] for i in range(max(len(t) - 2, 1))} if t else set()


def test_alike_titles(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(80):
        t = "".join(rng.choices("abcdefgh", k=36))
        rows += [t, rng.choice("xyz") + t[1:], t[0] + rng.choice("xyz") + t[2:], t[:35] + "z", t]
    rows += ["", "", "ab", "ab"] + ["same title of many copies"] * 300
    rows = [(i, t, "en" if i % 7 else "fr") for i, t in enumerate(rows)]
    got = matching.alike_titles(spark.createDataFrame(rows, "ord long, title string, lang string"), "lang").collect()
    low, want = {}, set()
    for i, t, lang in rows:
        first = low.setdefault((lang, frozenset(sets(t))), i)
        if first < i:
            want.add((first, i, 1.0))
    firsts = sorted((i, lang, g) for (lang, g), i in low.items())
    want |= {(i, j, len(g & h) / len(g | h)) for i, k, g in firsts for j, m, h in firsts if i < j and k == m and g and h and len(g & h) / len(g | h) >= 0.82}
    assert len(got) == len(want) < 3000 and {(r.a, r.b, r.likeness) for r in got} == want
    titles = {i: t for i, t, _ in rows}
    assert any(titles[a][:2] != titles[b][:2] for a, b, _ in want)


def test_every_alike_pair(spark):
    rng = random.Random(5)
    base = ["".join(rng.choices("abcdefgh", k=36)) for _ in range(40)]
    rows = [(i, t, "en") for i, t in enumerate(base + ["x" + t[1:] for t in base] + base[:20] + ["x" + t[1:] for t in base[:10]] + ["", ""])]
    got = matching.all_alike_titles(spark.createDataFrame(rows, "ord long, title string, lang string"), "lang").collect()
    like = lambda g, h: len(g & h) / len(g | h) if g | h else 1.0
    want = {(i, j, like(sets(t), sets(u))) for i, t, _ in rows for j, u, _ in rows if i < j and like(sets(t), sets(u)) >= 0.82}
    assert len(got) == len(want) and {(r.a, r.b, r.likeness) for r in got} == want


def test_title_trigram_pairs_begin_alike(spark, tmp_path):
    t = "the same long title that many have here"
    docs = [(1, t, "en"), (2, "x" + t[1:], "en"), (3, t[:-1] + "x", "en"), (4, t, "fr"), (5, t, None), (6, t, None), (7, None, "en"), (8, "", "en")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    pairs = {(r.a, r.b) for r in catalog.queries()["title_trigram_pairs"](spark, str(tmp_path)).collect()}
    assert pairs == {(1, 3), (7, 8)}


def test_few_sets_meet(spark):
    """Titles of common words and a number: few pairs meet by their keys, and all alike ones do, in large sets, small ones and those between."""
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(6)]
    titles = {f"{rng.choice(words)} {rng.choice(words)} Brand#{rng.randrange(3)} {i * 300}" for i in range(1500)}
    for n in (1, 2, 3, 4, 50, 54, 58, 62, 64, 66, 70, 90):
        t = "".join(rng.choices("ijklmnopq", k=n + 2))
        titles |= {t, t + "z", "z" + t, t[: n // 2] + "z" + t[n // 2 + 1 :], t[: n * 7 // 8], t + "".join(rng.choices("xyz", k=n // 8))}
    rows = spark.createDataFrame([(t,) for t in titles], "title string").withColumn("g", T.trigrams("title"))
    ranked = matching._ranked(rows, [], ["title"]).withColumn("key", F.explode(matching._keys(F.col("r"), matching.ALIKE))).select("title", "key")
    met = {(r.a, r.b) for r in ranked.selectExpr("title a", "key").join(ranked.selectExpr("title b", "key"), "key").filter("a < b").select("a", "b").distinct().collect()}
    own = {t: sets(t) for t in titles}
    want = {(a, b) for a in titles for b in titles if a < b and len(own[a] & own[b]) / len(own[a] | own[b]) >= matching.ALIKE}
    assert want <= met and 30 < len(want) and len(met) < 20 * len(titles)


def test_bits_drop_no_alike_sets(spark):
    rng = random.Random(9)
    titles = sorted({t for _ in range(12) for t in [("".join(rng.choices("abcdefgh", k=rng.choice([1, 3, 20, 40, 120]))))] for t in (t, t + "z", t[:9] + "y" + t[10:])})
    rows = spark.createDataFrame([(t,) for t in titles], "title string").withColumn("g", T.trigrams("title"))
    rows = rows.select("title", F.size("g").alias("n"), matching._bits(F.col("g")).alias("bits"))
    a, b = rows.alias("a"), rows.alias("b")
    kept = a.crossJoin(b).filter(matching._may_be_alike(F.col("a.n"), F.col("b.n"), F.col("a.bits"), F.col("b.bits"), matching.ALIKE))
    got = {(r.x, r.y) for r in kept.select(F.col("a.title").alias("x"), F.col("b.title").alias("y")).collect()}
    want = {(s, t) for s in titles for t in titles if len(sets(s) & sets(t)) / len(sets(s) | sets(t)) >= matching.ALIKE}
    assert want <= got and len(want) > len(titles) and len(got) < 3 * len(want)
