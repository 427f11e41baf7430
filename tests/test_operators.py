import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from harrow.operators import changes, extract, health, ledger, matching, metrics, publish, scoring, selection, verify
from harrow.sources import readers, writers
from harrow.sources.schemas import EXTRACT

NOW = datetime(2026, 9, 3, 2, 30)


def sources(*rows):
    return F.array(*[F.struct(F.lit(i).alias("id"), F.lit(t).alias("tier"), F.lit(x).alias("trust"), F.lit("u").alias("url")) for i, t, x in rows])


@pytest.mark.parametrize("rows,points", [([("a", "A", 1.0), ("b", "A", 0.95)], 18), ([("a", "B", 0.8), ("b", "B", 0.8)], 14), ([("a", "C", 0.0)], 0), ([(str(k), "A", 1.0) for k in range(6)], 25), ([("a", "A", 1.0)], 10)])
def test_consensus(spark, rows, points):
    assert spark.range(1).select(scoring.consensus(sources(*rows))).first()[0] == points


@pytest.mark.parametrize("days,points", [(7, 5), (22, 3), (47, 1), (90, 0)])
def test_freshness(spark, days, points):
    at = F.lit(NOW + timedelta(days=days))
    assert spark.range(1).select(scoring.freshness(F.lit("plans"), at, NOW)).first()[0] == points


def test_prefilter_names_the_first_step_that_fails(spark):
    base = {"known": False, "vetoed": False, "covered": False, "collection": "plans", "start_at": NOW + timedelta(days=7), "end_at": None, "lat": 41.38, "lng": 2.17, "title": "t", "description": "d" * 200, "deterministic": 30, "url": "http://x/a"}
    cases = {"pass": {}, "sin-cambios": {"known": True, "vetoed": True}, "vetado": {"vetoed": True}, "sin-fecha": {"start_at": None}, "fuera-de-ventana": {"start_at": NOW + timedelta(days=99)}, "fuera-de-barcelona": {"lat": 40.0}, "url-en-lista-negra": {"url": "http://x/PROMO/a"}, "marcadores-publicitarios": {"title": "Código descuento"}, "material-insuficiente": {"description": "d"}, "sin-consenso-ni-ficha": {"deterministic": 5}, "ya-cubierto-por-planonmap": {"covered": True}}
    names = list(base)
    rows = [(want, *(base | change).values()) for want, change in cases.items()]
    rows += [("pass", *(base | {"start_at": NOW - timedelta(days=30), "end_at": NOW + timedelta(days=1)}).values()), ("pass", *(base | {"collection": "museums", "start_at": None, "deterministic": 0}).values())]
    df = spark.createDataFrame(rows, "want string, known boolean, vetoed boolean, covered boolean, collection string, start_at timestamp, end_at timestamp, lat double, lng double, title string, description string, deterministic int, url string")
    df = df.withColumn("sources", F.array(F.struct(F.lit("a").alias("id"), F.lit("A").alias("tier"), F.lit(1.0).alias("trust"), "url"))).withColumn("extracts", F.array(F.struct(F.lit("u").alias("url"), F.lit("").alias("text"))))
    got = df.select("want", F.coalesce(scoring.prefilter_reason(NOW), F.lit("pass")).alias("got")).collect()
    assert names and all(r.want == r.got for r in got), got


def candidates(spark, n=90, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = rng.randrange(12)
        start = datetime(2026, 1, 1) + timedelta(days=rng.randrange(4))
        rows.append((i, "plans", f"Show {k} of the year" + ("" if rng.random() < 0.7 else " 2"), None if rng.random() < 0.1 else start, start + timedelta(days=2) if rng.random() < 0.5 else None, 41.38 + k * 0.002 + rng.random() * 0.001, 2.17 + rng.random() * 0.001))
    return spark.createDataFrame(rows, "ord long, collection string, title string, start_at timestamp, end_at timestamp, lat double, lng double")


def test_greedy_groups_match_a_plain_loop(spark):
    df = candidates(spark)
    rows = df.collect()
    import math

    def grams(t):
        t = t.lower().replace(" ", "")
        return {t[i : i + 3] for i in range(len(t) - 2)}

    def metres(a, b):
        h = math.sin(math.radians(b.lat - a.lat) / 2) ** 2 + math.cos(math.radians(a.lat)) * math.cos(math.radians(b.lat)) * math.sin(math.radians(b.lng - a.lng) / 2) ** 2
        return 2 * 6_371_000 * math.asin(min(1, math.sqrt(h)))

    def key(r):
        return ("".join(c for c in r.title.lower() if c.isalnum())[:40], r.start_at.date(), f"{r.lat:.2f}", f"{r.lng:.2f}")

    def same(a, b):
        dated = a.start_at and b.start_at
        near = dated and metres(a, b) < 150 and a.start_at <= (b.end_at or b.start_at) and b.start_at <= (a.end_at or a.start_at)
        x, y = grams(a.title), grams(b.title)
        return bool(dated and key(a) == key(b)) + bool(near) + (len(x & y) / len(x | y) >= 0.82) >= 2

    groups = []
    for r in sorted(rows, key=lambda r: r.ord):
        target = next((g for g in groups if any(same(m, r) for m in g)), None)
        if target is None:
            groups.append([r])
        else:
            target.append(r)
    want = {m.ord: g[0].ord for g in groups for m in g}
    pairs = matching.same_pairs(df)
    assert {(r.a, r.b) for r in pairs.collect()} == {(a.ord, b.ord) for a in rows for b in rows if a.ord < b.ord and same(a, b)}
    assert {r.ord: r.group_id for r in matching.greedy_groups(df, pairs).collect()} == want and len(set(want.values())) < len(want)


def test_diversify_matches_a_plain_loop(spark):
    rng = random.Random(7)
    rows = [(i, rng.randrange(45, 90), rng.choice("abc"), rng.choice("nmop"), rng.choice("vwxyz"), rng.random() < 0.1, rng.random() < 0.15, rng.random() < 0.1) for i in range(150)]
    for limit in (4, 9):
        ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
        picked, left, used, have = [], [], {}, {"cheap": 0, "timeless": 0, "seasonal": 0}

        def take(r, picked=picked, used=used, have=have):
            picked.append(r[0])
            for k in (2, 3, 4):
                used[k, r[k]] = used.get((k, r[k]), 0) + 1
            have["cheap"] += r[5]
            have["timeless" if r[6] else "seasonal"] += 1

        for r in ordered:
            if len(picked) >= limit:
                continue
            if r[1] < 62 or any(used.get((k, r[k]), 0) >= m for k, m in ((2, 2), (3, 2), (4, 1))):
                left.append(r)
            else:
                take(r)
        for need, fits in (("cheap", lambda r: r[5]), ("timeless", lambda r: r[6]), ("seasonal", lambda r: not r[6])):
            while have[need] < 1 and len(picked) < limit:
                filler = next((r for r in left if r[0] not in picked and fits(r) and not r[7] and r[1] >= 55), None)
                if filler is None:
                    break
                take(filler)
        df = spark.createDataFrame(rows, "ord long, total int, category string, neighbourhood string, venue string, cheap boolean, timeless boolean, vetoed boolean")
        got = selection.diversify(df, limit)
        assert got.count() == 150 and [r.ord for r in got.filter("pick IS NOT NULL").orderBy("pick").collect()] == picked


def test_linked_data_and_merge(spark):
    script = '<script type="application/ld+json">{"@graph":[{"@type":"MusicEvent","name":["A","B"],"startDate":"2026-01-01","location":{"name":"Hall","address":{"streetAddress":"S 1","addressLocality":"B"},"geo":{"latitude":"41,4","longitude":2}},"offers":[{"lowPrice":5,"highPrice":9}],"image":{"url":"http://i/x.png"}}]}</script>'
    rows = [(1, f'<head><title>T</title><meta property="og:title" content="OG"></head>{script}<h1>H</h1><article>Body <nav>n</nav>text</article>'), (2, "<script type='application/ld+json'>{bad</script><h1>Only</h1>"), (3, None), (4, "")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    node = extract.linked_data(pages).collect()
    assert len(node) == 1 and (node[0].title, node[0].venue_name, node[0].address, node[0].lat, node[0].price_text, node[0].image) == ("A", "Hall", "S 1, B", 41.4, "5 - 9 EUR", "http://i/x.png")
    assert node[0].asDict().keys() == {f.split()[0] for f in EXTRACT.split(", ")}
    merged = {r.page_id: r for r in extract.merged(extract.all_levels(pages)).collect()}
    assert merged[1].title == "A" and merged[1].body_text == "Body text" and merged[2].title == "Only" and 3 not in merged


def test_sitemaps_and_feeds(spark):
    xml = "<sitemapindex><sitemap><loc>http://a/1.xml</loc><lastmod>2026-01-02</lastmod></sitemap></sitemapindex>"
    urls = "<urlset><url><loc> http://a/x?b=1&amp;c=2 </loc></url><url><loc>http://a/y</loc><lastmod>2026-01-01</lastmod></url></urlset>"
    got = readers.sitemap_urls(spark.createDataFrame([("s", xml), ("s", urls), ("s", "<broken"), ("s", None)], "source_id string, xml string")).collect()
    assert sorted((r.kind, r.loc) for r in got) == [("map", "http://a/1.xml"), ("page", "http://a/x?b=1&c=2"), ("page", "http://a/y")]
    feeds = "<rss><item><link><![CDATA[http://f/1]]></link><pubDate>d</pubDate></item></rss>", "<feed><entry><link rel='x' href='http://f/2'/><updated>u</updated></entry></feed>"
    assert sorted(r.loc for r in readers.feed_urls(spark.createDataFrame([("s", f) for f in feeds], "source_id string, xml string")).collect()) == ["http://f/1", "http://f/2"]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id int, v string")
    writers.sorted_ndjson(df, str(tmp_path / "n"), ["id"])
    (tmp_path / "n" / "more.json").write_text("\nnot json\n\n")
    assert [tuple(r) for r in readers.ndjson(spark, str(tmp_path / "n"), "id int, v string").orderBy("id").collect()] == [(1, "a"), (2, "b")]
    cards = tmp_path / "cards" / "collection=plans"
    cards.mkdir(parents=True)
    (cards / "good-one.json").write_text('{\n"slug": "good-one", "title": "T"}')
    (cards / "other.json").write_text('{"slug": "wrong", "title": "T"}')
    (cards / "broken.json").write_text("{")
    valid, invalid = readers.cards(spark, str(tmp_path / "cards"), "slug string, title string, collection string")
    assert [r.slug for r in valid.collect()] == ["good-one"] and invalid.count() == 2
    log = spark.createDataFrame([(datetime(2026, 1, 5), "x"), (datetime(2026, 2, 5), "y")], "at timestamp, v string")
    writers.append_log(log, str(tmp_path / "log"))
    writers.append_log(log, str(tmp_path / "log"))
    assert readers.month_log(spark, str(tmp_path / "log"), "at timestamp, v string", "2026-02").count() == 2


def test_upserts(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), (None, 1, "x")], "k string, first int, v string")
    new = spark.createDataFrame([("b", 9, None), ("c", 9, "z"), (None, 9, "n")], "k string, first int, v string")
    assert {tuple(r) for r in writers.upserted(old, new, ["k"], ["first"]).collect()} == {("a", 1, "x"), ("b", 1, None), ("c", 9, "z"), (None, 1, "n")}
    assert writers.inserted_if_absent(old.filter("k is not null"), new.filter("k is not null"), ["k"]).count() == 3
    assert writers.deleted(old, new, ["k"]).filter("k = 'b'").count() == 0
    assert spark.range(1).select(writers.sorted_map(F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2)))).first()[0] == {"a": 2, "b": 1}


def test_health_states(spark):
    counts = [10] * 7 + [2] + [0] * 7 + [10]
    runs = spark.createDataFrame([("s", datetime(2026, 1, 1) + timedelta(days=i), n, 0.1, None) for i, n in enumerate(counts)], "source_id string, run timestamp, extracted long, empty_rate double, error string")
    got = health.judged(runs).orderBy("run").collect()
    assert [r.status for r in got[:8]] == ["ok"] * 7 + ["degraded"] and got[7].streak == 1 and got[7].median7 == 10


def test_ledger(spark):
    rows = [("2026-01", i, e) for i, e in enumerate([3.0, 2.5, 1.5, 0.6, 0.5])] + [("2026-02", 9, 9.0)]
    got = ledger.guard(spark.createDataFrame(rows, "month string, ord long, eur double")).orderBy("month", "ord").collect()
    assert [r.admitted for r in got] == [True, False, True, False, True, False]
    pricing = spark.createDataFrame([("m", 1.0, 4.0)], "model string, input_usd double, output_usd double")
    call = spark.createDataFrame([("m", 1_000_000, 500_000)], "model string, input_tokens long, output_tokens long")
    assert ledger.cost(call, pricing).first().eur == pytest.approx(3 * 0.93)


def test_published_parts(spark):
    """Parts are the collection cut where slugs say; a card that changes, comes or goes changes parts beside it only."""
    import hashlib
    import json

    rows = [(c, f"s{i:04d}", f"t {i} \n") for c, n in (("big", 900), ("small", 2), (None, 3)) for i in range(n)] + [("big", None, "no slug"), ("big", "s0003", "again")]
    schema = "collection string, slug string, title string"
    cards = spark.createDataFrame(rows, schema).repartition(7)
    got = publish.parts(cards, ["slug", "title"], "CC", 50).collect()
    begins = lambda s: s is not None and int(hashlib.md5(s.encode()).hexdigest()[:8], 16) % 50 == 0
    want, name = {}, ""
    for c in ("big", "small", None):
        name = ""
        for _, slug, title in sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or "", r[2])):
            name = slug if begins(slug) else name
            want.setdefault((c, name), []).append({k: v for k, v in (("slug", slug), ("title", title)) if v is not None})
    assert {(r.collection, r.part): json.loads(r.body)["items"] for r in got} == want and len(want) > 12
    index = {r.collection: r for r in publish.index(spark.createDataFrame(got)).collect()}
    digests = [r.sha256 for r in sorted((r for r in got if r.collection == "big"), key=lambda r: r.part)]
    assert index["big"]["count"] == 902 and index["big"].sha256 == hashlib.sha256("\n".join(digests).encode()).hexdigest()
    begun = sorted(p for c, p in want if c == "big")
    other = [r for r in rows if r[1] != begun[3]] + [("big", begun[5] + "x", "new"), ("new", "a", "b")]
    changes = {(r.collection, r.part): r.change for r in publish.changed_parts(spark.createDataFrame(got), publish.parts(spark.createDataFrame(other, schema), ["slug", "title"], "CC", 50)).collect()}
    after = begun[5] + "x" if begins(begun[5] + "x") else begun[5]
    assert changes == {("big", begun[3]): "removed", ("big", begun[2]): "changed", ("big", after): "added" if after != begun[5] else "changed", ("new", ""): "added"}
    assert publish.parts(cards.limit(0), ["slug"], "CC").count() == 0


def test_verify_and_publish(spark):
    e = lambda f, x: (f, x)
    df = spark.createDataFrame([(1, "Entrada 12 euros. Dilluns 10-14.", [e("precio", "entrada 12 EUROS"), e("horario", "dimarts"), e("price", "dilluns")])], "card_id int, material string, evidence array<struct<field:string,fragment:string>>")
    r = verify.evidence(df).first()
    assert (r.proved, r.unproved, r.dropped) == (["price"], ["horario", "price"], [])
    assert spark.range(1).select(verify.parity(F.lit("a b c"), F.lit("a"))).first()[0] == "ratio"
    cards = spark.createDataFrame([("plans", "b", "B"), ("plans", "a", "A")], "collection string, slug string, title string")
    files = publish.envelopes(cards, ["slug", "title"], "CC")
    body = files.first()
    assert '"slug":"a"' in body["body"].split('"slug":"b"')[0] and publish.verified(files).first()["intact"]
    gate = publish.gate(cards, cards.limit(1)).first()
    assert gate.held_back
    assert publish.slug_conflicts(cards.union(cards.withColumn("collection", F.lit("shows")))).count() == 2


def test_changes_and_trust(spark):
    old = spark.createDataFrame([("a", "h", "p", "f", "e"), ("b", "h", "p", "f", None), ("c", "h", "p", "f", "e")], "slug string, hours string, price string, free string, exhibition string")
    new = spark.createDataFrame([("a", "h", "p", "f", "e"), ("b", "h2", "p", "f", None), ("c", "h", "p", "f", "e2"), ("d", "h", "p", "f", "e")], old.schema)
    assert {r.slug: r.kind for r in changes.museum_changes(old, new).collect()} == {"a": "none", "b": "structured-only", "c": "needs-rewrite", "d": "needs-rewrite"}
    stats = spark.createDataFrame([("a", 0.2, 30), ("b", 0.4, 30), ("c", 0.9, 30), ("d", 0.1, 5), ("e", 0.7, 30)], "source_id string, precision double, proposed long")
    trust = spark.createDataFrame([(s, 0.95) for s in "abcde"], "source_id string, trust double")
    assert {r.source_id: r.new_trust for r in metrics.trust_changes(stats, trust).collect()} == {"a": 0.0, "b": 0.48, "c": 1.0}


def test_transit_hints(spark):
    places = spark.createDataFrame([(1, 41.38, 2.17)], "ord long, lat double, lng double")
    stops = spark.createDataFrame([("Liceu", "metro", 41.381, 2.17), ("Liceu", "metro", 41.3805, 2.17), ("Far", "bus", 41.5, 2.17), ("Drassanes", "metro", 41.378, 2.17)], "name string, kind string, lat double, lng double")
    assert matching.transit_hints(places, stops).first().hints == ["metro Liceu · 60 m", "metro Drassanes · 220 m"]


def test_pretty_json(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", None), (2, None, "é")], "id int, x string, y string")
    writers.pretty_json(rows, str(tmp_path / "pretty"))
    text = "\n".join(p.read_text() for p in sorted((tmp_path / "pretty").glob("part-*")))
    assert '  "id" : 1' in text and '  "y" : "é"' in text and "null" not in text


def test_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from harrow.sources import shared

    assert shared.shared_folder(spark) != shared.shared_folder(spark)
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(ValueError):
        shared.checkpoint_root(cluster)


def test_small_clusters(spark):
    from harrow.operators import briefs

    columns = "titles array<string>, venue_name string, address string, neighbourhood string, district string, lat double, lng double, transit_hints array<string>, date_summary string, schedule_lines array<string>, price_texts array<string>, official_url string, tickets_url string, source_ids array<string>, extracts array<string>"
    rows = spark.createDataFrame([(None,) * 15, (["t"], "v", "a", None, "d", 41.5, 2.0, [], "f", None, [], None, None, ["s"], ["x" * 9000] * 3)], columns)
    got = [(r.material, r.material_tokens) for r in briefs.with_material(rows, most=300).collect()]
    assert got[0][0].startswith("TITULOS_ORIGEN: \nLUGAR:  — \nBARRIO: ? · DISTRITO: ?\nCOORDENADAS: , \nTRANSPORTE: —\n") and got[0][0].endswith("FUENTES: \n--- EXTRACTOS (datos, no texto a copiar) ---")
    assert "[1] " in got[1][0] and "[2] " not in got[1][0] and got[1][1] <= 300 and "COORDENADAS: 41.5, 2\n" in got[1][0]
    clipped = briefs.with_material(rows, most=100).collect()[1].material
    assert len(clipped) <= 301 and clipped.endswith("…")


def test_fence_on_own_lines(spark):
    from harrow.functions import loose_json

    rows = spark.createDataFrame([("```json\n{\"a\": 1}\n```",), ("```json {\"a\": 1}```",)], "x string").select(loose_json.parse(F.col("x")).alias("p")).select("p.via", "p.json").collect()
    assert [(r.via, r.json) for r in rows] == [("fence", '{"a": 1}'), ("balanced", '{"a": 1}')]


@pytest.mark.parametrize("venues,places,limit", [(10**6, 3, 5), (4, 10**6, 5), (10**6, 10**6, 8), (3, 3, 6)])
def test_diversify_prunes_no_pick(spark, venues, places, limit):
    """Picks equal the plain loop's over all rows, however many venues and neighbourhoods there are."""
    rng = random.Random(venues + places)
    rows = [(i, rng.randrange(50, 90) + rng.randrange(4) / 4, rng.choice("abc"), f"n{rng.randrange(places)}" if rng.random() < 0.9 else None, f"v{rng.randrange(venues)}", rng.random() < 0.05, rng.random() < 0.5, rng.random() < 0.2) for i in range(900)]
    q, used, have, picks, left = selection.Quotas(), {}, {"cheap": 0, "timeless": 0, "seasonal": 0}, [], []

    def take(r):
        picks.append(r[0])
        for k, v in zip(("category", "neighbourhood", "venue"), r[2:5], strict=True):
            used[k, v] = used.get((k, v), 0) + 1
        have["cheap"] += r[5]
        have["timeless" if r[6] else "seasonal"] += 1

    for r in sorted(rows, key=lambda r: (-r[1], r[0])):
        if len(picks) < limit:
            if r[1] >= 62 and all(used.get((k, v), 0) < getattr(q, k) for k, v in zip(("category", "neighbourhood", "venue"), r[2:5], strict=True)):
                take(r)
            else:
                left.append(r)
    for need, serves in (("cheap", lambda r: r[5]), ("timeless", lambda r: r[6]), ("seasonal", lambda r: not r[6])):
        while have[need] < getattr(q, need) and len(picks) < limit and (found := next((r for r in left if r[0] not in picks and serves(r) and not r[7] and r[1] >= 55), None)):
            take(found)
    df = spark.createDataFrame(rows, "ord long, total double, category string, neighbourhood string, venue string, cheap boolean, timeless boolean, vetoed boolean")
    got = selection.diversify(df, limit).filter("pick IS NOT NULL").orderBy("pick").collect()
    assert [r.ord for r in got] == picks


def test_parts_are_placed_without_texts(spark):
    """Only slugs are written to find the parts; long texts come to them afterwards, also with cards of one slug and nulls."""
    from pathlib import Path

    rng = random.Random(11)
    rows = [(rng.choice("ab"), f"s{i % 190}", rng.randbytes(2000).hex()) for i in range(200)] + [(None, None, "x"), ("a", None, "y")]
    cards = spark.createDataFrame(rows, "collection string, slug string, text string")
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    size = lambda: sum(p.stat().st_size for p in root.rglob("*.parquet"))
    before = size()
    got = publish.parts(cards, ["slug", "text"], "CC", 20).select("collection", "part", "count", "sha256").collect()
    assert 0 < size() - before < 100_000 and sum(r["count"] for r in got) == len(rows)
    again = publish.bodies(publish.placed(cards, 20), ["slug", "text"], "CC").select("collection", "part", "count", "sha256").collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_greedy_groups_of_one_chain(spark):
    """A chain of a third of all rows, a row that thousands match, and ways down that end early: the groups are the loop's, in few rounds."""
    rng = random.Random(6)
    chain = [(k, k + 1) for k in range(1000)]
    star = [(5000, 5000 + k) for k in range(1, 2000)]
    loose = [tuple(sorted(rng.sample(range(10_000, 10_300), 2))) for _ in range(200)] + [(10_000, 10_000), (10_005, 10_001), (None, 10_002)]
    pairs = chain + star + loose
    earlier: dict[int, list[int]] = {}
    for a, b in pairs:
        if a is not None and a != b:
            earlier.setdefault(max(a, b), []).append(min(a, b))
    group: dict[int, int] = {}
    ids = [*range(1001), *range(5000, 7000), *range(10_000, 10_300), 20_000]
    for i in ids:
        group[i] = min((group[e] for e in earlier.get(i, [])), default=i)
    rows = spark.createDataFrame([(i,) for i in ids], "ord long")
    got = matching.greedy_groups(rows, spark.createDataFrame(pairs, "a long, b long"), most_rounds=14)
    assert {r.ord: r.group_id for r in got.collect()} == group
    assert {r.group_id for r in matching.greedy_groups(rows, spark.createDataFrame([], "a long, b long")).collect()} == set(ids)
    with pytest.raises(RuntimeError):
        matching.greedy_groups(rows, spark.createDataFrame(chain, "a long, b long"), most_rounds=3)


def test_guard_stores_calls_once(spark, monkeypatch):
    counts, stored = [], ledger._stored

    def counted(df, path):
        out = stored(df, path)
        counts.append(out.count())
        return out

    monkeypatch.setattr(ledger, "_stored", counted)
    calls = spark.createDataFrame([("m", i, 0.5 + i % 7) for i in range(400)], "month string, ord long, eur double")
    assert ledger.guard(calls, loop_calls=5).filter("admitted").count() > 1 and 400 <= sum(counts) < 800


@pytest.mark.parametrize("loop_calls", [0, 5, 10_000])
def test_guard_by_rounds(spark, loop_calls):
    """A month of two thirds of all calls, amounts that fit late, ties, repeated calls, nulls: as a loop over each month, whatever a task may hold."""
    rng = random.Random(8)
    rows = [("big", k // 2, round(rng.choice([rng.random() * 0.2, rng.random() * 3, 0.0001, 0.0]), 4)) for k in range(400)]
    rows += [(rng.choice(["a", "b", None]), k, rng.choice([round(rng.random() * 2, 4), 6.0, None, float("nan")])) for k in range(150)] + [("c", 1, 5.0), ("c", 2, 0.0), ("c", 2, 0.0), ("d", 1, 5.0001), ("e", 1, 0.1), ("e", 2, 4.9), ("e", 3, 1e200)]
    want = []
    for month in {r[0] for r in rows}:
        spent = 0.0
        for _, ord_, eur in sorted((r for r in rows if r[0] == month), key=lambda r: (r[1], 0 if r[2] is None or r[2] != r[2] else r[2])):
            fits = eur is not None and spent + eur <= 5
            spent += eur if fits else 0
            want.append((str(month), ord_, str(eur), fits, spent))
    got = ledger.guard(spark.createDataFrame(rows, "month string, ord long, eur double"), loop_calls=loop_calls).collect()
    assert sorted((str(r.month), r.ord, str(r.eur), r.admitted, r.spent) for r in got) == sorted(want)


def test_merging_counts_each_row_once(spark):
    """Rows of one ord are rows all the same: merging goes by their group, not by a join on ord."""
    one = {"title": "T", "source_id": "s", "tier": "A", "trust": 0.5, "url": "u", "body_text": "b", "description": "d", "venue_name": "v", "address": "a", "lat": 1.0, "lng": 2.0, "price": None, "time_confidence": "day", "collection": "c", "category": "k"}
    at = datetime(2026, 1, 1)
    rows = [{**one, "ord": o, "group_id": g, "start_at": at, "end_at": None, "retrieved_at": at} for o, g in [(1, 1), (1, 2), (2, 2)]]
    schema = "ord long, group_id long, title string, source_id string, tier string, trust double, url string, body_text string, description string, venue_name string, address string, lat double, lng double, price struct<type:string,amount:double,amount_max:double,currency:string,has_surcharge:boolean>, time_confidence string, collection string, category string, start_at timestamp, end_at timestamp, retrieved_at timestamp"
    got = {r.group_id: r.n_members for r in matching.merged(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: 1, 2: 2}


@pytest.mark.parametrize("name", ["bounded_material", "assembled_cards"])
def test_small_files_of_much_work_are_dealt(spark, tmp_path, name):
    from harrow.plans import catalog

    parts = [(i, f"name {i % 3}", f"Brand#{i % 5}", "PROMO", i % 9, 1.0) for i in range(200)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert catalog.queries()[name](spark, str(tmp_path)).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
