"""Queries over what models are told, their batches and decisions, assembled cards, and the bookkeeping of crawls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.functions import identity as I
from harrow.functions import values as V
from harrow.operators import batches, briefs, cards, changes, extract, matching, selection, verify
from harrow.plans import sql as Q
from harrow.plans.tables import NOW, dealt, table
from harrow.sources import readers
from harrow.sources.shared import shared_folder
from harrow.streaming import flows

N = f"TIMESTAMP '{Q.NOW}'"


def _key() -> Column:
    return F.col("p_partkey")


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _clusters(spark: SparkSession, d: str) -> DataFrame:
    lines = F.transform(F.sequence(F.lit(1), F.lit(14)), lambda i: F.concat(F.expr("repeat('dl-dv 10h ', cast(p_partkey % 40 * 2 as int))"), i.cast("string")))
    extracts = F.array(F.expr("repeat(concat(p_name, ' '), cast(1 + p_partkey % 200 as int))"), F.expr("repeat(concat(p_type, ' x '), cast(1 + p_partkey % 90 as int))"), F.col("p_brand"), F.col("p_name"))
    return dealt(table(spark, d, "part"), "p_partkey").select(
        "p_partkey", F.array(F.col("p_name"), _text(F.col("p_name"), " ", F.col("p_brand")), F.col("p_brand"), F.col("p_type")).alias("titles"), F.col("p_name").alias("title"), F.col("p_brand").alias("venue_name"), F.col("p_type").alias("address"),
        F.when(_key() % 3 != 0, _text("N", _key() % 7)).alias("neighbourhood"), F.when(_key() % 4 != 0, _text("D", _key() % 5)).alias("district"), (41.0 + (_key() % 100) / 8.0).alias("lat"), (2.0 + (_key() % 16) / 16.0).alias("lng"),
        F.when(_key() % 2 == 0, F.array(_text("L", _key() % 5), _text("bus ", _key() % 9))).otherwise(F.array().cast("array<string>")).alias("transit_hints"), _text("del ", _key(), " al ", _key() + 1).alias("date_summary"), lines.alias("schedule_lines"),
        F.array(_text(_key(), " €"), F.lit("b"), F.lit("c"), F.lit("d")).alias("price_texts"), F.when(_key() % 5 != 0, _text("https://x/", _key())).alias("official_url"), F.when(_key() % 7 == 0, F.lit("https://t/")).alias("tickets_url"),
        F.array(_text("s", _key() % 20), _text("s", _key() % 3)).alias("source_ids"), F.slice(extracts, F.lit(1), (_key() % 5).cast("int")).alias("extracts"), F.lit("a description").alias("description"), _text(F.col("p_size").cast("string"), " €").alias("price"),
        F.array(F.struct(_text("s", _key() % 20).alias("id"), F.lit("A").alias("tier")), F.struct(F.lit("t").alias("id"), F.lit("C").alias("tier"))).alias("sources"),
    )


_CLUSTERS = """c AS (SELECT p_partkey AS k, [p_name, p_name || ' ' || p_brand, p_brand, p_type] AS titles, p_name AS title, p_brand AS venue, p_type AS address, CASE WHEN p_partkey % 3 <> 0 THEN 'N' || p_partkey % 7 END AS hood,
  CASE WHEN p_partkey % 4 <> 0 THEN 'D' || p_partkey % 5 END AS district, regexp_replace((41.0::DOUBLE + (p_partkey % 100) / 8.0::DOUBLE)::VARCHAR, '[.]0$', '') AS lat, regexp_replace((2.0::DOUBLE + (p_partkey % 16) / 16.0::DOUBLE)::VARCHAR, '[.]0$', '') AS lng,
  CASE WHEN p_partkey % 2 = 0 THEN 'L' || p_partkey % 5 || '; bus ' || p_partkey % 9 ELSE '—' END AS transit, list_transform(range(1, 13), lambda i: repeat('dl-dv 10h ', (p_partkey % 40 * 2)::INT) || i) AS lines,
  p_partkey || ' € | b | c' AS prices, coalesce(CASE WHEN p_partkey % 5 <> 0 THEN 'https://x/' || p_partkey END, '—') AS official, CASE WHEN p_partkey % 7 = 0 THEN 'https://t/' ELSE '—' END AS tickets, p_size,
  list_slice([repeat(p_name || ' ', (1 + p_partkey % 200)::INT), repeat(p_type || ' x ', (1 + p_partkey % 90)::INT), p_brand, p_name], 1, p_partkey % 5) AS extracts FROM part)"""


def bounded_material(spark: SparkSession, d: str) -> DataFrame:
    rows = briefs.with_material(_clusters(spark, d))
    return rows.select("p_partkey", F.sha2("material", 256).alias("digest"), F.col("material_tokens").cast("long").alias("tokens"))


def _material_sql() -> str:
    def m(kept: int) -> str:
        head = "'TITULOS_ORIGEN: ' || array_to_string(list_slice(titles, 1, 3), ' | '), 'LUGAR: ' || venue || ' — ' || address, 'BARRIO: ' || coalesce(hood, '?') || ' · DISTRITO: ' || coalesce(district, '?'), 'COORDENADAS: ' || lat || ', ' || lng, 'TRANSPORTE: ' || transit, 'FECHAS: del ' || k || ' al ' || (k + 1), 'HORARIOS: ' || array_to_string(lines, ' / '), 'PRECIO_TEXTO: ' || prices, 'WEB_OFICIAL: ' || official, 'ENTRADAS: ' || tickets, 'FUENTES: s' || k % 20 || ', s' || k % 3, '--- EXTRACTOS (datos, no texto a copiar) ---'"
        return f"array_to_string(list_concat([{head}], list_transform(list_slice(extracts, 1, {kept}), lambda e, i: '[' || i || '] ' || {Q.clip('e', 700)})), chr(10))"

    fits = lambda x: f"ceil(length({x}) / 3.6::DOUBLE) <= 2500"
    return f"WITH {_CLUSTERS}, m AS (SELECT k, {m(1)} AS m1, {m(2)} AS m2, {m(3)} AS m3 FROM c), p AS (SELECT k, CASE WHEN {fits('m3')} THEN m3 WHEN {fits('m2')} THEN m2 WHEN {fits('m1')} THEN m1 ELSE {Q.clip('m1', 7500)} END AS t FROM m) SELECT k AS p_partkey, sha256(t) AS digest, ceil(length(t) / 3.6::DOUBLE)::BIGINT AS tokens FROM p"


def screening_texts(spark: SparkSession, d: str) -> DataFrame:
    return _clusters(spark, d).withColumn("cluster_id", _key()).select("p_partkey", briefs.screening_text(_key() % 10 + 1).alias("text"))


_JOINED = "CASE WHEN len(extracts) > 0 THEN array_to_string(extracts, ' ') ELSE 'a description' END"
_SCREEN_SQL = f"WITH {_CLUSTERS} SELECT k AS p_partkey, '[' || (k % 10 + 1) || '] id: ' || k || chr(10) || '    titulo: ' || title || chr(10) || '    lugar: ' || venue || coalesce(' (' || district || ')', '') || chr(10) || '    fechas: del ' || k || ' al ' || (k + 1) || chr(10) || '    precio: ' || p_size || ' €' || chr(10) || '    fuentes: s' || k % 20 || '(A), t(C)' || chr(10) || '    texto: ' || {Q.clip(_JOINED, 900)} AS text FROM c"


def decision_log(spark: SparkSession, d: str) -> DataFrame:
    o = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(
        o.alias("cluster_id"), F.lit("plans").alias("collection"), F.sha2(o.cast("string"), 256).alias("digest"), F.col("o_orderstatus").alias("model"), (o % 2 == 0).alias("passed"), (o % 900).alias("input_tokens"), (o % 70).alias("output_tokens"),
        F.col("o_orderpriority").alias("reason"), (o % 100 / 10.0).alias("score"),
    )
    at = F.lit(NOW).cast("timestamp")
    log = batches.model_decisions(rows.filter(o % 3 == 0), "screen", at).unionByName(batches.model_decisions(rows.filter(o % 3 == 1), "write", at)).unionByName(batches.stage_decisions(rows.filter(o % 3 == 2), "prefilter", at))
    return log.drop("at")


def _key_sql(task: str) -> str:
    return f"sha256('{task}|{I.PROMPT_VERSIONS[task]}|' || o_orderstatus || '|' || sha256(o_orderkey::VARCHAR))"


_LOG_SQL = f"""SELECT o_orderkey AS cluster_id, 'plans' AS collection, CASE o_orderkey % 3 WHEN 0 THEN 'screen' WHEN 1 THEN 'write' ELSE 'prefilter' END AS stage, CASE WHEN o_orderkey % 2 = 0 THEN 'passed' ELSE 'rejected' END AS outcome,
  CASE o_orderkey % 3 WHEN 0 THEN {_key_sql('screen')} WHEN 1 THEN {_key_sql('write')} ELSE o_orderpriority END AS reason, CASE WHEN o_orderkey % 3 = 2 THEN (o_orderkey % 100 / 10.0::DOUBLE) END AS score, CASE WHEN o_orderkey % 3 < 2 THEN o_orderstatus END AS model,
  CASE o_orderkey % 3 WHEN 0 THEN '{I.PROMPT_VERSIONS['screen']}' WHEN 1 THEN '{I.PROMPT_VERSIONS['write']}' END AS prompt_version, CASE WHEN o_orderkey % 3 < 2 THEN o_orderkey % 900 END AS input_tokens, CASE WHEN o_orderkey % 3 < 2 THEN o_orderkey % 70 END AS output_tokens FROM orders"""


def collected_jobs(spark: SparkSession, d: str) -> DataFrame:
    results = table(spark, d, "orders").select("o_orderkey", _text("job-", F.col("o_custkey"), "-", F.col("o_orderkey") % 5).alias("custom_id"), F.when(F.col("o_orderkey") % 7 != 0, "{}").alias("card"))
    jobs = table(spark, d, "customer").select(F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("i"), "c_custkey", F.col("c_name").alias("slug")).select(_text("job-", F.col("c_custkey"), "-", F.col("i")).alias("custom_id"), "slug")
    return batches.collected(results, jobs).select("o_orderkey", "slug", "outcome")


def missing_verdicts(spark: SparkSession, d: str) -> DataFrame:
    returned = table(spark, d, "orders").filter("o_orderkey % 4 = 0").select(F.col("o_custkey").alias("id")).distinct()
    return batches.missing(table(spark, d, "customer").select(F.col("c_custkey").alias("id")), returned, "id")


def _batches(spark: SparkSession, d: str) -> DataFrame:
    o = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(o.alias("batch_id"), (F.lit(NOW).cast("timestamp") - F.make_interval(hours=(o % 60).cast("int"))).alias("submitted_at"), F.when(o % 9 != 0, o % 3 == 0).alias("ready"))
    return batches.batch_states(rows, NOW)


_STATES = f"states AS (SELECT o_orderkey AS batch_id, CASE WHEN o_orderkey % 9 <> 0 AND o_orderkey % 3 = 0 THEN 'ready' WHEN {N} - to_hours((o_orderkey % 60)::INT) + INTERVAL 26 HOUR < {N} THEN 'expired' ELSE 'waiting' END AS state FROM orders)"


def batch_states(spark: SparkSession, d: str) -> DataFrame:
    return _batches(spark, d).select("batch_id", "state")


def requeued_items(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("batch_id"), "l_linenumber")
    return batches.requeued(items, _batches(spark, d))


def stream_replayed(spark: SparkSession, d: str) -> DataFrame:
    """Results that arrive twice are stored once."""
    folder = shared_folder(spark)
    rows = table(spark, d, "events").select(_text(F.col("event_type"), "-", F.col("user_id")).alias("custom_id"))
    for _ in range(2):
        rows.write.mode("append").parquet(f"{folder}/in")
    return flows.replayed(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 8).parquet(f"{folder}/in"), folder)


def requested_sources(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("s_suppkey") % 4
    kinds = F.when(s == 0, F.array(F.lit("plans"))).when(s == 1, F.array(F.lit("plans"), F.lit("shows"))).when(s == 2, F.array(F.lit("museums"))).otherwise(F.array().cast("array<string>"))
    return batches.requested(table(spark, d, "supplier").select("s_suppkey", kinds.alias("collections")), ["shows", "museums"]).select("s_suppkey")


def crawl_totals(spark: SparkSession, d: str) -> DataFrame:
    return batches.crawl_totals(table(spark, d, "lineitem").select(F.col("l_linenumber").alias("discovered"), F.col("l_quantity").cast("long").alias("fetched"), (F.col("l_suppkey") % 3).alias("not_modified")))


def pages_on_day(spark: SparkSession, d: str) -> DataFrame:
    o = F.col("o_orderkey")
    index = table(spark, d, "orders").select(_text("s", F.col("o_custkey") % 20).alias("source_id"), (F.lit(NOW).cast("timestamp") - F.make_interval(hours=(o % 48).cast("int"))).alias("last_seen"), F.when(o % 4 == 0, 304).when(o % 9 != 0, 200).alias("status"))
    return batches.pages_on(index, F.lit(NOW.date()))


def retention_days(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, "2001-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))
    return batches.within(rows, "day", NOW, 1000)


IMAGES = ("https://www.macba.cat/a.jpg", "https://upload.wikimedia.org/x.png", "http://media.timeout.com/x.jpg", "https://barcelona.cat/i", "nonsense", "https://Res.Cloudinary.com/z", "https://img.shutterstock.macba.cat/q", "https://example.org/z")


def _pick(values: tuple[str, ...], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def resolved_images(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.when(_key() % 11 != 0, _pick(IMAGES, _key())).alias("candidate_url"), F.col("p_brand").alias("venue_name"), F.when(_key() % 3 == 0, _text("https://c/", _key())).alias("commons_url"), F.lit("CC BY").alias("commons_credit"))
    return rows.withColumn("i", cards.resolved_image()).select("p_partkey", "i.url", "i.credit", "i.source")


def _images_sql() -> str:
    shown = " OR ".join(f"ends_with(h, '{x[1:]}')" if x.startswith(".") else f"h = '{x}'" for x in cards.RENDERABLE_HOSTS)
    never = " OR ".join(f"contains(h, '{x}')" for x in cards.NEVER_HOSTS)
    values = "[" + ", ".join(f"'{x}'" for x in IMAGES) + "]"
    return f"WITH u AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 11 <> 0 THEN {values}[p_partkey % {len(IMAGES)} + 1] END AS u FROM part), h AS (SELECT *, {Q.host('u')} AS h FROM u), o AS (SELECT *, coalesce(({shown}) AND NOT ({never}), false) AS ok FROM h) SELECT p_partkey, CASE WHEN ok THEN u WHEN p_partkey % 3 = 0 THEN 'https://c/' || p_partkey END AS url, CASE WHEN ok THEN p_brand WHEN p_partkey % 3 = 0 THEN 'CC BY' END AS credit, CASE WHEN ok THEN 'venue' WHEN p_partkey % 3 = 0 THEN 'wikimedia' END AS source FROM o"


FREE = ("Entrada lliure. Gratuït els diumenges; la resta 12 €", "Gratis el primer domingo de mes. gratis  el primer domingo de mes.", "sense preu", "Free for children under 8")


def free_admission(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", cards.free_admission(F.array(_pick(FREE, _key()), _pick(FREE, _key() + 1)), F.array(F.col("p_name"), _pick(FREE, _key() % 3))).alias("f"))
    return rows.select("p_partkey", F.array_join(F.array_sort("f"), "#").alias("lines"))


_FREE_LIST = "[" + ", ".join(f"'{x}'" for x in FREE) + "]"
_FREE_SQL = f"WITH x AS (SELECT p_partkey, {_FREE_LIST}[p_partkey % 4 + 1] || ' ' || {_FREE_LIST}[(p_partkey + 1) % 4 + 1] || ' ' || p_name || ' ' || {_FREE_LIST}[p_partkey % 3 % 4 + 1] AS t FROM part) SELECT p_partkey, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all({Q.norm('t')}, '{cards.FREE_LINE}'), lambda f: left(trim(f), 120)))), '#') AS lines FROM x"


def structured_update(spark: SparkSession, d: str) -> DataFrame:
    museum = F.struct(F.array(F.lit("old")).alias("openingHours"), F.array(F.lit("none")).alias("freeAdmission"), F.lit(30).alias("visitMinutes"))
    museum = F.when(_key() % 5 != 0, museum)  # every fifth card has no museum part yet
    published = table(spark, d, "part").select(_key().alias("slug"), F.col("p_retailprice").alias("price"), F.array(F.lit("old")).alias("schedule"), F.struct(F.lit("then").alias("curatedAt"), F.col("p_name").alias("why"), museum.alias("museum")).alias("curated"))
    fresh = table(spark, d, "part").filter(_key() % 3 == 0).select(_key().alias("slug"), (F.col("p_retailprice") + 1).alias("price"), F.array(_text("h", _key() % 5)).alias("hours"), F.array(F.lit("diumenge")).alias("free"))
    rows = cards.structured_update(published, fresh, F.lit("now"))
    return rows.select("slug", "price", F.array_join("schedule", ",").alias("schedule"), F.col("curated.curatedAt").alias("curated_at"), F.col("curated.why").alias("why"), F.array_join("curated.museum.openingHours", ",").alias("hours"), F.array_join("curated.museum.freeAdmission", ",").alias("free"), F.col("curated.museum.visitMinutes").alias("minutes"))


def assembled_cards(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None)
    kind = F.when(_key() % 3 == 0, "plans").when(_key() % 3 == 1, "shows").otherwise("museums")
    sources = F.array(F.struct(F.lit("s1").alias("id"), F.when(_key() % 2 == 0, "A").otherwise("C").alias("tier"), F.lit("https://s1/").alias("url"), F.lit("2001-06-01").alias("retrieved_at")), F.struct(F.when(_key() % 4 == 0, "museus-bcn").otherwise("articket").alias("id"), F.when(_key() % 5 == 0, "B").otherwise("C").alias("tier"), F.lit("https://s2/").alias("url"), F.lit("2001-06-02").alias("retrieved_at")))
    rows = dealt(table(spark, d, "part"), "p_partkey").withColumns({"candidate_url": _pick(IMAGES, _key()), "venue_name": F.col("p_brand"), "commons_url": none.cast("string"), "commons_credit": none.cast("string")}).select(
        _text("slug-", _key()).alias("slug"), kind.alias("collection"), (F.col("p_size") + 0.5).alias("total"), F.when(_key() % 5 == 0, "temporada").otherwise("puntual").alias("temporality"), sources.alias("sources"),
        F.when(_key() % 7 != 0, "2001-06-20").alias("start_date"), F.when(_key() % 2 == 0, "2001-06-21").alias("end_date"), F.when(_key() % 4 == 0, F.lit("https://o/")).alias("official_url"), none.cast("string").alias("tickets_url"),
        F.col("p_name").alias("title_es"), F.when(_key() % 2 == 0, F.col("p_brand")).alias("title_en"), F.col("p_type").alias("summary_es"), F.lit("").alias("summary_en"), F.expr("repeat(concat(p_name, ' '), 30)").alias("why_es"), none.cast("string").alias("why_en"),
        F.when(_key() % 3 != 0, F.expr("repeat('metro ', 50)")).alias("transit_es"), none.cast("string").alias("transit_en"), F.lit("").alias("includes_es"), F.lit("x").alias("includes_en"),
        F.when(_key() % 2 == 0, F.col("p_size")).alias("minutes"), none.cast("string").alias("booking"), none.cast("int").alias("lead_days"), none.cast("array<string>").alias("languages"), F.transform(F.sequence(F.lit(1), F.lit(25)), lambda i: i.cast("string")).alias("audience"),
        F.when(_key() % 4 == 1, F.array(F.struct(F.lit("dl").alias("days"), F.lit("10").alias("hours")))).alias("hours"), F.array().cast("array<string>").alias("free"), F.when(_key() % 8 == 2, "Miró").alias("exhibition"), F.lit("2001-07-01").alias("exhibition_until"), none.cast("int").alias("visit_minutes"), none.cast("boolean").alias("book_ahead"),
        F.when(_key() % 2 == 0, F.col("p_brand")).alias("artist"), none.cast("string").alias("room"), none.cast("array<string>").alias("surtitles"), cards.resolved_image().alias("image"), F.array(F.lit("10h")).alias("schedule"), F.struct((_key() % 2 == 1).alias("schedule"), (_key() % 3 == 1).alias("price")).alias("verified"),
        F.struct(F.col("venue_name").alias("name"), F.col("p_type").alias("address"), F.when(_key() % 3 == 1, "Gràcia").alias("neighborhood")).alias("venue"), F.lit("culture").alias("category"), F.lit("12 €").alias("price"), F.lit("k").alias("dedupe_key"), (_key() % 6 == 0).alias("locked"),
    )
    rows = rows.withColumn("merge_hint", matching.merge_hint(F.col("temporality"), F.col("sources")))
    text = cards.assembled(rows, NOW, I.PROMPT_VERSIONS["write"]).select("slug", F.to_json("card").alias("j"))
    at = {"id": "$.id", "source_url": "$.sourceUrl", "why": "$.curated.whyWorthIt.es", "title_en": "$.i18n.title.en", "summary_en": "$.i18n.description.en", "transit": "$.curated.practical.transit.es", "includes": "$.curated.practical.priceIncludes", "score": "$.curated.score", "n_sources": "$.curated.consensus.sourceCount", "publishers": "$.curated.provenance[*].publisher", "retrieved": "$.curated.provenance[1].retrievedAt", "verified": "$.curated.verified", "venue": "$.venue", "image_source": "$.imageSource", "merge_hint": "$.curated.keys.mergeHint", "artist": "$.curated.show.artistOrCompany", "exhibition": "$.curated.museum.currentExhibition.title", "hours": "$.curated.museum.openingHours[0].hours", "end_date": "$.endDate", "image": "$.image", "schedule": "$.schedule[0]", "locked": "$.curated.locked", "last_audience": "$.audience[19]", "too_many": "$.audience[20]"}
    has = {"has_show": "$.curated.show", "has_museum": "$.curated.museum"}
    got = F.get_json_object
    return text.select("slug", *[got("j", p).alias(c) for c, p in at.items()], *[got("j", p).isNotNull().alias(c) for c, p in has.items()])


def _cards_sql() -> str:
    values = "[" + ", ".join(f"'{x}'" for x in IMAGES) + "]"
    url = f"{values}[p_partkey % {len(IMAGES)} + 1]"
    host = Q.host(url)
    shown = " OR ".join(f"ends_with({host}, '{x[1:]}')" if x.startswith(".") else f"{host} = '{x}'" for x in cards.RENDERABLE_HOSTS)
    never = " OR ".join(f"contains({host}, '{x}')" for x in cards.NEVER_HOSTS)
    m, show = "p_partkey % 3 = 2", "p_partkey % 3 = 1"
    museum = f"({m} AND (p_partkey % 4 = 1 OR p_partkey % 8 = 2))"
    return f"""SELECT 'slug-' || p_partkey AS slug, left('curated|' || CASE p_partkey % 3 WHEN 0 THEN 'plans' WHEN 1 THEN 'shows' ELSE 'museums' END || '|slug-' || p_partkey, 64) AS id, CASE WHEN p_partkey % 4 = 0 THEN 'https://o/' ELSE 'https://s1/' END AS source_url,
  {Q.clip("repeat(p_name || ' ', 30)", 160)} AS why, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS title_en, NULL::VARCHAR AS summary_en, CASE WHEN p_partkey % 3 <> 0 THEN {Q.clip("repeat('metro ', 50)", 200)} END AS transit, NULL::VARCHAR AS includes, (p_size + 1)::VARCHAR AS score,
  greatest((p_partkey % 2 = 0)::INTEGER + (p_partkey % 5 = 0)::INTEGER, 1)::VARCHAR AS n_sources, '["s1","' || CASE WHEN p_partkey % 4 = 0 THEN 'Museus de Barcelona' ELSE 'Articket BCN' END || '"]' AS publishers, '2001-06-02' AS retrieved,
  '{{"schedule":' || (p_partkey % 2 = 1) || ',"price":' || ({show}) || '}}' AS verified, '{{"name":' || to_json(p_brand) || ',"address":' || to_json(p_type) || CASE WHEN {show} THEN ',"neighborhood":"Gràcia"' ELSE '' END || '}}' AS venue,
  CASE WHEN ({shown}) AND NOT ({never}) THEN 'venue' END AS image_source, CASE WHEN p_partkey % 20 = 0 THEN 'merge' ELSE 'new' END AS merge_hint, CASE WHEN {show} AND p_partkey % 2 = 0 THEN p_brand END AS artist, CASE WHEN {m} AND p_partkey % 8 = 2 THEN 'Miró' END AS exhibition, CASE WHEN {m} AND p_partkey % 4 = 1 THEN '10' END AS hours,
  CASE WHEN {m} THEN '2002-06-15T00:00:00.000+02:00' WHEN p_partkey % 2 = 0 THEN '2001-06-21' END AS end_date, CASE WHEN ({shown}) AND NOT ({never}) THEN {url} END AS image, CASE WHEN p_partkey % 2 = 1 THEN '10h' END AS schedule, CASE WHEN p_partkey % 6 = 0 THEN 'true' END AS locked, '20' AS last_audience, NULL::VARCHAR AS too_many,
  {show} AND p_partkey % 2 = 0 AS has_show, {museum} AS has_museum FROM part WHERE {m} OR p_partkey % 7 <> 0"""


def manifest_rows(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumn("slug", _text("p", _key()))
    proposals = p.filter(_key() % 5 == 0).select("slug", F.lit("plans").alias("collection"), F.when(_key() % 2 == 0, "new").otherwise("update").alias("kind"), F.col("p_size").alias("score"))
    return cards.manifest(proposals, p.filter(_key() % 5 == 1).select("slug", F.col("p_type").alias("reason")), "2001-06-15", I.PROMPT_VERSIONS["write"], 1.23456)


def long_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", cards.long_date("o_orderdate").alias("day"), cards.escaped_pipes(_text("a|", F.col("o_orderpriority"))).alias("cell"))


def proximity_pairs(spark: SparkSession, d: str) -> DataFrame:
    return matching.proximity_pairs(table(spark, d, "part").select(_key().alias("ord"), F.col("p_brand").alias("title"), (F.lit(41.3) + (_key() % 50) * F.lit(0.001)).alias("lat"), (F.lit(2.1) + (_key() % 40) * F.lit(0.001)).alias("lng")))


_NEAR_SQL = f"WITH p AS (SELECT p_partkey AS ord, {Q.trigrams('p_brand')} AS g, 41.3::DOUBLE + (p_partkey % 50) * 0.001::DOUBLE AS lat, 2.1::DOUBLE + (p_partkey % 40) * 0.001::DOUBLE AS lng FROM part) SELECT a.ord AS a, b.ord AS b FROM p a JOIN p b ON a.ord < b.ord AND abs(a.lat - b.lat) < 0.0015 AND abs(a.lng - b.lng) < 0.003 WHERE {Q.metres('a', 'b')} <= 150 AND len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g)))::DOUBLE >= 0.82"


def top_per_brand(spark: SparkSession, d: str) -> DataFrame:
    return selection.top_per_group(table(spark, d, "part"), ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")], 2).select("p_brand", F.col("rank").cast("long").alias("rank"), "p_partkey")


def last_orders(spark: SparkSession, d: str) -> DataFrame:
    return readers.last_rows(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


def catalogue_pages(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("s_suppkey")
    return readers.catalogue_urls(table(spark, d, "supplier").select(_text("m", s).alias("slug"), F.when(s % 4 == 0, _text("https://h/", s)).alias("hours_url"), _text("https://o/", s).alias("official_url"), (s % 3 != 0).alias("enabled")), 50)


def last_visits(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select((F.col("o_custkey") % 20).alias("source_id"), F.when(F.col("o_custkey") % 20 < 17, F.col("o_orderdate")).alias("last_seen"))
    return changes.since(rows, F.lit(NOW).cast("timestamp")).select("source_id", F.date_format("since", "yyyy-MM-dd HH:mm").alias("since"))


def card_outcomes(spark: SparkSession, d: str) -> DataFrame:
    some = lambda c: F.when(c, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    rows = table(spark, d, "part").select("p_partkey", (_key() % 11 != 0).alias("job"), some(_key() % 7 == 0).alias("copied"), some(_key() % 5 == 0).alias("missing"), (_key() % 3 == 0).alias("locked"), F.when(_key() % 2 == 0, "digits").alias("parity"))
    return verify.outcome(rows).select("p_partkey", "outcome")


def volatile_hashes(spark: SparkSession, d: str) -> DataFrame:
    slots = F.array(F.struct(F.lit("Lun").alias("days"), _text(F.col("p_size").cast("string"), "H").alias("hours")), F.struct(F.lit("Dom").alias("days"), F.lit("10").alias("hours")))
    rows = table(spark, d, "part").withColumn("price", V.parse_price(_text((F.col("p_size") + 1).cast("string"), " €")))
    return rows.select("p_partkey", I.change_hash(slots, F.col("price"), F.array(F.lit("Gratis domingos"), F.lit("A")), F.when(_key() % 2 == 0, "Miró"), F.lit("2001-07-01")).alias("digest"))


_RULES = (("a", False, None, "(?i)/(teatre|doc)", "shows", "plans"), ("b", False, "(?i)/(item|article|p)", None, None, "museums"), ("c", True, None, None, None, "museums"))


def dispatched_urls(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(_RULES, "source_id string, any_url boolean, detail_pattern string, collection_pattern string, matched_collection string, default_collection string")
    urls = table(spark, d, "pages").select("page_id", _pick(("a", "b", "c", "d"), F.col("page_id")).alias("source_id"), F.when(F.col("page_id") % 5 == 0, F.concat("url", F.lit("/a-long-record-name"))).otherwise(F.col("url")).alias("url"))
    return extract.dispatched(urls, rules).select("page_id", "detail", "collection")


def _dispatch_sql() -> str:
    parts = f"list_filter(string_split({Q.path('u')}, '/'), lambda x: x <> '')"
    looks = f"coalesce(NOT regexp_matches(u, '{extract.NEVER_DETAIL}') AND len({parts}) > 0 AND length({parts}[-1]) >= {extract.LEAST_SLUG} AND contains({parts}[-1], '-'), false)"
    return f"""WITH p AS (SELECT page_id, ['a', 'b', 'c', 'd'][page_id % 4 + 1] AS s, CASE WHEN page_id % 5 = 0 THEN url || '/a-long-record-name' ELSE url END AS u FROM pages)
SELECT page_id, CASE s WHEN 'c' THEN true WHEN 'b' THEN regexp_matches(u, '{_RULES[1][2]}') ELSE {looks} END AS detail, CASE s WHEN 'a' THEN CASE WHEN regexp_matches(u, '{_RULES[0][3]}') THEN 'shows' ELSE 'plans' END WHEN 'b' THEN 'museums' WHEN 'c' THEN 'museums' END AS collection FROM p"""


QUERIES = {
    "dispatched_urls": (dispatched_urls, _dispatch_sql()),
    "bounded_material": (bounded_material, _material_sql()),
    "screening_texts": (screening_texts, _SCREEN_SQL),
    "decision_log": (decision_log, _LOG_SQL),
    "collected_jobs": (collected_jobs, "SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 3 THEN c_name END AS slug, CASE WHEN o_orderkey % 5 >= 3 OR c_name IS NULL THEN 'no-job' WHEN o_orderkey % 7 = 0 THEN 'unreadable' ELSE 'card' END AS outcome FROM orders LEFT JOIN customer ON c_custkey = o_custkey"),
    "missing_verdicts": (missing_verdicts, "SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 4 = 0)"),
    "batch_states": (batch_states, f"WITH {_STATES} FROM states"),
    "requeued_items": (requeued_items, f"WITH {_STATES} SELECT l_orderkey AS batch_id, l_linenumber FROM lineitem JOIN states ON batch_id = l_orderkey WHERE state = 'expired'"),
    "stream_replayed": (stream_replayed, "SELECT DISTINCT event_type || '-' || user_id AS custom_id FROM events"),
    "requested_sources": (requested_sources, "SELECT s_suppkey FROM supplier WHERE s_suppkey % 4 IN (1, 2)"),
    "crawl_totals": (crawl_totals, "SELECT sum(l_linenumber)::BIGINT AS discovered, sum(trunc(l_quantity))::BIGINT AS fetched, sum(l_suppkey % 3)::BIGINT AS not_modified FROM lineitem"),
    "pages_on_day": (pages_on_day, f"SELECT 's' || o_custkey % 20 AS source_id, count(*) FILTER (({N} - to_hours((o_orderkey % 48)::INT))::DATE = {N}::DATE AND o_orderkey % 4 <> 0) AS pages FROM orders GROUP BY 1"),
    "retention_days": (retention_days, f"SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderdate::DATE::TIMESTAMP >= {N} - INTERVAL 1000 DAY"),
    "resolved_images": (resolved_images, _images_sql()),
    "free_admission": (free_admission, _FREE_SQL),
    "structured_update": (structured_update, "SELECT p_partkey AS slug, CASE WHEN f THEN p_retailprice + 1 ELSE p_retailprice END AS price, CASE WHEN f THEN 'h' || p_partkey % 5 ELSE 'old' END AS schedule, CASE WHEN f THEN 'now' ELSE 'then' END AS curated_at, p_name AS why, CASE WHEN f THEN 'h' || p_partkey % 5 WHEN m THEN 'old' END AS hours, CASE WHEN f THEN 'diumenge' WHEN m THEN 'none' END AS free, CASE WHEN m THEN 30 END AS minutes FROM (SELECT *, p_partkey % 3 = 0 AS f, p_partkey % 5 <> 0 AS m FROM part)"),
    "assembled_cards": (assembled_cards, _cards_sql()),
    "manifest_rows": (manifest_rows, f"SELECT '2001-06-15' AS date, '{I.PROMPT_VERSIONS['write']}' AS prompt_version, 1.23::DOUBLE AS run_cost_eur, CASE p_partkey % 5 WHEN 0 THEN 'proposed' ELSE 'discarded' END AS state, 'p' || p_partkey AS slug, CASE p_partkey % 5 WHEN 0 THEN 'plans' END AS collection, CASE WHEN p_partkey % 5 = 0 THEN CASE p_partkey % 2 WHEN 0 THEN 'new' ELSE 'update' END END AS kind, CASE p_partkey % 5 WHEN 0 THEN p_size::BIGINT END AS score, CASE p_partkey % 5 WHEN 1 THEN p_type END AS reason FROM part WHERE p_partkey % 5 < 2"),
    "long_dates": (long_dates, f"SELECT o_orderkey, day(o_orderdate) || ' de ' || {list(cards.MONTHS_ES)}[month(o_orderdate)] || ' de ' || year(o_orderdate) AS day, replace('a|' || o_orderpriority, '|', '\\|') AS cell FROM orders"),
    "proximity_pairs": (proximity_pairs, _NEAR_SQL),
    "top_per_brand": (top_per_brand, "SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank, p_partkey FROM part QUALIFY rank <= 2"),
    "last_orders": (last_orders, "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"),
    "catalogue_pages": (catalogue_pages, "SELECT 'm' || s_suppkey AS slug, CASE WHEN s_suppkey % 4 = 0 THEN 'https://h/' || s_suppkey ELSE 'https://o/' || s_suppkey END AS loc FROM supplier WHERE s_suppkey % 3 <> 0 ORDER BY slug LIMIT 50"),
    "last_visits": (last_visits, f"SELECT o_custkey % 20 AS source_id, strftime(coalesce(max(CASE WHEN o_custkey % 20 < 17 THEN o_orderdate END), {N} - INTERVAL 30 DAY), '%Y-%m-%d %H:%M') AS since FROM orders GROUP BY 1"),
    "card_outcomes": (card_outcomes, "SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'no-job' WHEN p_partkey % 7 = 0 THEN 'copied' WHEN p_partkey % 5 = 0 THEN 'discarded' WHEN p_partkey % 3 = 0 THEN 'locked' WHEN p_partkey % 2 = 0 THEN 'needs-human' ELSE 'written' END AS outcome FROM part"),
    "volatile_hashes": (volatile_hashes, """SELECT p_partkey, sha256('{"h":["dom@10","lun@' || p_size || 'h"],"p":"paid:' || (p_size + 1) || '","f":["a","gratis domingos"],"e":"' || CASE WHEN p_partkey % 2 = 0 THEN 'miro|2001-07-01' ELSE '' END || '"}') AS digest FROM part"""),
}
