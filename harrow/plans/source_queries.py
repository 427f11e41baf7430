"""Queries over what sources publish: fields by selectors, robots rules, XML documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.functions import identity as I
from harrow.operators import selectors
from harrow.plans import sql as Q
from harrow.plans.tables import NOW, table
from harrow.sources import robots
from harrow.sources.keyed import KeyedTable
from harrow.sources.shared import shared_folder


def selected_fields(spark: SparkSession, d: str) -> DataFrame:
    """The pages by selectors of their host: a third of the hosts have none of their own, the others one of two maps."""
    pages = table(spark, d, "pages").select("page_id", I.host("url").alias("source_id"), "html")
    kind = F.length("source_id") % 3
    hosts = pages.select("source_id").distinct()
    first = selectors.map_of(title="title", body="div.ad", schedule="nav li", officialUrl="nav a")
    second = selectors.map_of(title="article > h1", body="html body > article", price=".ad", description="meta[charset] + title", ticketsUrl="ul > li + li > a", venue="h2")
    maps = hosts.filter(kind == 1).withColumn("fields", first).unionByName(hosts.filter(kind == 2).withColumn("fields", second))
    rows = selectors.by_selectors(pages, maps)
    return rows.select("page_id", "title", "description", F.sha2("body_text", 256).alias("body_digest"), "price_text", F.array_join("schedule_lines", "|").alias("lines"), "venue_name", "official_url", "tickets_url")


def _inner(tag: str) -> str:
    """Text of the first element of a tag, tags taken out and entities decoded once, then as the library strips texts."""
    inner = f"regexp_replace(regexp_extract(html, '(?s)<{tag}>(.*?)</{tag.split()[0]}>', 1), '<[^>]+>', '', 'g')"
    for entity, plain in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("amp", "&")):
        inner = f"replace({inner}, '&{entity};', '{plain}')"
    return f"nullif({Q.strip_html(inner)}, '')"


_LINES = "array_to_string(list_slice(list_filter(list_transform(regexp_extract_all(html, '<li>(.*?)</li>', 1), lambda x: trim(regexp_replace(x, '<[^>]+>', '', 'g'))), lambda x: x <> ''), 1, 20), '|')"
SELECTED_SQL = f"""
WITH p AS (SELECT page_id, html, length({Q.host('url')}) % 3 AS k FROM pages WHERE html IS NOT NULL),
f AS (SELECT page_id, k, html, CASE k WHEN 1 THEN {_inner('title')} ELSE {_inner('h1')} END AS title, CASE k WHEN 1 THEN {_inner('div class="ad"')} ELSE {_inner('article')} END AS body FROM p)
SELECT page_id, title, CASE k WHEN 2 THEN {_inner('title')} END AS description, sha256(body) AS body_digest, CASE k WHEN 2 THEN {_inner('div class="ad"')} END AS price_text,
  CASE k WHEN 1 THEN nullif({_LINES}, '') END AS lines, NULL::VARCHAR AS venue_name, CASE k WHEN 1 THEN nullif(regexp_extract(html, '<a href="([^"]*)"', 1), '') END AS official_url,
  CASE k WHEN 2 THEN nullif(regexp_extract(html, '</li><li><a href="([^"]*)"', 1), '') END AS tickets_url
FROM f WHERE title IS NOT NULL OR body IS NOT NULL"""

#: What hosts say, by the length of their name.
BODIES = (
    "User-agent: *\nDisallow: /fr/\nAllow: /fr/8*\nDisallow: /*?page=  # listings\n",
    "user-agent: other\nDisallow: /\n\nUser-Agent: Harrow/2.0\nUser-agent: x\nDisallow: /*.html$\nDisallow: /en/\nAllow: /en/\nCrawl-delay: 1.5\n\nUser-agent: *\nDisallow: /\n",
    "User-agent: *\nDisallow: /de\nDisallow:\nAllow: /de/1\nAllow: /$\n",
    "User-agent: *\nDisallow: /\n",
)


def robots_judged(spark: SparkSession, d: str) -> DataFrame:
    """The pages by what their hosts' bodies say; of those that forbid all, some are missing, some too old."""
    pages = table(spark, d, "pages").select("page_id", "url")
    hosts = pages.select(F.lower(I.host("url")).alias("host")).distinct()
    kind, seven = F.length("host") % 4, F.ascii("host") % 3
    age = F.when((kind == 3) & (seven == 1), 24).otherwise(23)
    bodies = hosts.select("host", F.get(F.array(*[F.lit(b) for b in BODIES]), kind).alias("body"), F.when((kind == 3) & (seven == 0), 404).otherwise(200).alias("status"), (F.lit(NOW).cast("timestamp") - F.make_interval(hours=age)).alias("fetched_at"))
    rows = robots.judged(pages, robots.rules(bodies, NOW), "Harrow/3.1")
    return rows.select("page_id", "allowed", "rule")


ROBOTS_SQL = f"""
WITH p AS (SELECT page_id, lower({Q.host('url')}) AS h, CASE WHEN starts_with(r, '/') THEN r ELSE '/' || r END AS w FROM (SELECT page_id, url, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1) AS r FROM pages)),
r AS (SELECT page_id, CASE length(h) % 4
  WHEN 0 THEN CASE WHEN contains(w, '?page=') THEN '/*?page=' WHEN starts_with(w, '/fr/8') THEN '/fr/8*' WHEN starts_with(w, '/fr/') THEN '/fr/' END
  WHEN 1 THEN CASE WHEN ends_with(w, '.html') THEN '/*.html$' WHEN starts_with(w, '/en/') THEN '/en/' END
  WHEN 2 THEN CASE WHEN starts_with(w, '/de/1') THEN '/de/1' WHEN starts_with(w, '/de') THEN '/de' WHEN w = '/' THEN '/$' END
  ELSE CASE WHEN ascii(h) % 3 = 2 THEN '/' END END AS rule FROM p WHERE h <> '')
SELECT page_id, coalesce(rule IN ('/fr/8*', '/en/', '/de/1', '/$'), true) AS allowed, rule FROM p LEFT JOIN r USING (page_id)"""

def cached_states(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's last event as a keyed table keeps it: written by weeks, those whose last event is an error taken out before the last write; looked up with two hours of life."""
    events = table(spark, d, "events").select("user_id", "event_id", "event_type", "value", F.col("ts").alias("first_seen"), F.col("ts").alias("seen"))
    cache = KeyedTable(spark, shared_folder(spark), events.schema, ("user_id",), 16).create()
    for week in range(4):
        cache.upsert(events.filter(F.least(F.floor((F.dayofyear("seen") - 1) / 7), F.lit(3)) == week), "seen", ("first_seen",))
        if week == 2:
            cache.delete(cache.current().filter("event_type = 'error'"))
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return cache.lookup(customers, "seen", 2, F.lit("2024-01-30 23:00:00").cast("timestamp"))


CACHED_SQL = """
WITH e AS (SELECT *, least((dayofyear(ts) - 1) // 7, 3) AS w FROM events),
l AS (SELECT user_id, w, arg_max(event_id, ts) AS event_id, max(ts) AS ts FROM e GROUP BY ALL),
k AS (SELECT user_id, arg_max(event_id, w) FILTER (w < 3) AS third, min(ts) AS first, min(ts) FILTER (w = 3) AS fourth, arg_max(event_id, w) AS event_id FROM l GROUP BY user_id),
t AS (SELECT k.user_id, k.event_id, e.event_type, e.value, CASE WHEN g.event_type = 'error' THEN k.fourth ELSE k.first END AS first_seen, e.ts AS seen
  FROM k JOIN events e ON e.event_id = k.event_id LEFT JOIN events g ON g.event_id = k.third
  WHERE (g.event_type IS DISTINCT FROM 'error' OR k.fourth IS NOT NULL) AND e.ts > TIMESTAMP '2024-01-30 21:00:00')
SELECT c_custkey AS user_id, event_id, event_type, value, first_seen, seen, event_id IS NOT NULL AS hit FROM customer LEFT JOIN t ON t.user_id = c_custkey"""

QUERIES = {
    "cached_states": (cached_states, CACHED_SQL),
    "robots_judged": (robots_judged, ROBOTS_SQL),
    "selected_fields": (selected_fields, SELECTED_SQL),
}
