"""Building blocks of the SQL that checks the queries: the same folding, extraction and synthetic records, written for another engine."""

from __future__ import annotations

from harrow.functions.text import ACCENTED, PLAIN

NOW = "2001-06-15 12:00:00"


def fold(x: str) -> str:
    return f"regexp_replace(translate(lower(coalesce({x}, '')), '{ACCENTED}', '{PLAIN}'), '[\\x{{0300}}-\\x{{036f}}]', '', 'g')"


def norm(x: str) -> str:
    return f"trim(regexp_replace({fold(x)}, '[\\s\\x{{00a0}}]+', ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split({norm(x)}, ' '), lambda w: w <> '')"


def trigrams(x: str) -> str:
    t = f"replace({norm(x)}, ' ', '')"
    return f"list_distinct(list_transform(range(1, greatest(length({t}) - 2, 1) + 1), lambda i: substring({t}, i, 3)))"


def ngrams(x: str, n: int) -> str:
    w = words(x)
    return f"list_distinct(list_transform(range(1, greatest(len({w}) - {n - 2}, 1)), lambda i: array_to_string(list_slice({w}, i, i + {n - 1}), ' ')))"


def strip_html(x: str) -> str:
    out = f"regexp_replace(regexp_replace(regexp_replace(coalesce({x}, ''), '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g')"
    for name, plain in (("&nbsp;", " "), ("&amp;", "&"), ("&quot;", '"'), ("&#39;", "''"), ("&lt;", "<"), ("&gt;", ">")):
        out = f"replace({out}, '{name}', '{plain}')"
    return f"trim(regexp_replace({out}, '[\\s\\x{{00a0}}]+', ' ', 'g'))"


def tag(x: str, name: str) -> str:
    return strip_html(f"regexp_extract({x}, '(?is)<{name}[^>]*>(.*?)</{name}>', 1)")


def main_text(x: str) -> str:
    bare = x
    for name in ("script", "style", "nav", "header", "footer", "aside", "form", "noscript"):
        bare = f"regexp_replace({bare}, '(?is)<{name}[ >].*?</{name}>', ' ', 'g')"
    return strip_html(f"(SELECT coalesce(nullif(regexp_extract(b, '(?is)<article[^>]*>(.*?)</article>', 1), ''), nullif(regexp_extract(b, '(?is)<main[^>]*>(.*?)</main>', 1), ''), nullif(regexp_extract(b, '(?is)<body[^>]*>(.*?)</body>', 1), ''), b) FROM (SELECT {bare} AS b))")


def host(x: str) -> str:
    return f"lower(regexp_extract({x}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1))"


def path(x: str) -> str:
    return f"regexp_extract({x}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


def canonical(x: str) -> str:
    return f"regexp_replace({host(x)}, '^www\\.', '') || regexp_replace({path(x)}, '/+$', '')"


def clip(x: str, most: int) -> str:
    cut = f"left({x}, {most})"
    space = f"({most} - instr(reverse({cut}), ' '))"
    return f"CASE WHEN length({x}) <= {most} THEN {x} ELSE regexp_replace(CASE WHEN contains({cut}, ' ') AND {space} > {most * 0.6} THEN left({x}, {space}) ELSE {cut} END, '[\\s\\x{{00a0}}]+$', '') || '…' END"


def half_up(x: str, places: int = 0) -> str:
    return f"(floor(({x}) * {10.0**places} + 0.5) / {10.0**places})" if places else f"floor(({x}) + 0.5)"


def metres(a: str, b: str) -> str:
    return f"2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lng - {a}.lng) / 2), 2))))"


#: Candidates out of the star schema: one for each part, supplier and month of shipping.
CANDIDATES = """
candidates AS (
  SELECT l_partkey * 1000000 + l_suppkey * 1000 + (year(m) - 1990) * 12 + month(m) AS ord, 's' || (l_suppkey % 20) AS source_id,
    CASE l_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS tier, (l_suppkey % 11) / 10.0::DOUBLE AS trust,
    'https://s' || (l_suppkey % 20) || '.example.org/' || CASE WHEN l_partkey % 50 = 0 THEN 'promo/' ELSE '' END || l_partkey AS url,
    CASE l_partkey % 3 WHEN 0 THEN 'plans' WHEN 1 THEN 'shows' ELSE 'museums' END AS collection, p_name || ' ' || p_brand || ' ' || l_partkey AS title,
    repeat(p_type || ' ' || p_name || '. ', (l_suppkey % 15 + 1)::INTEGER) AS description, m AS start_at, CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE m + INTERVAL 20 DAY END AS end_at,
    41.15::DOUBLE + (l_partkey % 300) * 0.0015::DOUBLE + (l_suppkey % 3) * 0.0005::DOUBLE AS lat, 1.95::DOUBLE + ((l_partkey * 7) % 350) * 0.001::DOUBLE AS lng, n
  FROM (SELECT l_partkey, l_suppkey, date_trunc('month', l_shipdate)::TIMESTAMP AS m, count(*) AS n FROM lineitem GROUP BY ALL) JOIN part ON p_partkey = l_partkey)
"""
