"""Records out of web pages: linked data, page heads, chosen elements, main text, and the merge of what each level found."""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harrow.functions.identity import canonical_url, host, segments, without_fragment
from harrow.functions.text import strip_html
from harrow.sources.schemas import EXTRACT

#: Node types taken from linked data, elements left out of the main text.
NODE_TYPES = ("event", "museum", "touristattraction", "place", "landmarksorhistoricalbuildings", "exhibition", "theater", "musicvenue", "artgallery", "localbusiness", "product")
SKIPPED = ("script", "style", "nav", "header", "footer", "aside", "form", "noscript")
FIELDS = ("title", "description", "start_date", "end_date", "venue_name", "address", "price_text")
LEVELS = ("jsonld", "opengraph", "selectors")


def tag_text(html: Column, tag: str) -> Column:
    return strip_html(F.regexp_extract(html, rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1))


def main_text(html: Column) -> Column:
    """Text of the first article or main element, else of the body, without what surrounds content."""
    bare = html
    for tag in SKIPPED:
        bare = F.regexp_replace(bare, rf"(?is)<{tag}[ >].*?</{tag}>", " ")
    inner = F.coalesce(*[F.nullif(F.regexp_extract(bare, rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1), F.lit("")) for tag in ("article", "main", "body")], bare)
    return strip_html(inner)


def meta(html: Column, name: str) -> Column:
    """A meta tag's content by property, else by name; null if there is none."""
    one = lambda attr: F.nullif(F.regexp_extract(html, rf"(?is)<meta[^>]*{attr}=[\"']{name}[\"'][^>]*content=[\"']([^\"']*)", 1), F.lit(""))
    return F.coalesce(one("property"), one("name"))


def head(pages: DataFrame) -> DataFrame:
    """(page_id, level, title, description, image) from the page's head; pages with neither title nor description give nothing."""
    html = F.col("html")
    title = F.coalesce(meta(html, "og:title"), F.nullif(tag_text(html, "title"), F.lit("")))
    description = F.coalesce(meta(html, "og:description"), meta(html, "description"))
    rows = pages.select("page_id", F.lit("opengraph").alias("level"), title.alias("title"), description.alias("description"), meta(html, "og:image").alias("image"))
    return rows.filter("title IS NOT NULL OR description IS NOT NULL")


def elements(pages: DataFrame, title: str = "h1") -> DataFrame:
    """(page_id, level, title, body_text) from chosen elements; pages with neither give nothing."""
    html = F.col("html")
    rows = pages.select("page_id", F.lit("selectors").alias("level"), F.nullif(tag_text(html, title), F.lit("")).alias("title"), F.nullif(main_text(html), F.lit("")).alias("body_text"))
    return rows.filter("title IS NOT NULL OR body_text IS NOT NULL")


class _Scripts(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.found: list[str] = []
        self.inside = False

    def handle_starttag(self, tag, attrs):
        self.inside = tag == "script" and (dict(attrs).get("type") or "").lower() == "application/ld+json"
        if self.inside:
            self.found.append("")

    def handle_data(self, data):
        if self.inside:
            self.found[-1] += data

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "script"


def _nodes(data, depth: int = 0) -> Iterator[dict]:
    if depth > 6:
        return
    for x in data if isinstance(data, list) else [data]:
        if isinstance(x, list):
            yield from _nodes(x, depth + 1)
        elif isinstance(x, dict):
            yield x
            if "@graph" in x:
                yield from _nodes(x["@graph"], depth + 1)


def _text(x) -> str | None:
    """A string out of what linked data allows: strings, numbers, lists, and objects with a name, value or text."""
    if isinstance(x, list):
        x = x[0] if x else None
    if isinstance(x, dict):
        x = next((x[k] for k in ("name", "@value", "text") if k in x), None)
    if isinstance(x, bool) or not isinstance(x, str | int | float):
        return None
    return str(x).strip() or None


def _link(x) -> str | None:
    for y in x if isinstance(x, list) else [x]:
        y = (y.get("url") or y.get("contentUrl") or y.get("@id")) if isinstance(y, dict) else y
        if isinstance(y, str) and y.startswith(("http://", "https://")):
            return y
    return None


def _float(x) -> float | None:
    try:
        return float(str(x).replace(",", "."))
    except ValueError:
        return None


def _price(offers) -> str | None:
    found = []
    for o in offers if isinstance(offers, list) else [offers]:
        if isinstance(o, dict):
            low, high, one = (_text(o.get(k)) for k in ("lowPrice", "highPrice", "price"))
            unit = _text(o.get("priceCurrency")) or "EUR"
            found += [f"{low} - {high} {unit}"] if low and high else [f"{one or low} {unit}"] if one or low else []
    return " · ".join(found) or None


def _record(page_id: int, node: dict) -> dict:
    place = node.get("location") if isinstance(node.get("location"), dict) else node
    address, geo = place.get("address"), place.get("geo") if isinstance(place.get("geo"), dict) else {}
    if isinstance(address, dict):
        address = ", ".join(filter(None, (_text(address.get(k)) for k in ("streetAddress", "postalCode", "addressLocality"))))
    hours = node.get("openingHours")
    return {
        "page_id": page_id, "level": "jsonld", "title": _text(node.get("name")), "description": _text(node.get("description")), "start_date": _text(node.get("startDate")), "end_date": _text(node.get("endDate")),
        "venue_name": _text(place.get("name")), "address": _text(address), "lat": _float(geo.get("latitude")), "lng": _float(geo.get("longitude")), "price_text": _price(node.get("offers")),
        "schedule_lines": [t for t in map(_text, hours if isinstance(hours, list) else [hours]) if t] or None, "official_url": _link(node.get("url")), "image": _link(node.get("image")),
    }


def linked_data(pages: DataFrame) -> DataFrame:
    """EXTRACT rows of level jsonld: one per linked-data node of a wanted type. Scripts that aren't JSON are skipped; null html gives nothing."""
    kinds = {"page_id": pa.int64(), "lat": pa.float64(), "lng": pa.float64(), "schedule_lines": pa.list_(pa.string())}
    schema = pa.schema([(name, kinds.get(name, pa.string())) for name in (f.split()[0] for f in EXTRACT.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if html and "ld+json" in html:
                    parser = _Scripts()
                    parser.feed(html)
                    for script in parser.found:
                        try:
                            data = json.loads(script)
                        except ValueError:
                            continue
                        for node in _nodes(data):
                            kinds = node.get("@type")
                            if any(str(k).lower().endswith(NODE_TYPES) for k in (kinds if isinstance(kinds, list) else [kinds])):
                                out.append(_record(page_id, node))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    return pages.select(F.col("page_id").cast("long"), "html").mapInArrow(run, EXTRACT)


def merged(extracts: DataFrame) -> DataFrame:
    """One row per page_id: of each field the first that isn't blank, levels in the order of LEVELS, then by value."""
    place = F.array_position(F.array(*[F.lit(x) for x in LEVELS]), F.col("level"))
    fields = [c for c in extracts.columns if c not in ("page_id", "level")]
    texts = {f.name for f in extracts.schema if f.dataType.simpleString() == "string"}
    value = lambda c: F.when(F.trim(c) != "", F.col(c)) if c in texts else F.col(c)
    best = [F.min_by(value(c), F.when(value(c).isNotNull(), F.struct(place, F.col(c).cast("string")))).alias(c) for c in fields]
    return extracts.groupBy("page_id").agg(*best, F.array_sort(F.collect_set("level")).alias("levels"))


def all_levels(pages: DataFrame) -> DataFrame:
    """Linked data, head and elements of the pages together, each with all EXTRACT columns."""
    out = linked_data(pages)
    for rows in (head(pages), elements(pages)):
        out = out.unionByName(rows, allowMissingColumns=True)
    return out


def empty_rate(row_fields: list[Column]) -> Column:
    """The share of fields that are null or empty."""
    empty = [F.when(f.isNull() | (f.cast("string") == ""), 1).otherwise(0) for f in row_fields]
    return sum(empty[1:], empty[0]) / float(len(empty))


def is_detail(url: Column, listings: tuple[str, ...] = ("tag", "category", "page", "search", "agenda")) -> Column:
    """Whether an address looks like one record's page: at least two path parts, none of them a listing's."""
    s = segments(url)
    return (F.size(s) >= 2) & ~F.arrays_overlap(s, F.array(*[F.lit(x) for x in listings]))


#: Path parts that no record's page has, and the least length of its last part.
NEVER_DETAIL, LEAST_SLUG = r"(?i)/(tag|tags|categoria|category|author|autor|page|pagina|search|buscar|feed|wp-json|wp-admin|amp)/", 8


def looks_like_detail(url: Column) -> Column:
    """Whether an address looks like one record's page by its last path part: long, with a hyphen, below no listing."""
    last = F.element_at(segments(url), -1)
    return F.coalesce(~url.rlike(NEVER_DETAIL) & (F.size(segments(url)) > 0) & (F.length(last) >= LEAST_SLUG) & F.contains(last, F.lit("-")), F.lit(False))


def dispatched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls (source_id, url) with detail and collection by their source's rule (source_id, any_url, detail_pattern, collection_pattern,
    matched_collection, default_collection): any address, those that fit a pattern, or else those that look like a detail page; the matched
    collection if its pattern fits, else the default. Sources without a rule have no collection."""
    joined = urls.join(rules, "source_id", "left")
    detail = F.when(F.coalesce("any_url", F.lit(False)), True).when(F.col("detail_pattern").isNotNull(), F.rlike("url", F.col("detail_pattern"))).otherwise(looks_like_detail(F.col("url")))
    kind = F.when(F.coalesce(F.rlike("url", F.col("collection_pattern")), F.lit(False)), F.col("matched_collection")).otherwise(F.col("default_collection"))
    return joined.select(*urls.columns, detail.alias("detail"), kind.alias("collection"))


def one_per_address(pages: DataFrame) -> DataFrame:
    """The page with the smallest page_id of each address without fragment."""
    w = Window.partitionBy(without_fragment("url")).orderBy("page_id")
    return pages.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def host_summary(pages: DataFrame) -> DataFrame:
    """Per host: pages, distinct canonical addresses, detail pages, mean length of the main text, and mean empty rate of title, heading and text."""
    url, html = F.col("url"), F.col("html")
    title, heading, text = tag_text(html, "title"), tag_text(html, "h1"), main_text(html)
    rows = one_per_address(pages).select(host(url).alias("host"), canonical_url(url).alias("address"), is_detail(url).alias("detail"), F.length(text).alias("chars"), empty_rate([title, heading, text]).alias("empty"))
    return rows.groupBy("host").agg(
        F.count("*").alias("n_pages"), F.count_distinct("address").alias("n_addresses"), F.count_if("detail").alias("n_details"), F.round(F.avg("chars"), 4).alias("mean_chars"), F.round(F.avg("empty"), 6).alias("mean_empty")
    )
