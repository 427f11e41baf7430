"""Readers for JSON, line-delimited JSON, sitemaps and feeds, card folders, logs by month, and keyed tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harrow.functions.identity import is_valid_slug, path, without_fragment

#: Sub-sitemaps read of one index, and which of them are taxonomies rather than content.
MOST_SUBMAPS = 8


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document per file; corrupt ones give a row of nulls that is dropped."""
    rows = spark.read.schema(schema).json(path, multiLine=True, mode="PERMISSIVE")
    return rows.filter(F.exists(F.array(*[F.col(c).isNotNull() for c in rows.columns]), lambda x: x))


def ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Line-delimited JSON; blank and bad lines are skipped."""
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED")


def cards(spark: SparkSession, folder: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) cards of a folder of collection=…/slug.json files; invalid ones have their broken rules, three at most."""
    rows = spark.read.schema(schema).option("basePath", folder).json(f"{folder}/collection=*/*.json", multiLine=True, mode="PERMISSIVE")
    file = F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")
    rules = {"no slug": F.col("slug").isNull(), "bad slug": ~is_valid_slug("slug"), "slug differs from file": F.col("slug") != file, "no title": F.coalesce(F.col("title"), F.lit("")) == ""}
    return validated(rows.withColumn("file", file), rules)


def validated(rows: DataFrame, rules: dict[str, Column], most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Splits rows by whether they break any of the rules (name -> broken)."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    marked = rows.withColumn("problems", F.slice(broken, 1, most))
    return marked.filter(F.size("problems") == 0).drop("problems"), marked.filter(F.size("problems") > 0)


def month_log(spark: SparkSession, folder: str, schema: str, month: str) -> DataFrame:
    """One month of a log partitioned by month=YYYY-MM; only that partition is read."""
    return spark.read.schema(f"{schema}, month string").parquet(folder).filter(F.col("month") == month)


def last_rows(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key: how an appended table is read as a map."""
    w = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


#: What is read of sitemaps, sitemap indexes, RSS and Atom. An element's text is _VALUE where it may have attributes too.
_ENTRY, _LINK, _BROKEN = "struct<loc: struct<_VALUE: string>, lastmod: string>", "array<struct<_VALUE: string, _href: string>>", "_broken"
_ITEM = f"array<struct<link: {_LINK}, pubDate: string>>"
XML = f"url array<{_ENTRY}>, sitemap array<{_ENTRY}>, channel struct<item: {_ITEM}>, item {_ITEM}, entry array<struct<link: {_LINK}, updated: string>>, {_BROKEN} string"


def parsed_xml(documents: DataFrame) -> DataFrame:
    """documents with their column xml parsed as `doc`: null for null, empty and broken documents. Spark's own parser reads them, with namespaces left
    out, entities and CDATA resolved; a document is broken if its XML ends early or isn't any, and then none of it counts."""
    doc = F.from_xml("xml", XML, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN, "ignoreNamespace": "true", "rowTag": "ROW"})
    return documents.withColumn("doc", F.when(F.trim("xml") != "", doc)).withColumn("doc", F.when(F.col(f"doc.{_BROKEN}").isNull(), F.col("doc")))


def broken_documents(documents: DataFrame) -> DataFrame:
    """The documents, without their text, that have text and can't be parsed: what a run reports instead of reading on."""
    return parsed_xml(documents.filter(F.trim("xml") != "")).filter("doc IS NULL").drop("xml", "doc")


def sitemap_urls(documents: DataFrame) -> DataFrame:
    """documents (source_id, xml) to (source_id, kind, loc, lastmod): entries of url sets (page) and of sitemap indexes (map). Broken documents give nothing."""
    entry = lambda field, kind: F.transform(F.coalesce(F.col(f"doc.{field}"), F.array()), lambda x: F.struct(F.lit(kind).alias("kind"), F.trim(x["loc"]["_VALUE"]).alias("loc"), F.trim(x["lastmod"]).alias("lastmod")))
    rows = parsed_xml(documents).select("source_id", F.inline(F.concat(entry("sitemap", "map"), entry("url", "page"))))
    return rows.filter("loc <> ''")


def feed_urls(documents: DataFrame) -> DataFrame:
    """documents (source_id, xml) of RSS and Atom to (source_id, loc, lastmod): an item's link, an entry's first one by its address. Broken documents give nothing."""
    first = lambda x, part: F.trim(F.get(x["link"], F.lit(0))[part]).alias("loc")
    items = lambda field: F.transform(F.coalesce(F.col(field), F.array()), lambda x: F.struct(first(x, "_VALUE"), F.trim(x["pubDate"]).alias("lastmod")))
    atom = F.transform(F.coalesce(F.col("doc.entry"), F.array()), lambda x: F.struct(first(x, "_href"), F.trim(x["updated"]).alias("lastmod")))
    return parsed_xml(documents).select("source_id", F.inline(F.concat(items("doc.channel.item"), items("doc.item"), atom))).filter("loc <> ''")


def choose_submaps(maps: DataFrame, wanted: Column, most: int = MOST_SUBMAPS) -> DataFrame:
    """Per source_id the newest of the wanted sub-sitemaps (loc, lastmod); of all of them where none is wanted. Those without a date come last."""
    some = F.max(wanted.cast("int")).over(Window.partitionBy("source_id"))
    kept = maps.withColumn("_w", wanted).withColumn("_some", some).filter("_w OR _some = 0")
    rank = F.row_number().over(Window.partitionBy("source_id").orderBy(F.desc_nulls_last(F.try_to_timestamp("lastmod")), "loc"))
    return kept.withColumn("rank", rank).filter(F.col("rank") <= most).drop("_w", "_some")


def discovered(urls: DataFrame, since: datetime | None, path_includes: list[str], most: int) -> DataFrame:
    """urls (source_id, loc, lastmod, ord): changed since then (unknown dates pass), with one of the path parts, one per address without fragment, `most` per source in order."""
    fresh = F.lit(True) if since is None else F.coalesce(F.try_to_timestamp("lastmod") >= F.lit(since), F.lit(True))
    named = F.exists(F.array(*[F.lit(p) for p in path_includes]), lambda p: F.contains(F.col("loc"), p)) if path_includes else F.lit(True)
    own = urls.filter(fresh & named).withColumn("loc", without_fragment("loc"))
    first = F.row_number().over(Window.partitionBy("source_id", "loc").orderBy("ord"))
    place = F.row_number().over(Window.partitionBy("source_id").orderBy("ord"))
    return own.withColumn("_n", first).filter("_n = 1").withColumn("_n", place).filter(F.col("_n") <= most).drop("_n")


def catalogue_urls(catalogue: DataFrame, most: int) -> DataFrame:
    """The page to read of each enabled entry (slug, hours_url, official_url, enabled)."""
    return catalogue.filter("enabled").select("slug", F.coalesce("hours_url", "official_url").alias("loc")).orderBy("slug").limit(most)


def allowed(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """pages (host, url) that no robots rule (host, prefix) forbids."""
    return pages.alias("p").join(rules.alias("r"), (F.col("p.host") == F.col("r.host")) & F.startswith(path(F.col("p.url")), F.col("r.prefix")), "left_anti")


def fetch_outcome(status: Column) -> Column:
    """What a status means for a crawl."""
    return (
        F.when(status == 304, "unchanged").when(status.between(200, 299), "ok").when(status.isin(404, 410), "gone").when(status == 429, "slow-down").when(status.isin(401, 403), "blocked").when(status.between(500, 599), "retry").otherwise("failed")
    )
