"""Publishing collections: vetoed and expired cards go, a gate on invalid ones, ordered parts with a digest each, and one over those."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harrow.sources.shared import shared_folder

#: The share of invalid cards above which a collection is held back.
MOST_INVALID = 0.2
#: Cards of a part, on average.
PART_CARDS = 1000


def publishable(cards: DataFrame, vetoed: DataFrame, now: Column) -> DataFrame:
    """cards (slug, ends_at, …) that are neither vetoed nor over."""
    return cards.join(vetoed.select("slug"), "slug", "left_anti").filter(F.col("ends_at").isNull() | (F.col("ends_at") >= now))


def gate(valid: DataFrame, invalid: DataFrame) -> DataFrame:
    """Per collection: valid and invalid cards, and whether it is held back."""
    both = valid.select("collection", F.lit(1).alias("v"), F.lit(0).alias("i")).unionByName(invalid.select("collection", F.lit(0).alias("v"), F.lit(1).alias("i")))
    sums = both.groupBy("collection").agg(F.sum("v").alias("valid"), F.sum("i").alias("invalid"))
    return sums.withColumn("held_back", F.col("invalid") / (F.col("valid") + F.col("invalid")) > MOST_INVALID)


def envelopes(cards: DataFrame, fields: list[str], licence: str) -> DataFrame:
    """Per collection one JSON document of its cards in slug order, with count, bytes and digest. One row holds a collection, as one small file does; parts() is for all others."""
    items = F.transform(F.array_sort(F.collect_list(F.struct("slug", F.struct(*fields).alias("card")))), lambda x: x["card"])
    rows = cards.groupBy("collection").agg(F.count("*").alias("count"), items.alias("items"))
    body = F.to_json(F.struct("collection", "count", F.lit(licence).alias("licence"), "items"))
    return rows.select("collection", "count", body.alias("body"), F.sha2(body, 256).alias("sha256"), F.octet_length(body).alias("bytes"))


def placed(cards: DataFrame, part_cards: int = PART_CARDS) -> DataFrame:
    """cards (collection, slug, …) with the part of each, as parts() cuts them. Rows are shuffled twice and written, so long columns are better joined afterwards."""
    spark = cards.sparkSession
    ranges, path = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{shared_folder(spark)}/cards"
    rows = cards.repartitionByRange(ranges, "collection", "slug").withColumn("_range", F.spark_partition_id())
    rows.write.parquet(path)
    begins = F.when(F.conv(F.substring(F.md5("slug"), 1, 8), 16, 10).cast("long") % part_cards == 0, F.col("slug"))
    inside = Window.partitionBy("collection", "_range").orderBy("slug").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("collection").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    dealt = spark.read.schema(rows.schema).parquet(path).withColumn("_part", F.last(begins, ignorenulls=True).over(inside))
    ahead = dealt.groupBy("collection", "_range").agg(F.max("_part").alias("_last")).withColumn("_before", F.last("_last", ignorenulls=True).over(before))
    same = F.col("d.collection").eqNullSafe(F.col("a.collection")) & (F.col("d._range") == F.col("a._range"))
    return dealt.alias("d").join(ahead.alias("a"), same).select(*[f"d.{c}" for c in cards.columns], F.coalesce("_part", "_before", F.lit("")).alias("part"))


def bodies(cards: DataFrame, fields: list[str], licence: str) -> DataFrame:
    """(collection, part, count, body, sha256, bytes) of cards (collection, part, slug, fields), which are shuffled once."""
    items = F.transform(F.array_sort(F.collect_list(F.struct("slug", F.struct(*fields).alias("card")))), lambda x: x["card"])
    whole = cards.groupBy("collection", "part").agg(F.count("*").alias("count"), items.alias("items"))
    body = F.to_json(F.struct("collection", "part", "count", F.lit(licence).alias("licence"), "items"))
    texts = whole.select("collection", "part", "count", body.alias("body"))
    return texts.select("*", F.sha2("body", 256).alias("sha256"), F.octet_length("body").cast("long").alias("bytes"))


def parts(cards: DataFrame, fields: list[str], licence: str, part_cards: int = PART_CARDS) -> DataFrame:
    """(collection, part, count, body, sha256, bytes): each collection as JSON documents of about part_cards cards in slug order.

    A slug begins a part if its digest is divisible by part_cards, and names it (the first part is named ''), so a card that comes or goes changes
    one part, or splits or joins two; all others keep name, body and digest. Parts in order of their names make up the collection. Slugs alone are dealt by
    ranges of collection and slug, and each range learns in which part it begins, so no task or row holds a collection. Cards of one slug, which should
    be one, share a part, in the order of their fields. Null is a collection, and a slug, like others.
    """
    where = placed(cards.select("collection", "slug").distinct(), part_cards)
    same = F.col("c.collection").eqNullSafe(F.col("w.collection")) & F.col("c.slug").eqNullSafe(F.col("w.slug"))
    return bodies(cards.alias("c").join(where.alias("w"), same).select("c.*", "w.part"), fields, licence)


def index(published: DataFrame) -> DataFrame:
    """(collection, parts, count, bytes, sha256): each collection of parts(); its digest is that over its parts' digests in order, one a line.
    Only names and digests are gathered, a hundred bytes for each part."""
    order = F.transform(F.array_sort(F.collect_list(F.struct("part", "sha256"))), lambda x: x["sha256"])
    return published.groupBy("collection").agg(F.count("*").alias("parts"), F.sum("count").alias("count"), F.sum("bytes").alias("bytes"), F.sha2(F.array_join(order, "\n"), 256).alias("sha256"))


def changed_parts(old: DataFrame, new: DataFrame) -> DataFrame:
    """(collection, part, change): the parts by whose digests two builds differ: added, removed or changed."""
    o, n = old.select("collection", "part", "sha256").alias("o"), new.select("collection", "part", "sha256").alias("n")
    both = o.join(n, F.col("o.collection").eqNullSafe(F.col("n.collection")) & (F.col("o.part") == F.col("n.part")), "full_outer")
    change = F.when(F.col("o.sha256").isNull(), "added").when(F.col("n.sha256").isNull(), "removed").when(F.col("o.sha256") != F.col("n.sha256"), "changed")
    here = F.col("n.sha256").isNotNull()
    return both.select(F.when(here, F.col("n.collection")).otherwise(F.col("o.collection")).alias("collection"), F.coalesce("o.part", "n.part").alias("part"), change.alias("change")).filter("change IS NOT NULL")


def verified(files: DataFrame) -> DataFrame:
    """files (body, sha256) with whether the digest fits."""
    return files.withColumn("intact", F.sha2("body", 256) == F.col("sha256"))


def slug_conflicts(cards: DataFrame) -> DataFrame:
    """Slugs in more than one collection."""
    return cards.groupBy("slug").agg(F.count_distinct("collection").alias("collections")).filter("collections > 1")
