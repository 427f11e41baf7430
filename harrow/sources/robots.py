"""Robots rules: bodies to one row a rule, and the longest rule that fits each address."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.functions.identity import host

#: Hours for which a body counts, and the status that makes it count.
FRESH_HOURS, FOUND = 24, 200
#: Characters of a rule's fixed beginning by which it meets addresses, and parts over which a host's addresses are dealt.
KEY_CHARS, SALTS = 12, 32
RULES = "host string, agent string, kind string, pattern string, seconds double"


def agent_name(name: str) -> str:
    """A crawler's name without version, in lower case."""
    return name.split("/", 1)[0].strip().lower()


def parsed(body: str) -> Iterator[tuple[str, str, str | None, float | None]]:
    """(agent, kind, pattern, seconds) of each line of a body for each crawler it is for: agent (the crawler is named), allow, disallow, delay.

    Names in lines that follow each other share the rules up to the next name. A rule without a pattern forbids nothing."""
    agents: list[str] = []
    naming = False
    for line in re.split(r"\r\n|\r|\n", body):
        name, colon, value = line.split("#", 1)[0].partition(":")
        name, value = name.strip().lower(), value.strip()
        if not colon:
            continue
        if name == "user-agent":
            agents = agents if naming else []
            if value:
                agents.append(agent_name(value))
                yield agents[-1], "agent", None, None
        elif name in ("allow", "disallow") and value:
            yield from ((a, name, value, None) for a in agents)
        elif name == "crawl-delay" and re.fullmatch(r"\d+(\.\d+)?|\.\d+", value):
            yield from ((a, "delay", None, float(value)) for a in agents)
        naming = name == "user-agent"


def fresh(bodies: DataFrame, now: datetime) -> DataFrame:
    """The bodies (host, body, status, fetched_at) read less than 24 hours before now; of a host's several the last, then the first by text."""
    live = bodies.filter(F.col("fetched_at") > F.lit(now).cast("timestamp") - F.make_interval(hours=F.lit(FRESH_HOURS)))
    best = F.max_by(F.struct("body", "status", "fetched_at"), F.struct("fetched_at", F.hash("body"), "body", "status")).alias("b")
    return live.groupBy(F.lower("host").alias("host")).agg(best).select("host", "b.*")


def to_read(pages: DataFrame, bodies: DataFrame, now: datetime) -> DataFrame:
    """The hosts of pages (url) whose body has to be read (again)."""
    return pages.select(F.lower(host("url")).alias("host")).filter("host <> ''").distinct().join(fresh(bodies, now).select("host"), "host", "left_anti")


def rules(bodies: DataFrame, now: datetime) -> DataFrame:
    """One row for each line of the fresh bodies with status 200, for each crawler: host, agent, kind, pattern, seconds. Nothing of other bodies: they forbid nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(h, *r) for h, body in zip(*(c.to_pylist() for c in batch.columns), strict=True) for r in parsed(body)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate([pa.string()] * 4 + [pa.float64()])], ["host", "agent", "kind", "pattern", "seconds"])

    return fresh(bodies, now).filter((F.col("status") == FOUND) & F.col("body").isNotNull()).select("host", "body").mapInArrow(run, RULES)


def own_rules(all_rules: DataFrame, agent: str) -> DataFrame:
    """The rules that hold for a crawler: where a host names it those for it, elsewhere those for *."""
    mine = all_rules.filter(F.col("agent") == agent_name(agent))
    return mine.unionByName(all_rules.filter("agent = '*'").join(mine.select("host").distinct(), "host", "left_anti"))


def delays(all_rules: DataFrame, agent: str) -> DataFrame:
    """(host, ms): the pause that a host asks a crawler for; of several the longest."""
    return own_rules(all_rules, agent).filter("kind = 'delay'").groupBy("host").agg(F.round(F.max("seconds") * 1000).cast("long").alias("ms"))


def wanted(url: Column) -> Column:
    """What rules look at: path and query of an address."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))


def as_regex(pattern: Column) -> Column:
    """A rule as a regular expression: * stands for anything, $ at the end for the end."""
    bare = F.regexp_replace(pattern, r"\$$", "")
    quoted = F.replace(F.regexp_replace(bare, r"([\\.+?^${}()|\[\]])", r"\\$1"), F.lit("*"), F.lit(".*"))
    return F.concat(F.lit("(?s)^"), quoted, F.when(F.endswith(pattern, F.lit("$")), "$").otherwise(""))


def judged(pages: DataFrame, all_rules: DataFrame, agent: str) -> DataFrame:
    """pages (url and other columns) with `allowed` and the `rule` that says so (null if none fits): the longest one, of equally long ones an allowing one.

    Rules and addresses meet by host and the first KEY_CHARS characters of what a rule begins with up to its first * or $: an address has as many
    beginnings. A host's addresses are dealt over SALTS parts and its rules sent to each, so a hot host is no hot key. Repeated pages are judged each;
    an address without a host is allowed.
    """
    at = pages.select(F.lower(host("url")).alias("_host"), wanted(F.col("url")).alias("_path")).filter("_host <> ''").distinct()
    keys = at.withColumns({"_salt": F.pmod(F.xxhash64("_host", "_path"), F.lit(SALTS)).cast("int"), "_key": F.explode(F.transform(F.sequence(F.lit(0), F.least(F.length("_path"), F.lit(KEY_CHARS))), lambda n: F.substring("_path", F.lit(1), n)))})
    own = own_rules(all_rules, agent).filter("kind IN ('allow', 'disallow')").select("host", F.col("pattern").alias("rule"), (F.col("kind") == "allow").alias("_allow")).distinct()
    own = own.withColumn("_fixed", F.substring(F.regexp_extract("rule", r"^([^*$]*)", 1), 1, KEY_CHARS)).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = keys.join(own, (F.col("_host") == F.col("host")) & (F.col("_key") == F.col("_fixed")) & (F.col("_salt") == F.col("_part")) & F.rlike("_path", as_regex(F.col("rule"))))
    best = met.groupBy("_host", "_path").agg(F.max(F.struct(F.length("rule").alias("n"), F.col("_allow").alias("allow"), F.col("rule").alias("rule"))).alias("_best"))
    joined = pages.withColumns({"_h": F.lower(host("url")), "_p": wanted(F.col("url"))}).join(best, (F.col("_h") == F.col("_host")) & (F.col("_p") == F.col("_path")), "left")
    return joined.select(*pages.columns, F.coalesce("_best.allow", F.lit(True)).alias("allowed"), F.col("_best.rule").alias("rule"))

