"""JSON out of text that may wrap it: as it is, out of a fence, or the first balanced object or array."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A fence stands on lines of its own.
FENCE = r"(?s)^\s*```(?:json)?\s*\n(.*?)\n\s*```\s*$"


def first_balanced(text: str | None) -> str | None:
    """The first object or array that closes, strings and escapes honoured; None if none does."""
    if not text:
        return None
    start = min((i for i in (text.find("{"), text.find("[")) if i >= 0), default=-1)
    if start < 0:
        return None
    open_, inside, skip = [], False, False
    for i in range(start, len(text)):
        c = text[i]
        if skip:
            skip = False
        elif inside:
            skip, inside = c == "\\", c != '"'
        elif c == '"':
            inside = True
        elif c in "{[":
            open_.append("}" if c == "{" else "]")
        elif c in "}]":
            if not open_ or open_.pop() != c:
                return None
            if not open_:
                return text[start : i + 1]
    return None


def parse(x: Column) -> Column:
    """struct(json, via): the JSON text and the way that gave it (direct, fence, balanced, failed). Only texts that the first two ways leave reach Python."""
    valid = lambda t: F.try_parse_json(t).isNotNull() & t.rlike(r"^\s*[\[{]")
    fenced = F.regexp_extract(x, FENCE, 1)
    direct, fence = F.coalesce(valid(x), F.lit(False)), F.coalesce(valid(fenced), F.lit(False))

    @F.pandas_udf("string")
    def balanced(texts: pd.Series) -> pd.Series:
        return texts.map(first_balanced)

    found = balanced(F.when(direct | fence, F.lit(None)).otherwise(x))
    ok = F.coalesce(valid(found), F.lit(False))
    via = F.when(direct, "direct").when(fence, "fence").when(ok, "balanced").otherwise("failed")
    return F.struct(F.when(direct, F.trim(x)).when(fence, fenced).when(ok, found).alias("json"), via.alias("via"))
