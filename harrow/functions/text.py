"""Text folding, n-grams, similarity and clipping as Column builders. All but exact_fold stay in the JVM; what uses let() is interpreted there,
as higher-order functions are, so where an expression is used often, a column of its own is the better way."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _folds() -> tuple[str, str]:
    """Lower-case letters of the Latin blocks that decompose into a plain letter and marks, and those plain letters."""
    pairs = [(c, unicodedata.normalize("NFD", c)[0]) for c in map(chr, range(0xC0, 0x250)) if c == c.lower() and len(unicodedata.normalize("NFD", c)) > 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _folds()
#: White space as the folding sees it: with the no-break space.
SPACES = r"[\s ]+"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(x: Column, use) -> Column:
    """use(x) with x computed once: where an expression stands in a lambda or in many branches, Spark would compute it again and again."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def fold(x: Column | str) -> Column:
    """Lower case without accents; null gives the empty string."""
    return F.regexp_replace(F.translate(F.lower(F.coalesce(col(x), F.lit(""))), ACCENTED, PLAIN), r"[̀-ͯ]", "")


def norm(x: Column | str) -> Column:
    """fold() with runs of white space as one space, and none at the ends."""
    return F.trim(F.regexp_replace(fold(x), SPACES, " "))


def exact_fold(x: Column | str) -> Column:
    """norm() for all scripts, by full canonical decomposition; it costs a round trip to Python."""

    def one(t: str | None) -> str:
        kept = "".join(c for c in unicodedata.normalize("NFD", (t or "").lower()) if not "\u0300" <= c <= "\u036f")
        return " ".join(kept.split())

    @F.pandas_udf("string")
    def folded(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return folded(col(x))


def title_key(x: Column | str) -> Column:
    """The first 40 letters and digits of a folded title."""
    return F.substring(F.regexp_replace(fold(x), "[^a-z0-9]", ""), 1, 40)


def words(x: Column | str) -> Column:
    return F.filter(F.split(norm(x), " "), lambda w: w != "")


def word_count(x: Column | str) -> Column:
    return F.size(words(x))


def trigrams(x: Column | str) -> Column:
    """Distinct character trigrams of the folded text without spaces; a shorter text is its own only one."""
    def grams(t: Column) -> Column:
        found = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - 2, F.lit(1))), lambda i: F.substring(t, i, F.lit(3))))
        return F.when(t == "", F.array().cast("array<string>")).otherwise(found)

    return let(F.replace(norm(x), F.lit(" "), F.lit("")), grams)


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two sets given as arrays; 1 if both are empty."""
    together = F.size(F.array_union(a, b))
    return F.when(together == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / together)


def title_similarity(a: Column | str, b: Column | str) -> Column:
    return jaccard(trigrams(a), trigrams(b))


def word_ngrams(x: Column | str, n: int) -> Column:
    """Distinct runs of n words."""
    def grams(w: Column) -> Column:
        found = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) < n, F.array().cast("array<string>")).otherwise(F.array_distinct(found))

    return let(words(x), grams)


def shared_ngrams(generated: Column | str, source: Column | str, n: int = 8) -> Column:
    return F.array_intersect(word_ngrams(generated, n), word_ngrams(source, n))


def is_literal_part(fragment: Column | str, material: Column | str) -> Column:
    """Whether the folded fragment stands in the folded material; an empty one doesn't."""
    f = norm(fragment)
    return (f != "") & F.contains(norm(material), f)


def clip(x: Column | str, most: int) -> Column:
    """At most `most` characters, cut at the last space if that leaves over 60 %, and an ellipsis."""
    x = col(x)
    cut = F.substring(x, 1, most)
    space = F.length(cut) - F.locate(" ", F.reverse(cut))  # characters before the last space
    at_word = (F.locate(" ", cut) > 0) & (space > most * 0.6)
    short = F.when(at_word, F.substring(cut, F.lit(1), space)).otherwise(cut)
    return F.when(F.length(x) <= most, x).otherwise(F.concat(F.regexp_replace(short, SPACES + "$", ""), F.lit("…")))


def strip_html(x: Column | str) -> Column:
    """Text without scripts, styles, tags and six entities, white space collapsed."""
    x = F.coalesce(col(x), F.lit(""))
    for tag in ("script", "style"):
        x = F.regexp_replace(x, rf"(?is)<{tag}.*?</{tag}>", " ")
    x = F.regexp_replace(x, "<[^>]+>", " ")
    for name, plain in (("&nbsp;", " "), ("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">")):
        x = F.replace(x, F.lit(name), F.lit(plain))
    return F.trim(F.regexp_replace(x, SPACES, " "))


def number_text(x: Column) -> Column:
    """A number as the published texts write it: 15, not 15.0."""
    return F.regexp_replace(x.cast("string"), r"\.0$", "")


def fixed(x: Column, places: int) -> Column:
    """A number with so many decimals, without grouping."""
    return F.call_function("format_number", x, F.lit("0." + "0" * places))


def half_up(x: Column, places: int = 0) -> Column:
    """Rounds halves towards plus infinity."""
    scale = float(10**places)
    return F.floor(x * scale + 0.5) / scale if places else F.floor(x + 0.5)
