"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model over their votes, and a linear classifier trained on its posteriors.

1. Terms (hashed words and word beginnings) that mark toxic documents are counted on a bounded sample of labelled rows.
   All documents are dealt over parts by their ids; a part hears the terms that the other parts' labels have shown, so no
   row is judged by its own label.
2. Voters: seed words by kind, disguised seeds (digits for letters, stretched letters), found words, found beginnings by
   their length, and surface patterns. Each says toxic, clean or nothing.
3. The label model fits, by expectation maximisation over the counts of all vote patterns in the corpus, how each voter
   votes on toxic and on clean documents. Voters that agree beyond what the label explains share their weight.
4. A logistic regression on hashed words, beginnings and letter n-grams is trained on the posteriors of the sample's
   vote patterns, and scores every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, powers, shared_dir, string_bytes, stretches, tidied, word_hashes, written

#: The most labelled rows that terms and the classifier are fitted on, and the parts they are dealt to.
SAMPLE_ROWS, PARTS = 16_384, 4
#: Word lists: fixed values.
INSULTS = ("asshole", "bastard", "bitch", "clown", "jerk", "loser")
CONTEMPT = ("disgusting", "dumb", "fool", "idiot", "imbecile", "moron", "pathetic", "stupid", "ugly", "worthless")
DEHUMAN = ("scum", "trash", "vermin")
SEEDS = INSULTS + CONTEMPT + DEHUMAN
PRONOUNS = ("you", "your", "youre", "yours", "du", "dein", "ihr", "tu", "toi", "vous", "votre", "usted", "tú", "ustedes")
#: Characters that stand for letters in disguised words, and the signs that stand for an oath.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
SIGNS = "#$%&*@!"
STARTS, GRAM = (4, 5, 6, 7, 8), 5
WHOLE, GRAMS = 0, 1
TOXIC, CLEAN, NOTHING = 0, 1, 2
_POWERS = powers(np.uint64(0xD6E8FEB86659FD93), 64)
_REPEATS = re.compile(r"(.)\1+")
_TABLE = 0x20000  # code points above are no letters


@cache
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whether a code point is a letter, whether a capital, its lower case)."""
    chars = [chr(i) for i in range(_TABLE)]
    return np.array([c.isalpha() for c in chars]), np.array([c.isupper() for c in chars]), np.array([ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(chars)], np.uint32)


@dataclass(frozen=True)
class Words:
    """The words (runs of letters, in lower case) of some texts: code points as they are and in lower case, the texts' bounds, each word's place and text."""

    plain: np.ndarray
    codes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    @property
    def n(self) -> int:
        return len(self.bounds) - 1


def _runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of true within bounds."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[bounds] = True
    before, after = np.append(False, inside[:-1]), np.append(inside[1:], False)
    return np.flatnonzero(inside & (~before | edge[:-1])), np.flatnonzero(inside & (~after | edge[1:])) + 1


def words_in(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of texts given as UTF-8 bytes and their offsets."""
    letter, _, lower = _letters()
    plain = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    bounds = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets]
    plain = np.minimum(plain, np.uint32(_TABLE - 1))
    codes = lower[plain]
    starts, ends = _runs(letter[plain], bounds)
    return Words(plain, codes, bounds, starts, ends, np.searchsorted(bounds, starts, "right") - 1)


def _sums(codes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of the k code points from each place of at."""
    with np.errstate(over="ignore"):
        total = np.full(len(at), 1000 + k, np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # not the hash of a whole word
        for j in range(k):
            total += (codes[at + j].astype(np.uint64) + np.uint64(1)) * _POWERS[j]
        return mix(total)


def terms(words: Words, grams: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, word numbers, hashes) of whole words, of beginnings (kind: their length), and if asked for of the runs of GRAM letters inside words."""
    lengths = words.ends - words.starts
    yield WHOLE, np.arange(len(lengths)), word_hashes(words.codes, words.starts, words.ends)
    for k in STARTS:
        long = np.flatnonzero(lengths >= k)
        yield k, long, _sums(words.codes, words.starts[long], k)
    if grams:
        counts = np.maximum(lengths - GRAM, 0)  # but the word's beginning
        number = np.repeat(np.arange(len(lengths)), counts)
        at = words.starts[number] + 1 + np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)
        yield GRAMS, number, ~_sums(words.codes, at, GRAM)


def hashes_of(names: tuple[str, ...], kind: int = WHOLE) -> np.ndarray:
    """The hashes, ascending, that terms() gives to these words as whole words or, by their own length, as beginnings."""
    if not names:
        return np.zeros(0, np.uint64)
    data = "".join(names).encode()
    offsets = np.append(0, np.cumsum([len(x.encode()) for x in names]))
    words = words_in(np.frombuffer(data, np.uint8), offsets)
    return np.unique(word_hashes(words.codes, words.starts, words.ends) if kind == WHOLE else _sums(words.codes, words.starts, kind))


class Lookup:
    """Finds hashes in a fixed set: a table of bits passes most others over."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys.astype(np.uint64))
        self.mask = np.uint64((1 << 20) - 1)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.keys & self.mask] = True

    def __reduce__(self):
        return Lookup, (self.keys,)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the hashes that are keys, numbers of those keys)."""
        maybe = np.flatnonzero(self.bits[hashes & self.mask])
        number = np.searchsorted(self.keys, hashes[maybe]).clip(0, max(0, len(self.keys) - 1))
        hit = self.keys[number] == hashes[maybe] if len(self.keys) else np.zeros(len(maybe), bool)
        return maybe[hit], number[hit]


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Voters:
    """The voters; found: (part, kind, hash) of the terms that the part hears."""

    SEEDED = ("insult", "contempt", "dehuman", "starts", "leet", "stretched", "addressed", "repeated")
    SURFACE = ("dense", "shout", "runs", "exclaim", "signs", "none", "blank")

    def __init__(self, found: list[tuple[int, int, int]]):
        self.found = Lookup(np.array([h for _, _, h in found], np.uint64))
        self.lexicons = np.zeros((len(self.found.keys), PARTS), bool)
        self.lexicons[np.searchsorted(self.found.keys, np.array([h for _, _, h in found], np.uint64)), [p for p, _, _ in found]] = True
        self.names = (*self.SEEDED, *(f"found{k}" for k in (WHOLE, *STARTS)), *self.SURFACE)
        self.kinds = [Lookup(hashes_of(x)) for x in (INSULTS, CONTEMPT, DEHUMAN)]
        self.seeds, self.pronouns = Lookup(hashes_of(SEEDS)), Lookup(hashes_of(PRONOUNS))
        self.starts = Lookup(hashes_of(tuple(s for s in SEEDS if len(s) >= 5), 5))
        self.squeezed = {_REPEATS.sub(r"\1", s) for s in SEEDS}
        #: How far a voter is trusted at first: P(toxic vote | toxic), P(toxic vote | clean).
        self.trust = np.array([(0.2, 0.1) if n in self.SURFACE[:5] else (0.6, 0.02) for n in self.names])

    def votes(self, words: Words, part: np.ndarray) -> np.ndarray:
        """(texts, voters): what each voter says of each text. part: the part that each text is in."""
        out = np.full((words.n, len(self.names)), NOTHING, np.int8)
        column = {n: j for j, n in enumerate(self.names)}
        marks = np.zeros(len(words.starts), bool)

        def say(name: str, numbers: np.ndarray) -> None:
            out[words.rows[numbers], column[name]] = TOXIC

        hashes = {}
        for kind, numbers, values in terms(words, False):
            hashes[kind] = values
            hit, number = self.found.find(values)
            at = numbers[hit]
            at = at[self.lexicons[number, part[words.rows[at]]]]
            say(f"found{kind}", at)
            marks[at] = True
            if kind == 5:
                say("starts", numbers[self.starts.find(values)[0]])
        for name, lookup in zip(self.SEEDED, self.kinds, strict=False):
            say(name, lookup.find(hashes[WHOLE])[0])
        seeds, pronouns = self.seeds.find(hashes[WHOLE])[0], self.pronouns.find(hashes[WHOLE])[0]
        marks[seeds] = True
        spoken = np.zeros(len(words.starts) + 1, np.int64)
        spoken[pronouns + 1] = 1
        spoken = np.cumsum(spoken)
        first = np.searchsorted(words.rows, np.arange(words.n))
        say("addressed", seeds[spoken[seeds] > spoken[np.maximum(seeds - 3, first[words.rows[seeds]])]])
        out[np.bincount(words.rows[seeds], minlength=words.n) > 1, column["repeated"]] = TOXIC
        self._disguised(words, out, column)
        said, spelled = np.bincount(words.rows[marks], minlength=words.n), np.bincount(words.rows, minlength=words.n)
        out[(said > 2) & (50 * said > spelled), column["dense"]] = TOXIC
        letter, upper, _ = _letters()
        row = lambda at: np.searchsorted(words.bounds, at, "right") - 1
        letters = np.bincount(words.rows, words.ends - words.starts, words.n)
        capitals = np.bincount(row(np.flatnonzero(upper[words.plain])), minlength=words.n)
        out[(letters > 20) & (capitals > 0.6 * letters), column["shout"]] = TOXIC
        c = words.plain
        for name, width, inside in (("runs", 4, letter[c] & np.append(False, c[1:] == c[:-1])), ("exclaim", 3, c == ord("!")), ("signs", 4, np.isin(c, [ord(s) for s in SIGNS]))):
            a, b = _runs(inside, words.bounds)
            out[row(a[b - a >= (width - 1 if name == "runs" else width)]), column[name]] = TOXIC
        out[said == 0, column["none"]] = CLEAN
        out[letters == 0, column["blank"]] = CLEAN
        return out

    def _disguised(self, words: Words, out: np.ndarray, column: dict[str, int]) -> None:
        letter, _, _ = _letters()
        codes, stands = words.codes.copy(), np.zeros(len(words.codes), bool)
        for sign, for_ in LEET.items():
            at = words.codes == ord(sign)
            stands |= at
            codes[at] = ord(for_)
        a, b = _runs(letter[words.plain] | stands, words.bounds)
        if len(a):
            some = np.add.reduceat(np.append(stands, False).astype(np.int64), np.stack([a, b], 1).ravel())[::2]
            a, b = a[(some > 0) & (some < b - a)], b[(some > 0) & (some < b - a)]
            if len(a):
                hit = self.seeds.find(word_hashes(codes, a, b))[0]
                out[np.searchsorted(words.bounds, a[hit], "right") - 1, column["leet"]] = TOXIC
        c = words.codes
        triple = np.flatnonzero((c[2:] == c[1:-1]) & (c[1:-1] == c[:-2]) & letter[words.plain[2:]])
        for k in np.unique(np.searchsorted(words.starts, triple, "right") - 1):
            if words.ends[k] - words.starts[k] <= 64 and _REPEATS.sub(r"\1", "".join(map(chr, c[words.starts[k] : words.ends[k]]))) in self.squeezed:
                out[words.rows[k], column["stretched"]] = TOXIC


def cover(rows: list[list[int]], clean: np.ndarray, least: int = 2) -> list[int]:
    """Terms that explain the toxic rows (term numbers): time and again the one in most rows that none explains yet, discounted by its
    clean rows. What merely stands beside a mark, as in copies of one text, explains no further row and is left out."""
    n = len(clean)
    holders: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(rows):
        for k in row:
            holders[k].append(i)
    left = np.array([len(h) for h in holders], float)
    total = np.maximum(left, 1)
    open_rows, chosen = np.ones(len(rows), bool), []
    while n and (worth := left * total / (total + 4 * clean)).max() >= least:
        best = int(worth.argmax())
        chosen.append(best)
        for i in holders[best]:
            if open_rows[i]:
                open_rows[i] = False
                left[rows[i]] -= 1
    return chosen


@dataclass(frozen=True)
class LabelModel:
    """P(vote | label) of each voter, the prior, and how correlated two voters' votes are beyond what the label explains.

    A voter that says nothing is no evidence. Those that speak share their weight with the speaking ones that they correlate with.
    """

    tables: np.ndarray  # (voters, labels, votes)
    prior: float
    correlation: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(toxic) of each vote pattern."""
        if not len(patterns):
            return np.zeros(0)
        logs = np.log(self.tables)
        j = np.arange(patterns.shape[1])
        spoken = patterns != NOTHING
        weights = spoken / (1 + spoken @ self.correlation)
        odds = np.log(self.prior / (1 - self.prior)) + ((logs[j, 1, patterns] - logs[j, 0, patterns]) * weights).sum(1)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, trust: np.ndarray | None = None, rounds: int = 25, prior: float = 0.1) -> LabelModel:
    """Expectation maximisation over vote patterns (patterns, voters) and how often each occurs; it starts from trust in the voters.

    The prior is never above a half: voters speak for the rarer label.
    """
    n = patterns.shape[1]
    trust = np.tile((0.6, 0.02), (n, 1)) if trust is None else trust
    tables = np.stack([np.stack([1.0 * trust[:, y], (1 - trust[:, y]) * (0.25, 0.41)[y], (1 - trust[:, y]) * (0.75, 0.59)[y]], 1) for y in (1, 0)], 1)
    model = LabelModel(tables, prior, np.zeros((n, n)))
    if not len(patterns):
        return model
    signs = np.array([1.0, -1.0, 0.0])[patterns]
    for k in range(rounds):
        toxic = model.posterior(patterns)
        by_label = np.stack([(1 - toxic) * counts, toxic * counts])
        tables = np.stack([[[by_label[y][patterns[:, j] == v].sum() + (1 if v != NOTHING else 2) for v in range(3)] for y in range(2)] for j in range(n)])
        tables /= tables.sum(2, keepdims=True)
        residue = np.zeros((n, n))
        for y in range(2):
            w = by_label[y]
            centred = signs - (signs * w[:, None]).sum(0) / max(w.sum(), 1e-9)
            residue += (centred * w[:, None]).T @ centred
        spread = np.sqrt(np.maximum(np.diag(residue), 1e-9))
        # Before the labels have settled, what they will explain still looks like correlation.
        correlation = np.clip(residue / spread / spread[:, None], 0, 1) if 2 * k >= rounds else np.zeros((n, n))
        np.fill_diagonal(correlation, 0)
        model = LabelModel(tables, float(np.clip(by_label[1].sum() / counts.sum(), 1e-3, 0.5)), correlation)
    return model


def fit_linear(rows: list[np.ndarray], targets: np.ndarray, n: int, rounds: int = 2000, rate: float = 0.1, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights of n features and a bias: logistic regression on soft targets, rows given as feature numbers."""
    weights, bias = np.zeros(n), -2.0
    if not len(rows):
        return weights, bias
    at = np.concatenate([np.asarray(r, np.int64) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    importance = np.where(targets > 0.5, 0.5 / max(targets.mean(), 0.01), 1.0)
    for t in range(1, rounds + 1):
        z = bias + np.bincount(row, weights[at], len(rows))
        error = (1 / (1 + np.exp(-z)) - targets) * importance / len(rows)
        grad = np.append(np.bincount(at, error[row], n) + decay * weights, error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        weights, bias = weights - step[:-1], bias - step[-1]
    return weights, float(bias)


def distinct(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, value), rows ascending."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


class Classifier:
    """A logistic regression on the features (hashed terms) of texts: their weights and a bias."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.features, self.bias = Lookup(features), bias
        self.weights = np.asarray(weights, float)[np.argsort(features.astype(np.uint64), kind="stable")]

    def active(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The distinct (text, feature number) of the features that texts have."""
        rows, numbers = [], []
        for _, at, hashes in terms(words, True):
            hit, number = self.features.find(hashes)
            rows.append(words.rows[at[hit]])
            numbers.append(number)
        return distinct(np.concatenate(rows), np.concatenate(numbers))


def texts_in(column: pa.Array) -> Iterator[tuple[np.ndarray, Words]]:
    """(row numbers, words) of the texts of a column in pieces of bounded size; a text longer than that comes in several, parted between words."""
    data, offsets = string_bytes(column)
    for rows, own, bounds in stretches(data, offsets):
        yield rows, words_in(own, bounds)


def votes_of(column: pa.Array, voters: Voters, part: np.ndarray) -> np.ndarray:
    """(rows, voters): the votes on each text of a column (part: as in Voters.votes). Of a text in several pieces, one toxic vote is enough, and a clean one needs all."""
    out = np.full((len(column), len(voters.names)), -1, np.int8)
    for rows, words in texts_in(column):
        new = voters.votes(words, part[rows])
        old = out[rows]
        both = np.where((old == TOXIC) | (new == TOXIC), TOXIC, np.where(old == new, new, NOTHING)).astype(np.int8)
        out[rows] = np.where(old == -1, new, both)
    return out


def active_of(column: pa.Array, classifier: Classifier) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, feature number) of a column of texts."""
    found = [(rows[at], numbers) for rows, words in texts_in(column) for at, numbers in [classifier.active(words)]]
    return distinct(*(np.concatenate(x) for x in zip(*found, strict=True))) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


@dataclass(frozen=True)
class ToxicityModel:
    classifier: Classifier
    voters: Voters
    labels: LabelModel

    def scores(self, column: pa.Array) -> np.ndarray:
        """P(toxic) of each text of a column; a text without a feature, such as the empty one, gets what the bias alone says."""
        rows, numbers = active_of(column, self.classifier)
        z = self.classifier.bias + np.bincount(rows, self.classifier.weights[numbers], len(column))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def score(self, text: str) -> float:
        return float(self.scores(pa.array([text], pa.string()))[0])


def _distinct_terms(column: pa.Array, grams: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (row, hash) of the terms of a column of texts, and their kinds."""
    found = [(rows[words.rows[at]], hashes, np.full(len(at), kind)) for rows, words in texts_in(column) for kind, at, hashes in terms(words, grams)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows, hashes, kinds = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((hashes, rows))
    rows, hashes, kinds = rows[order], hashes[order], kinds[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new], kinds[new]


def _gain(toxic: Column, clean: Column, share: float) -> Column:
    """By how much counts are likelier for a mark than for any word."""
    total = toxic + clean
    return toxic * F.log((toxic + 1e-9) / total / share) + clean * F.log((clean + 0.001) / total / (1 - share + 0.001))


def _marks(chosen: DataFrame, folder: str, share: float) -> list[tuple[int, int, int]]:
    """(part, kind, hash) of the terms that mark the sample's toxic rows outside that part."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hashes, kinds = _distinct_terms(batch.column(0), False)
            group = (batch.column(2).to_numpy() * 2 + batch.column(1).to_numpy())[rows]
            keys, first, number = np.unique(hashes, return_index=True, return_inverse=True)
            sums = [np.bincount(number[group == g], minlength=len(keys)) for g in range(2 * PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(kinds[first].astype(np.int32)), *map(pa.array, sums)], ["hash", "kind", *names])

    names = [f"{y}{p}" for p in range(PARTS) for y in ("clean", "toxic")]
    counted = chosen.select("text", "toxic", "part").mapInArrow(tidied(count), "hash long, kind int, " + ", ".join(f"{x} long" for x in names)).groupBy("hash", "kind").agg(*(F.sum(x).alias(x) for x in names))
    # Of so many terms none of which is a mark, about seven reach the bound on the gain by chance.
    tried = written(counted.filter(" + ".join(f"toxic{p}" for p in range(PARTS)) + " >= 3"), folder, "terms")
    bound = float(np.log(max(tried.count(), 8))) - 2
    out = []
    for p in range(PARTS):
        toxic, clean = (sum((F.col(f"{y}{q}") for q in range(PARTS) if q != p), F.lit(0)) for y in ("toxic", "clean"))
        marks = tried.withColumns({"toxic": toxic, "clean": clean}).filter("toxic >= 3 AND toxic >= 9 * clean").filter(_gain(F.col("toxic"), F.col("clean"), share) >= bound).select("hash", "kind", "clean").collect()
        marks.sort(key=lambda r: r["hash"] % (1 << 64))
        lookup = Lookup(np.array([r["hash"] for r in marks], np.int64).view(np.uint64))

        def marked(batches: Iterator[pa.RecordBatch], lookup=lookup) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, hashes, _ = _distinct_terms(batch.column(0), False)
                at, number = lookup.find(hashes)
                ends = np.append(0, np.cumsum(np.bincount(rows[at], minlength=batch.num_rows))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(number.astype(np.int32)))], ["at"])

        toxic_rows = [r["at"] for r in chosen.filter((F.col("toxic") == 1) & (F.col("part") != p)).select("text").mapInArrow(tidied(marked), "at array<int>").collect()]
        for kind in (WHOLE, *STARTS):
            own = {k: j for j, k in enumerate(k for k, r in enumerate(marks) if r["kind"] == kind)}
            numbers = list(own)
            best = cover([[own[k] for k in row if k in own] for row in toxic_rows], np.array([marks[k]["clean"] for k in numbers], float))
            out += [(p, kind, marks[numbers[j]]["hash"] % (1 << 64)) for j in best]
    return out


def _classifier(chosen: DataFrame, folder: str, voters: Voters, labels: LabelModel) -> Classifier:
    """A classifier on the posteriors that the label model gives to the sample's rows."""

    def posteriors(batch: pa.RecordBatch) -> np.ndarray:
        return labels.posterior(votes_of(batch.column(0), voters, batch.column(1).to_numpy()).astype(np.int64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hashes, _ = _distinct_terms(batch.column(0), True)
            keys, number = np.unique(hashes, return_inverse=True)
            mass = np.bincount(number, posteriors(batch)[rows], len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.bincount(number, minlength=len(keys))), pa.array(mass)], ["hash", "n", "mass"])

    def target(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(posteriors(batch))], ["target"])

    rows = chosen.select("text", "part")
    share = float(np.clip(rows.mapInArrow(tidied(target), "target double").agg(F.avg("target")).first()[0] or 0.5, 1e-3, 0.999))
    counted = rows.mapInArrow(tidied(count), "hash long, n long, mass double").groupBy("hash").agg(F.sum("n").alias("n"), F.sum("mass").alias("mass"))
    tried = written(counted.filter("n >= 3 AND mass >= 2 AND 10 * mass >= 9 * n"), folder, "features")
    bound = float(np.log(max(tried.count(), 8))) - 2
    features = np.array([r["hash"] for r in tried.filter(_gain(F.col("mass"), F.greatest(F.col("n") - F.col("mass"), F.lit(0.0)), share) >= bound).select("hash").orderBy("hash").collect()], np.int64).view(np.uint64)
    blank = Classifier(features, np.zeros(len(features)), 0.0)

    def active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, number = active_of(batch.column(0), blank)
            ends = np.append(0, np.cumsum(np.bincount(at, minlength=batch.num_rows))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(number.astype(np.int32))), pa.array(posteriors(batch))], ["at", "target"])

    taught = rows.mapInArrow(tidied(active), "at array<int>, target double").collect()
    weights, bias = fit_linear([np.array(r["at"], np.int64) for r in taught], np.array([r["target"] for r in taught]), len(features))
    return Classifier(blank.features.keys, weights, bias)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fits on docs (doc_id, text) and labels (doc_id, toxic).

    At most sample_rows labelled documents are read by label: those whose hashed id is smallest. Labels of held-out rows are never read; null ids,
    texts and labels are left out here. Of a document with several labels the largest counts, of several texts of a labelled document the
    smallest. Without labelled rows the seeds alone decide. All documents but held-out ones vote for the label model. What reaches
    the driver is in proportion to sample_rows, but for the distinct vote patterns, whose number the voters bound.
    """
    folder = shared_dir(docs.sparkSession)
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sample = written(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows), folder, "sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    texts = texts.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(PARTS)).cast("int"))
    # The sample has sample_rows rows at most, so it may be broadcast.
    chosen = written(texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.first("part").alias("part"), F.min("text").alias("text")), folder, "chosen")
    share = float(np.clip(sample.agg(F.avg("toxic")).first()[0] or 0.5, 1e-3, 0.999))
    voters = Voters(_marks(chosen, folder, share))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            patterns, n = np.unique(votes_of(batch.column(0), voters, batch.column(1).to_numpy()), axis=0, return_counts=True)
            counts.update(dict(zip(map(tuple, patterns.tolist()), n.tolist(), strict=True)))
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array([list(p) for p in counts], pa.list_(pa.int32())), pa.array(list(counts.values()), pa.int64())], ["pattern", "n"])

    heard = texts.filter(~held_out(F.col("doc_id"))).select("text", "part")
    said = heard.mapInArrow(tidied(vote), "pattern array<int>, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    patterns = np.array([r["pattern"] for r in said], np.int64).reshape(len(said), len(voters.names))
    label_model = fit_label_model(patterns, np.array([r["n"] for r in said], float), voters.trust)
    classifier = _classifier(chosen, folder, voters, label_model)
    if not len(classifier.features.keys):  # nothing was learned: seeds alone
        classifier = Classifier(hashes_of(SEEDS), np.full(len(SEEDS), 4.0), -2.0)
    return ToxicityModel(classifier, voters, label_model)


def score_of(text: Column, model: ToxicityModel) -> Column:
    """The score (0 to 1) of a text column, without a shuffle. Null texts count as empty."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts))

    return scored(F.coalesce(text, F.lit("")))


def score_all(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs, by a model that the rows not held out have taught.

    Each row gets its own score, repeated rows and those of null doc_id (not held out) too; null and empty texts get the bias's. Columns
    other than doc_id and text aren't read.
    """
    rows = docs.select("doc_id", score_of(F.col("text"), fit(docs, labels, sample_rows)).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
