"""What the operators must find whole, whatever stands around it."""

import hashlib
import random

import numpy as np

from harrow.llm import common, line_dedup, ngram_join, substring_dedup


def test_planted_passages(spark):
    rng = random.Random(11)
    line = lambda: " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=14))
    rows, want = [], {}
    for k in range(60):
        passage = [line() for _ in range(2 + k % 3)]
        between = "\n\n" if k % 5 == 0 else "\n"
        for place in range(2):
            before, after = [line() for _ in range(rng.randrange(4))], [line() for _ in range(rng.randrange(3) if place else 2)]
            parts = ["".join(x + "\n" for x in before), between.join(passage) + ("\n" if after else ""), "\n".join(after)]
            rows.append((len(rows), "".join(parts)))
            want[len(rows) - 1] = parts[0] + parts[2] if place else "".join(parts)
    got = {r.doc_id: r for r in line_dedup.remove_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_removed == len(rows[i][1]) - len(want[i]) for i, r in got.items())


def test_passages_edges(spark):
    rows = [(1, "a a\nb b\nc c"), (1, "d d\na a\nb b\n"), (1, "a a\nb b\nc c"), (2, "x x\nx x\nx x"), (3, "y y\ny y\ny y\ny y"), (4, "z z\n\nb b\n\nq q"), (5, "r r\n\nb b\n\ns s"), (6, None), (7, ""), (None, "a a\nb b\nc c"), (8, "é é\nb b\nc c\n\nñ")]
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in line_dedup.remove_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    ones = sorted(t for i, t in got if i == 1)
    assert ones in (sorted(["a a\nb b\nc c"] * 2 + ["d d\n"]), sorted(["c c"] * 2 + ["d d\na a\nb b\n"]))
    assert [x for x in got if x[0] != 1] == [(-1, "a a\nb b\nc c"), (2, "x x\nx x\nx x"), (3, "y y\ny y\n"), (4, "z z\n\nb b\n\nq q"), (5, "r r\n\nb b\n\ns s"), (6, ""), (7, ""), (8, "é é\n\nñ")]


def test_substrings_of_one_id(spark):
    words = lambda x, n: " ".join(f"{x}{i}" for i in range(n))
    passage, long = words("p", 20), words("l", 60)
    rows = [(1, words("a", 20)), (2, passage), (3, words("a", 20)), (3, words("c", 30)), (4, long + " " + passage), (4, words("d", 15)), (5, words("c", 30))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.kept) for r in substring_dedup.dedup_table(df).collect())
    assert got == sorted([(1, 20, words("a", 20)), (2, 20, passage), (3, 20, ""), (3, 30, words("c", 30)), (4, 80, long), (4, 15, words("d", 15)), (5, 30, "")])


def test_links_of_one_id(spark):
    words = lambda x, n: " ".join(f"{x}{i}" for i in range(n))
    rows = [(1, words("a", 60)), (2, words("b", 60)), (3, words("a", 60)), (3, words("b", 59) + " end"), (4, words("c", 60)), (5, words("a", 60)), (5, words("c", 59) + " end")]
    got = {r.doc_id: r.component_id for r in ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict.fromkeys(range(1, 6), 1)


def test_very_long_texts(spark):
    """Texts of several slices are worked on in parts: what stands across the cuts is found as anywhere else."""
    rng = random.Random(4)
    line = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 14)))
    lines = [line() for _ in range(12_000)]
    lines[7000] = " ".join(f"v{i}" for i in range(60_000))  # a line longer than a slice
    long = "\n".join(lines)
    assert len(long) > 3 * common.SLICE_BYTES
    edges = [j for _, j in common.cuts(np.frombuffer(long.encode(), np.uint8))][:-1]
    feeds = [j for _, j in common.cuts(np.frombuffer(long.encode(), np.uint8), stops=line_dedup.IS_FEED)][:-1]
    around = "\n".join(x for j in [*edges, *feeds] for x in long[j - 300 : j + 300].split("\n")[1:-1])
    rows = [(1, long), (2, "new start " + long.replace(lines[3000], "edited") + "\nnew end"), (3, around), (4, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, first = {r.doc_id: r for r in substring_dedup.kept_digest(substring_dedup.dedup_table(df)).collect()}, {}
    for i, t in rows:
        w = t.split()
        gone = np.zeros(len(w), bool)
        for a in range(len(w) - 12):
            if first.setdefault(tuple(w[a : a + 13]), i) < i:
                gone[a : a + 13] = True
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), gone.sum(), hashlib.sha256(kept.encode()).hexdigest())
    sets = {i: len({tuple(w[a : a + 4]) for a in range(len(w) - 3)}) for i, t in rows for w in [t.split()]}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_groups(df).collect()} == {i: (sets[i], 3 if i == 3 else 1) for i in sets}
    seen, left = {}, {}
    for i, t in rows:
        own = t.split("\n")
        gone = set()
        for a in range(len(own) - 1):
            doc, at = seen.setdefault((own[a], own[a + 1]), (i, a))
            if doc != i or a > at + 1:
                gone |= {a, a + 1}
        left[i] = "".join(x for k, x in enumerate([*(x + "\n" for x in own[:-1]), own[-1]]) if k not in gone)
    assert {r.doc_id: r.text for r in line_dedup.remove_passages(df).collect()} == left


def test_compaction_in_the_query(spark, monkeypatch):
    levels, old = [], substring_dedup.FingerprintIndex.compact
    monkeypatch.setattr(substring_dedup.FingerprintIndex, "compact", lambda self: (old(self), levels.append([n for n, _ in self.runs])))
    rows = [(i, " ".join(f"w{(i % 9) * 5 + k}" for k in range(30))) for i in range(40)]
    substring_dedup.dedup_table(spark.createDataFrame(rows, "doc_id long, text string")).count()
    assert [1] in levels and levels[-1] == [1, 0]


def test_index_goes_on(spark):
    rows = [(i, " ".join(f"w{(i % 9) * 50 + k}" for k in range(30))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    name, found = "harrow_index_test", None
    for low in range(0, 40, 10):
        index = substring_dedup.FingerprintIndex(spark, name, fan_in=1)  # as a new session would
        assert [n for n, _ in index.runs] == [[], [0], [1], [1, 0]][low // 10]
        new = index.add(df.filter(f"doc_id >= {low} AND doc_id < {low + 10}"))
        new = spark.createDataFrame(new.collect(), new.schema)
        found = new if found is None else found.unionByName(new)
        index.compact()
    index.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(name)]
    kept = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(df, found).collect()}
    assert kept == {i: 30 if i >= 9 else 0 for i in range(40)}
