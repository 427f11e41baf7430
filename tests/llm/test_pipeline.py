"""The pipeline's stages on the smallest tables, each against a brute-force version on the rows that it was given."""

import hashlib
import os
from collections import Counter

import corpus_pipeline
import pytest

from harrow.llm import toxicity
from harrow.llm.common import shared_dir, written

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def near_duplicates(rows):
    sets = {}
    for i, t in rows.items():
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    group = {i: i for i in rows}

    def top(i):
        return i if group[i] == i else top(group[i])

    for i in rows:
        for j in rows:
            common = len(sets[i] & sets[j]) if j < i else 0
            if common and 100 * common >= 80 * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                group[max(a, b)] = min(a, b)
    return {i for i in rows if top(i) == i}


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    folder, columns = shared_dir(spark), docs.columns
    steps = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        steps.append(written(stage(spark, steps[-1], DATA), folder, str(k)))
        if k < 4:
            assert steps[-1].columns == columns
    texts = [{r.doc_id: r.text for r in s.select("doc_id", "text").collect()} for s in steps[:5]]
    model = toxicity.fit(docs, labels)
    assert set(texts[1]) == {i for i, t in texts[0].items() if model.score(t) < 0.5}

    first, kept = {}, {}
    for i in sorted(texts[1]):
        lines = (texts[1][i] or "").split("\n")
        filled = [k for k, x in enumerate(lines) if x.strip(" \t\v\f\r")]
        gone = set()
        for a, b in zip(filled, filled[1:], strict=False):
            doc, at = first.setdefault("\n".join(lines[a : b + 1]), (i, a))
            if doc != i or a > at + 1:
                gone.update(range(a, b + 1))
        left = "".join(x for k, x in enumerate([*(x + "\n" for x in lines[:-1]), lines[-1]]) if k not in gone)
        if left or not gone:
            kept[i] = left
    assert any(kept[i] != texts[1][i] for i in kept)
    assert texts[2] == kept
    assert set(texts[3]) == near_duplicates(texts[2])

    times = Counter(r.doc_id for r in steps[4].collect())
    assert set(times) == set(texts[3]) and max(times.values()) <= 2
    total = sum(len(t.split()) for t in texts[3].values())
    assert sum(len(texts[3][i].split()) * n for i, n in times.items()) <= 1.5 * total + 1
    coded = steps[5].collect()
    assert Counter((r.doc_id, r.decoded_sha256) for r in coded) == Counter({(i, hashlib.sha256(texts[4][i].encode()).hexdigest()): n for i, n in times.items()})


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0
