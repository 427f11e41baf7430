"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import hashlib
import math

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from harrow.llm import chat_format, graph_search, line_dedup, mixing, ngram_join, phrase_fingerprint, piece_coding, substring_dedup, toxicity, warc_bundles

LONG = "\n".join(" ".join(f"w{i * j % 997}" for j in range(12)) for i in range(3000))
PASSAGE = " ".join(f"p{i}" for i in range(40))
ROWS = [(0, PASSAGE, "en", "a"), (1, PASSAGE, "en", "a"), (2, None, None, None), (3, "", "en", "b"), (4, LONG, "en", "b"), (5, LONG + " end", "en", "b"), (6, "x " + PASSAGE + " y", "en", "a"), (6, "x " + PASSAGE + " y", "en", "a"), (None, PASSAGE, "en", "a"), (8, " \n\n ", "en", "a"), (9, "one two", "fr", "c")]
CLASHES = ["copy", "fps", "starts", "score", "predicted", "component", "gram", "size", "ids", "n_tokens", "mix_epoch", "mix_slot", "mix_place", "n_removed", "hash", "chunk", "term", "toxic", "guest", "payload", "rank"]


def docs(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit("mine") for c in CLASHES})


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("rows", [ROWS, []])
def test_documents_operators(spark, rows):
    df = docs(spark, rows)
    own = [r for r in rows if r[0] is not None]
    removed = {r.doc_id: r for r in substring_dedup.kept_digest(substring_dedup.dedup_table(df)).collect()}
    assert set(removed) == {r[0] for r in own}
    assert phrase_fingerprint.compare_edits(df).count() == len(own)
    assert phrase_fingerprint.fingerprints(df).count() == len(rows)
    groups = {r.doc_id: r.component_id for r in ngram_join.similar_groups(df).collect()}
    assert set(groups) == {r[0] for r in own}
    lines = line_dedup.remove_repeats(df)
    assert lines.count() == len(rows) and lines.columns.count("n_removed") == 1
    assert mixing.mix(df).columns.count("mix_epoch") == 1
    assert mixing.mix(df, max_epochs=1.0).count() == len(rows)
    coded = piece_coding.encode(df, check=True).collect()
    assert sorted(r.decoded_sha256 for r in coded) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t, _, _ in rows)
    assert toxicity.score_all(df, labels(spark)).count() == len(rows)
    if rows:
        assert (removed[0].n_removed, removed[1].n_removed, removed[2].n_words, removed[3].n_words) == (0, 40, 0, 0)
        assert removed[5].n_removed == removed[5].n_words - 1 == removed[4].n_words - removed[4].n_removed or removed[5].n_removed > 0
        assert groups[1] == 0 and groups[2] == 2 and groups[3] == 3 and groups[5] == 4 and groups[8] == 8


@pytest.mark.parametrize("rows", [ROWS, []])
def test_stages(spark, tmp_path, rows):
    labels(spark, [(0, 1, 0), (None, 1, None)]).write.parquet(str(tmp_path / "labels.parquet"))
    df = docs(spark, rows)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, df, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == df.columns
            assert all(r.score == "mine" and r.n_removed == "mine" and r.mix_epoch == "mine" for r in out.collect())
        df = out
    assert {"doc_id", "ids", "n_tokens"} <= set(df.columns)
    df.collect()


def test_pages(spark):
    rows = [(1, "http://a/", "x"), (2, None, "x"), (3, "http://b/\r\n", None), (4, "http://c/", ""), (None, "http://d/", "x"), (2, None, "x"), (5, "u", "y" * 2_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("mine") for c in CLASHES})
    got = [tuple(r)[:5] for r in warc_bundles.read(warc_bundles.bundles(df)).collect()]
    kinds = sorted((r[0], r[1], r[3], r[4]) for r in got)
    assert kinds[:1] == [(1, 1, "response", None)] and kinds[1] == kinds[2] == (2, 1, "revisit", 1) and kinds[3] == (3, 0, "response", None) and kinds[4] == (4, 0, "revisit", 3) and kinds[5][:3] == (5, 2_000_000, "response")
    assert warc_bundles.read(warc_bundles.bundles(df.limit(0))).count() == 0
    assert all(r[3] == "response" for r in warc_bundles.read(warc_bundles.bundles(df.filter("page_id in (3, 4)"), least_bytes=1)).collect())


def test_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 0, None, "x"), (3, 1, "assistant", "a"), (3, None, "system", "s"), (None, 0, "user", "x"), (4, 0, "user", "a"), (4, 0, "user", "a"), (5, 0, "user", "<|end|>\\[INST]\\a<|turn|>"), (5, 1, "assistant", "\\\\<|text|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("mine") for c in CLASHES})
    formatted = chat_format.format_conversations(df)
    got = {r.conv_id: r for r in chat_format.read_back(formatted).collect()}
    digest = lambda *turns: hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    assert got[1].turns_sha256 == digest(("user", "hi"), ("assistant", "")) and got[1].valid
    assert got[2].turns_sha256 == digest(("", "x")) and not got[2].valid
    assert got[3].turns_sha256 == digest(("system", "s"), ("assistant", "a")) and not got[3].valid
    assert got[4].n_turns == 2 and not got[4].valid
    assert got[5].turns_sha256 == digest(("user", rows[8][3]), ("assistant", rows[9][3])) and got[5].loss_chars == len(rows[9][3])
    assert set(got) == {1, 2, 3, 4, 5}
    assert chat_format.read_back(chat_format.format_conversations(df.limit(0))).count() == 0
    assert all(("".join(s.text for s in r.segments)) == r.formatted for r in formatted.collect())


def exact(vectors, q, k):
    """The k nearest of a query id among (id, vector) rows: of several vectors of an id its best counts."""
    scores = {}
    for i, v in vectors:
        for j, w in vectors:
            if j == q and i != q and len(v) == len(w):
                scores[i] = max(scores.get(i, -math.inf), float(np.dot(np.array(v), np.array(w))))
    return [i for i, _ in sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]]


def nearest(spark, rows, every, k, plain=False):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("mine") for c in CLASHES})
    usable = graph_search.usable(df)
    got = {}
    index, asked = graph_search.build_index(usable, k), usable.filter(F.col("vec_id") % every == 0)
    for r in sorted(graph_search.search_index(index, asked, k, exact=plain).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(got[r.query_id])
    return got


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)] + [(100 + i, [float(i), 1.0]) for i in range(30)]
    bad = [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 2.0]), (203, [nan, 1.0, 1.0]), (204, [inf, 1.0, 1.0]), (205, []), (None, [1.0, 1.0, 1.0]), (7, rows[7][1])]
    rows.append((40, [0.0, 0.0, 9.0]))
    got = nearest(spark, rows + bad, 20, 5)
    assert got == {q: exact(rows, q, 5) for q in (0, 20, 40, 100, 120)}
    assert nearest(spark, rows + bad, 20, 5, True) == got, "the exact search treats all of these alike"
    assert nearest(spark, rows[:1], 20, 5) == {} and nearest(spark, [], 20, 5) == {}


@pytest.mark.parametrize("size", [1e25, 1e-30, 1e-100, 1e150])
def test_vector_sizes(spark, size):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * size).tolist()) for i in range(300)]
    assert nearest(spark, rows[:15], 5, 20) == {q: exact(rows[:15], q, 20) for q in (0, 5, 10)}
    mixed = rows + [(i + 1000, (rng.normal(size=8) * 10.0 ** rng.integers(-20, 20)).tolist()) for i in range(100)]
    for got, vectors in ((nearest(spark, rows, 60, 20), rows), (nearest(spark, mixed, 60, 20), mixed)):
        assert all(len(set(found) & set(exact(vectors, q, 20))) >= 19 for q, found in got.items()) and set(got) == {i for i, _ in vectors if i % 60 == 0}


def test_vector_overflow(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 1.0]), (2, [1e200, -1e200]), (3, [-1e200, -1e200])]
    assert nearest(spark, rows, 10, 5) == {0: [1, 3, 2]}
