"""Alignment of two tokenizers against a loop over their tokens, and the tokenizers against their libraries."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from harrow.llm import token_alignment as ta

PARTS = [*"abcde  \n'stlr12!éñ漢字　😀▁", "the", " the", "ing", "'ll", "  ", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>"]


def texts(n, seed=1, most=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def both():
    return ta.Tokenizers(*ta.default_models())


def whole(both, text):
    """Ids by the two libraries over the whole text, None if they don't spell it."""
    a, b = both.whole.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text, num_threads=1)
    spelt = b"".join(map(both.a_bytes.__getitem__, a)) == b"".join(map(both.b_bytes.__getitem__, b)) == b" " + text.encode()
    return (a, b) if text and spelt else None


def test_ids_are_the_libraries(both, monkeypatch):
    points = ["".join(f"a{chr(c)}b {chr(c)}1{chr(c)} \n{chr(c)}!" for c in range(k, k + 64)) for k in range(0, 0x30000, 64) if not 0xD800 <= k < 0xE000]
    for text in texts(3000) + points:
        got = both.of(text)
        assert (got and (got[0].tolist(), got[3].tolist())) == whole(both, text)
    monkeypatch.setattr(ta, "PART_CHARS", 50)
    for text in [t.replace("▁", "") for t in texts(200, 2, 300)]:
        got = both.of(text)
        assert (got[0].tolist(), got[3].tolist()) == whole(both, text)


def brute(both, docs):
    per, counts, top = {}, Counter(), defaultdict(int)
    for i, text in docs:
        ids = whole(both, text) if text else None
        if ids:
            ends = [np.cumsum([len(own[t]) for t in side]).tolist() for own, side in zip((both.a_bytes, both.b_bytes), ids, strict=True)]
            groups, at = [], [0, 0]
            for cut in sorted(set(ends[0]) & set(ends[1])):
                to = [e.index(cut) + 1 for e in ends]
                groups.append(tuple(side[x:y] for side, x, y in zip(ids, at, to, strict=True)))
                at = to
            per[i] = (ids, groups, Counter((a, b) for x, y in groups for a in x for b in y))
            counts.update(per[i][2].keys())
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    out = {}
    for i, _ in docs:
        out[i] = (0,) * 6 + ("",)
        if i in per:
            ids, groups, links = per[i]
            name = ";".join("|".join(",".join(map(str, x)) for x in g) for g in groups)
            out[i] = (*map(len, ids), len(groups), sum(links.values()), sum(n for k, n in links.items() if counts[k] == top[k[0]]), sum(n * counts[k] for k, n in links.items()), hashlib.sha256(name.encode()).hexdigest())
    return out


@pytest.mark.parametrize("broadcast", [ta.BROADCAST_PAIRS, 20, 0])
def test_alignment(spark, both, monkeypatch, broadcast):
    monkeypatch.setattr(ta, "BROADCAST_PAIRS", broadcast)
    docs = list(enumerate([*texts(120, 3), None, "", " ", "a" * 3000, "no ▁ mark", "same text", "same text", " ".join(texts(2000, 4)).replace("▁", "")]))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("mine") for c in ("pair", "groups", "a_ids", "n_links", "_row")})
    got = ta.align(df).collect()
    assert {r.doc_id: tuple(r)[1:8] for r in got} == brute(both, docs)
    assert all(len(r.groups) == r.n_groups for r in got)


def test_nothing(spark):
    assert ta.align(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    twice = ta.align(spark.createDataFrame([(1, "one two"), (1, "one two")], "doc_id long, text string"), groups=False).collect()
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0].count_sum == 2 * twice[0].n_links


def test_ranks_need_no_words(both):
    both.words.clear()
    for text in ["plain words, one space each ", "<|none|> <|endoftext|>", "ñandú 漢字 \U00013000 ䷿\nnext\n line", "x" * ta.LONGEST_RANKED, " ".join(texts(300, 5)).replace("▁", "").replace("　", "").replace("  ", " ").replace("  ", " ")]:
        if "  " not in " " + text:
            assert both.b_ids(text).tolist() == both.b.encode(text) and both.a_ids(" " + text).tolist() == both.whole.encode(" " + text, add_special_tokens=False).ids
    assert not both.words
    for text in [" two  spaces   and  ", "a " + "xy" * 1000 + " b", " ", "  ", "y" * 5000]:
        assert both.b_ids(text).tolist() == both.b.encode(text)


def test_links_of_a_group(both):
    """One group of repeated ids on both sides: each pair once, with how often it is linked."""
    a, b = np.array([5, 5, 7], np.int32), np.array([9, 9], np.int32)
    row = (a, np.array([1, 2, 4]), np.array([3]), b, np.array([3, 4]), np.array([2]))
    columns = [c.to_pylist() for c in ta._aligned(both, [ta._NONE, row, ta._NONE], True)]
    assert columns[:4] == [[0, 3, 0], [0, 2, 0], [0, 1, 0], [0, 6, 0]]
    assert columns[4] == ["", hashlib.sha256(b"5,5,7|9,9").hexdigest(), ""]
    assert columns[5] == [[], [{"pair": 5 << 32 | 9, "n": 4}, {"pair": 7 << 32 | 9, "n": 2}], []]
    assert columns[6] == [[], [{"a": [5, 5, 7], "b": [9, 9], "pair": None}], []]
