"""Byte-level coding against the tiktoken library, and edits against encoding anew."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from harrow.llm import byte_coding

PARTS = [*"abcde  \n'stlr12!éñ漢字　😀", "the", " the", "ing", "'ll", "  "]


@pytest.fixture(scope="module")
def vocabulary():
    return byte_coding.ByteVocabulary.load()


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=byte_coding.default_pattern(), mergeable_ranks=vocabulary.ranks, special_tokens={})


def ids(vocabulary, text):
    return np.frombuffer(b"".join(vocabulary.encode_text(text)), "<u4").tolist()


def test_ids_are_the_librarys(vocabulary, library, monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(5000)] + ["".join(rng.choice("abcdeghinostr") for _ in range(3000)), " " * 5000, "a" * 5000]
    texts += ["".join(f"a{chr(c)}b {chr(c)}1{chr(c)} {chr(c)}{chr(c)} \n{chr(c)}!{chr(c)}" for c in range(k, k + 64)) for k in range(0, 0x110000, 64) if not 0xD800 <= k < 0xE000]
    for text in texts:
        assert ids(vocabulary, text) == library.encode_ordinary(text)
        assert vocabulary.decode(b"".join(vocabulary.encode_text(text))) == text.encode()
    monkeypatch.setattr(byte_coding, "AT_ONCE", 7)
    assert [ids(vocabulary, t) for t in texts[:500]] == [library.encode_ordinary(t) for t in texts[:500]]


def test_edits_are_as_new(vocabulary):
    rng = random.Random(2)
    for k in range(3000):
        long = k % 10 == 0
        text = "".join(rng.choice("abcdeghinostr" if long else PARTS) for _ in range(1500 if long else rng.randint(0, 40)))
        at = rng.choice([rng.randint(0, len(text)), len(text)])
        removed, inserted = rng.randint(0, min(5, len(text) - at)), "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 5)))
        new, table, looked = vocabulary.edited(text, vocabulary.table(text), at, removed, inserted)
        assert new == text[:at] + inserted + text[at + removed :] and table == vocabulary.table(new)
        assert vocabulary.ids(table) == ids(vocabulary, new)
        if long:
            assert looked < 700  # only near the edit


def test_columns(spark, library):
    rows = [(0, "some text"), (1, None), (2, ""), (2, ""), (None, "x"), (4, "<|endoftext|> 漢字 " * 40_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("mine") for c in ("ids", "n_tokens", "last_tokens")})
    got = byte_coding.encode(df, tables=True).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.decoded_sha256) for r in got) == sorted((str(i), len(library.encode_ordinary(t or "")), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert all(r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest() and len(r.ids) == r.n_tokens for r in got)
    assert byte_coding.encode(df.limit(0)).count() == 0
    coded = df.filter("doc_id = 0 OR doc_id = 4").select("doc_id", "text").join(byte_coding.encode(df, tables=True).select("doc_id", "last_tokens"), "doc_id")
    changed = byte_coding.edit(coded.withColumns({"at": F.when(F.col("doc_id") == 0, F.length("text")).otherwise(100_001), "removed": F.when(F.col("doc_id") == 4, 3), "inserted": F.lit("s, more")}))
    for r in changed.collect():
        assert r.ids == library.encode_ordinary(r.text) and r.n_looked < 100
    texts = {r.doc_id: r.text for r in byte_coding.decode(changed.select("doc_id", "ids")).collect()}
    assert texts == {r.doc_id: r.text for r in changed.collect()}


def test_vocabulary_must_be_whole(tmp_path):
    (tmp_path / "ranks").write_text("YQ== 0\nYg== 1\n")
    with pytest.raises(ValueError):
        byte_coding.ByteVocabulary.load(str(tmp_path / "ranks"))
