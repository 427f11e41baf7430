"""Each operator against a brute-force version, an exact round trip, or held-out accuracy."""

import base64
import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harrow.llm import chat_format, common, components, graph_search, line_dedup, mixing, ngram_join, phrase_fingerprint, piece_coding, substring_dedup, toxicity, warc_bundles


def texts(n, seed=3):
    """Texts with copies, near copies, shared passages and repeated lines."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = rng.choices(words, k=60)
    out = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and out:
            out.append(rng.choice(out))
        elif kind == 2 and out:
            w = rng.choice(out).split(" ")
            w[rng.randrange(len(w))] = "edit"
            out.append(" ".join(w))
        elif kind == 3:
            a = rng.choices(words, k=rng.randrange(5, 60))
            out.append(" ".join(a + passage + a[:3]))
        else:
            out.append("\n".join(" ".join(rng.choices(words, k=rng.randrange(1, 12))) for _ in range(rng.randrange(1, 14))))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(texts(240))), "doc_id long, text string")


@pytest.mark.parametrize("batches,fan_in", [(1, 4), (3, 4), (5, 1)])
def test_substring_dedup(spark, docs, batches, fan_in):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    index, shared = substring_dedup.FingerprintIndex(spark, fan_in=fan_in), None
    for k in range(batches):
        new = index.add(docs.filter((F.col("doc_id") * batches / len(rows)).cast("int") == k))
        new = spark.createDataFrame(new.collect(), new.schema)
        shared = new if shared is None else shared.unionByName(new)
        index.compact()
    assert len(index.runs) == batches or any(level for level, _ in index.runs)
    got = {r.doc_id: r for r in substring_dedup.kept_digest(substring_dedup.remove_repeats(docs, shared)).collect()}
    index.drop()
    first = {}
    for i, t in rows:
        w = t.split()
        for a in range(len(w) - 12):
            first.setdefault(tuple(w[a : a + 13]), i)
    for i, t in rows:
        w = t.split()
        gone = set()
        for a in range(len(w) - 12):
            if first[tuple(w[a : a + 13])] < i:
                gone.update(range(a, a + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())


@given(st.lists(st.binary(max_size=60).map(lambda b: b.decode("utf-8", "ignore")), max_size=12))
@settings(max_examples=60, deadline=None)
def test_words_and_hashes(rows):
    import pyarrow as pa

    data, offsets = common.string_bytes(pa.array(rows, pa.string()))
    starts, ends, counts = common.words_of(data, offsets)
    own = [r.encode().split() for r in rows]
    assert [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)] == [w for r in own for w in r]
    assert list(np.diff(counts)) == [len(r) for r in own]
    hashes = common.word_hashes(data, starts, ends)
    seen = {}
    for w, h in zip([w for r in own for w in r], hashes, strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@given(st.text(alphabet="ab ", max_size=60), st.text(alphabet="ab ", max_size=60))
@settings(max_examples=100, deadline=None)
def test_phrases(a, b):
    def brute(t):
        seen, w = set(), ""
        for c in t:
            w += c
            if w not in seen:
                seen.add(w)
                w = ""
        return seen

    ends = phrase_fingerprint.phrase_ends(a)
    assert {a[i:j] for i, j in zip([0, *ends], ends, strict=False)} == brute(a)
    x, y = brute(a), brute(b)
    exact = len(x & y) / len(x | y) if x | y else 1.0
    assert math.isclose(phrase_fingerprint.likeness(phrase_fingerprint.signature(a), phrase_fingerprint.signature(b)), exact)


def test_compare_edits(docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: r for r in phrase_fingerprint.compare_edits(docs).collect()}
    for k, (i, t) in enumerate(rows):
        follows = rows[(k + 1) % len(rows)][1]
        n = len(t)
        edited = t[: n - n // 4] + follows[: n // 4]
        own, other, after = (phrase_fingerprint.signature(x) for x in (t, edited, follows))
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (n, hashlib.sha256(edited.encode()).hexdigest(), phrase_fingerprint.signature_string(own), phrase_fingerprint.signature_string(other))
        assert (r.near_edited, r.near_next) == (phrase_fingerprint.likeness(own, other), phrase_fingerprint.likeness(own, after))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_ngram_join(docs, n, percent):
    rows = {r.doc_id: r.text.lower().split() for r in docs.collect()}
    sets = {i: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set()) for i, w in rows.items()}
    group = {i: i for i in sets}

    def top(i):
        return i if group[i] == i else top(group[i])

    for i in sets:
        for j in range(i):
            common_ = len(sets[i] & sets[j])
            if common_ and 100 * common_ >= percent * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                group[max(a, b)] = min(a, b)
    got = {r.doc_id: r for r in ngram_join.similar_groups(docs, n, percent).collect()}
    assert {i: (got[i].n_shingles, got[i].component_id) for i in got} == {i: (len(sets[i]), top(i)) for i in sets}


def test_components(spark, tmp_path):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    got = {r.id: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long"), str(tmp_path / "c")).collect()}
    group = {}
    for a, b in links:
        group.setdefault(a, a), group.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(group[a], group[b])
            changed |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    assert {i: c for i, c in got.items()} == {i: c for i, c in group.items() if any(i in p and p[0] != p[1] for p in links)}


def test_piece_coding(spark):
    v = piece_coding.PieceVocabulary.load()
    table = {p: s for p, s in zip(v.pieces, v.scores, strict=True) if p}
    words = sorted({w for t in ("the theme of these themes", "El niño pequeño", "漢字 test", "a▁b", "xyzzyqq") for w in v.words(t)})
    for word, pieces in zip(words, v.encode_words(words), strict=True):
        best = [0.0]
        for j in range(1, len(word) + 1):
            options = [best[i] + table[word[i:j]] for i in range(max(0, j - 20), j) if word[i:j] in table]
            best.append(max(options, default=best[j - 1] + v.byte_score * len((piece_coding.MARK if word[j - 1] == " " else word[j - 1]).encode())))
        own = sum(v.byte_score if v.bytes_first <= p < v.bytes_first + 256 else v.scores[p] for p in pieces)
        assert math.isclose(own, best[-1])
    rows = [(i, t) for i, t in enumerate(texts(40) + ["  two  spaces ", "▁ mark", "a\n\nb", "\0x", "é😀"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    coded = piece_coding.encode(df, check=True)
    assert {r.doc_id: r.text for r in piece_coding.decode(coded.select("doc_id", "ids")).collect()} == dict(rows)
    assert all(r.ids == v.encode(dict(rows)[r.doc_id]) and r.n_tokens == len(r.ids) for r in coded.collect())


def test_words_searched_together(monkeypatch):
    """Words searched together have the pieces of the search character by character, at borders of blocks and of lengths too."""
    v = piece_coding.PieceVocabulary.load()
    rng = random.Random(5)
    parts = [*"abe '\n\0▁ ñ漢😀䷿\U00013000", "the", "ing", "tion", "▁▁"]
    words = sorted({"".join(rng.choice(parts) for _ in range(rng.randint(1, 20))) for _ in range(1500)} | {"a", "a\0", "\0", "\0\0", "x" * 47, "x" * 48, "x" * 49, "ab" * 500})
    slow = v._encode_long(words)
    assert v.encode_words(words) == slow
    monkeypatch.setattr(piece_coding, "TOGETHER", 7)
    assert v.encode_words(words) == slow
    keys = {k for t in ("some words ▁ of\na text", "two  spaces", "x" * 60) for k in v.keys(t)}
    assert v.encode_keys(keys) == {k: v.encode_words([v.marked(k)])[0] for k in keys} and not v.encode_keys(set())


@given(st.text(alphabet="ab ▁\n\0é", max_size=30))
@settings(max_examples=80, deadline=None)
def test_pieces_round_trip(text):
    v = piece_coding.PieceVocabulary.load() if not hasattr(test_pieces_round_trip, "v") else test_pieces_round_trip.v
    test_pieces_round_trip.v = v
    words = v.words(text)
    known = dict(zip(sorted(set(words)), v.encode_words(sorted(set(words))), strict=True))
    assert v.encode(text) == [p for w in words for p in known[w]]
    assert v.decode(v.encode(text)) == text


@pytest.mark.parametrize("budget,limit,target", [(None, 1.5, None), (3000, 2.0, None), (20_000, 3.0, None), (4000, None, 1.0)])
def test_mixing(spark, budget, limit, target):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randrange(1, 30)), rng.choices(["a", "b", "c", None], [60, 25, 10, 5])[0]) for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), budget, target, limit, block_tokens=200).collect()
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t.split())
    plan = mixing.plan({("null" if s is None else f"={s}"): n for s, n in size.items()}, budget, target, limit)
    times = Counter((r.doc_id, r.source) for r in got)
    for s, n in size.items():
        quota = plan.weights["null" if s is None else f"={s}"] * plan.budget
        taken = sum(len(r.text.split()) for r in got if r.source == s)
        assert quota - 30 <= taken <= quota + 1e-6
        own = [times[i, s] for i, _, x in rows if x == s]
        assert max(own) - min(own) <= 1 and min(own) == int(quota / n + 1e-9)
    if limit:
        assert plan.budget <= limit * sum(size.values()) + 1e-6 and max(times.values()) <= math.ceil(limit)
    if target is not None:
        assert mixing.entropy(list(plan.weights.values())) <= target + 1e-6
    if budget is None:
        assert len(times) == len(rows)


def test_mixing_order(spark):
    """The last epoch takes the longest beginning, in block order, that fits the quota; sources lie spread over the order."""
    rng = random.Random(9)
    rows = [(i, " ".join("w" * rng.randrange(1, 30)), rng.choices(["a", "b", None], [70, 25, 5])[0]) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    whole, part = mixing.mix(df, budget=60_000, max_epochs=4.0, block_tokens=200).collect(), mixing.mix(df, budget=11_000, max_epochs=1.3, block_tokens=200).collect()
    key = lambda r: (r.mix_slot, r.mix_place, r.doc_id)
    size = Counter()
    for _, t, s in rows:
        size["null" if s is None else f"={s}"] += len(t.split())
    plan = mixing.plan(dict(size), 11_000, None, 1.3)
    for s in ("a", "b", None):
        name = "null" if s is None else f"={s}"
        quota = plan.weights[name] * plan.budget
        last = int(quota / size[name] + 1e-9)
        order, taken, left = sorted((r for r in whole if r.source == s and r.mix_epoch == last), key=key), [], quota - last * size[name]
        assert len(order) == sum(x == s for _, _, x in rows)
        for r in order:
            left -= len(r.text.split())
            if left < 0:
                break
            taken.append(r.doc_id)
        assert [r.doc_id for r in sorted((r for r in part if r.source == s and r.mix_epoch == last), key=key)] == taken
    order = [r.source for r in sorted((r for r in whole if r.mix_epoch == 0), key=key)]
    assert sum(x != y for x, y in zip(order, order[1:], strict=False)) > 40 and {"a", "b"} <= set(order[: len(order) // 4])


def test_warc_seek(spark):
    rows = [(i, f"http://h/{i}", "html é " * (i % 9)) for i in range(60)]
    bundled = warc_bundles.bundles(spark.createDataFrame(rows, "page_id long, url string, html string"), frame_bytes=600, bundle_bytes=900)
    bundled = spark.createDataFrame(bundled.collect(), bundled.schema)
    places = {r.record_id: r for r in warc_bundles.index(bundled).collect()}
    assert set(places) == set(range(60)) and max(r.frame for r in places.values()) > 0 and bundled.count() > 1
    wanted = spark.createDataFrame([(7,), (59,)], "record_id long")
    got = warc_bundles.fetch(bundled, wanted.unionByName(spark.createDataFrame([(7,), (999,)], "record_id long"))).collect()
    assert sorted(r.record_id for r in got) == [7, 59]
    for r in got:
        fields, http, payload, end = warc_bundles.parse_record(r.record, 0)
        assert warc_bundles.page_of(fields["WARC-Record-ID"]) == r.record_id and end == len(r.record)
    back = {r.page_id: r for r in warc_bundles.read(bundled).collect()}
    first = {}
    for i, url, html in rows:
        payload, r = html.encode(), back[i]
        refers = first.setdefault(payload, i)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert tuple(r) == (i, len(payload), digest, "response" if refers == i else "revisit", None if refers == i else refers, url)

    data = bundled.first()["data"]
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert len(whole) == sum(size for _, _, size in warc_bundles.seek_table(data))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "x<"]), st.text(alphabet="<|>[]/\\abtx ", max_size=20)), max_size=5))
@settings(max_examples=80, deadline=None)
def test_chat_escapes(turns):
    t = chat_format.ChatTemplate()

    def escape(x):
        for plain, code in t.codes.items():
            x = x.replace(plain, code)
        return x

    formatted = "".join(t.turn_open + escape(r) + t.text_open + escape(x) + t.turn_close for r, x in turns)
    assert chat_format.parse(formatted, t) == turns
    for r, x in turns:
        assert not any(c in escape(x) for c in (t.turn_open, t.text_open, t.turn_close, *t.more_controls)) and t.unescape(escape(x)) == x


def test_line_dedup(docs, spark):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: r for r in line_dedup.remove_repeats(docs).collect()}
    seen, some = set(), 0
    for i, t in rows:
        raw, first, kept = t.encode(), 0, []
        ends, lines = line_dedup.chunk_ends(np.frombuffer(raw, np.uint8))
        for end, n in zip(ends, lines, strict=True):
            chunk = raw[first:end]
            first = end
            if n > 1 and chunk in seen:
                some += 1
                continue
            if n > 1:
                seen.add(chunk)
            kept.append(chunk)
        assert got[i].text == b"".join(kept).decode() and got[i].n_removed == len(raw) - sum(map(len, kept))
    assert some


def test_chunks_resist_shifts():
    lines = [f"line {i} {i * i % 101}\n".encode() for i in range(200)]
    cut = lambda ls: {b"".join(ls)[a:b] for a, b in zip([0, *line_dedup.chunk_ends(np.frombuffer(b"".join(ls), np.uint8))[0]], line_dedup.chunk_ends(np.frombuffer(b"".join(ls), np.uint8))[0], strict=False)}
    a, b = cut(lines), cut([b"new\n", *lines])
    assert len(a & b) >= len(a) - 3


def test_toxicity_held_out(spark):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne") for b in ("ra", "so", "tu", "vi", "wo")]
    marks = ["idiot", "zorgfuk", "zorgpek", "zorgtam", "zorglim"]
    rows, labels = [], []
    for i in range(900):
        toxic = rng.random() < 0.2
        w = rng.choices(words, k=30)
        if toxic:
            w[rng.randrange(30)] = rng.choice(marks)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    got = {r.doc_id: r for r in toxicity.score_all(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [i for i, _, _ in labels if got[i].held_out]
    assert len(held) > 100 and sum(got[i].predicted == labels[i][2] for i in held) >= 0.98 * len(held)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)


def test_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 24))
    vectors = np.concatenate([c + 0.6 * rng.normal(size=(120, 24)) for c in centres]) * rng.uniform(0.5, 2, (1440, 1))
    vectors[100:140] = vectors[100]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    usable = graph_search.usable(df)
    index = graph_search.build_index(usable, 20, shard_rows=400)
    assert index.count() > 1
    found = {}
    for r in graph_search.search_index(index, usable.filter("vec_id % 20 = 0"), 20).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q, rows in found.items():
        scores = vectors @ vectors[q]
        exact = [i for i in np.lexsort((np.arange(1440), -scores)) if i != q][:20]
        rows.sort()
        assert len(rows) == 20 and all(math.isclose(s, scores[i], rel_tol=1e-12) for _, i, s in rows)
        hits += len({i for _, i, _ in rows} & set(exact))
    assert hits >= 0.95 * 20 * len(found) and len(found) == 72


def test_toxicity_unseen_terms(spark):
    """Toxic words are a stem and an ending; held-out rows have endings of which no row taught."""
    rng = random.Random(6)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "po", "ri") for b in ("ra", "so", "tu", "vi", "wo")]
    rows, labels = [], []
    for i in range(1200):
        held, toxic = zlib.crc32(str(i).encode()) % 5 == 0, rng.random() < 0.2
        w = rng.choices(words, k=40)
        if toxic:
            w[rng.randrange(40)] = rng.choice(["zorgfu", "blekni", "hrumpo"]) + rng.choice(["xa", "xe", "xi"] if held else ["ba", "be", "bi", "bo"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    again = [(3, rows[3][1]), (3, "katu another text"), (None, rows[5][1])]  # repeated ids and a null one
    got = toxicity.score_all(spark.createDataFrame(rows + again, "doc_id long, text string"), spark.createDataFrame(labels + labels[:9], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows) + 3 and sum(r.doc_id == 3 for r in got) == 3
    one = {r.doc_id: r for r in got if r.doc_id not in (3, None)}
    held = [i for i, r in one.items() if r.held_out]
    assert len(held) > 150 and sum(one[i].predicted == labels[i][2] for i in held) >= 0.97 * len(held)


def test_toxicity_disguises():
    voters = toxicity.Voters([])
    said = lambda t: {n for n, v in zip(voters.names, toxicity.votes_of(pa.array([t]), voters, np.array([0]))[0], strict=True) if v == toxicity.TOXIC}
    assert said("what an 1d10t") == {"leet"} and said("stuuupid thing") == {"stretched"} and said("so idiots say") == {"starts"}
    assert said("you are a moron") >= {"contempt", "addressed"} and said("scum and clown and clown") >= {"dehuman", "insult", "repeated"}
    assert said("SHOUTING ALL THE TIME HERE") == {"shout"} and said("no!!! #$%& way") == {"exclaim", "signs"} and not said("a calm text") and not said("")


@given(st.lists(st.text(alphabet="abI é1!\n", max_size=40), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_in(rows):
    data, offsets = common.string_bytes(pa.array(rows, pa.string()))
    w = toxicity.words_in(data, offsets)
    own = [(i, m.group()) for i, t in enumerate(rows) for m in re.finditer(r"[^\W\d_]+", t.lower())]
    assert [(r, "".join(map(chr, w.codes[a:b]))) for r, a, b in zip(w.rows, w.starts, w.ends, strict=True)] == own


@given(st.text(alphabet="ab \n", max_size=80), st.integers(1, 20))
@settings(max_examples=100, deadline=None)
def test_cuts(text, most):
    data = np.frombuffer(text.encode(), np.uint8)
    parts = [data[a:b].tobytes().decode() for a, b in common.cuts(data, most)]
    assert "".join(parts) == text and [w for p in parts for w in p.split()] == text.split()


def _spots(rng, n: int, width: int, spread: float) -> np.ndarray:
    return rng.normal(size=(40, width))[rng.integers(0, 40, n)] + spread * rng.normal(size=(n, width))


#: Vectors of full shards by kind: how many shards, their dimension, and how they lie.
FULL_SHARDS = {
    "unit": (3, 32, lambda rng, n, w: rng.normal(size=(n, w))),
    "spread": (3, 32, lambda rng, n, w: rng.normal(size=(n, w))),
    "wide": (2, 256, lambda rng, n, w: rng.normal(size=(n, w))),
    "very wide": (2, 768, lambda rng, n, w: rng.normal(size=(n, w))),
    "tight": (1, 64, lambda rng, n, w: _spots(rng, n, w, 0.01)),
    "loose": (1, 64, lambda rng, n, w: _spots(rng, n, w, 0.3)),
}


@pytest.mark.parametrize("kind", list(FULL_SHARDS))
def test_recall_of_full_shards(spark, kind):
    shards, width, draw = FULL_SHARDS[kind]
    rng = np.random.default_rng(8)
    n = shards * max(min(graph_search.SHARD_ROWS, graph_search.SHARD_VALUES // width), graph_search.LEAST_ROWS)
    vectors = draw(rng, n, width)
    if kind in ("unit", "spread"):
        vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    if kind == "spread":
        vectors *= np.exp(rng.normal(size=(n, 1)))
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": pa.FixedSizeListArray.from_arrays(vectors.ravel(), width).cast(pa.list_(pa.float64()))}))
    usable = graph_search.usable(df).repartition(4)
    index = common.written(graph_search.build_index(usable, 20), common.shared_dir(spark), "index")
    stored = index.select("n", "beam", "recall").collect()
    assert len(stored) == shards and all(r.recall >= graph_search.WANTED for r in stored)
    asked = usable.filter(f"vec_id % {n // 120} = 0")
    found, exact = {}, {}
    for out, rows in ((found, graph_search.search_index(index, asked, 20)), (exact, graph_search.search_index(index, asked, 20, exact=True))):
        for r in rows.collect():
            out.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, rows in found.items():
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        best = set(np.argsort(-scores)[:20].tolist())
        hits += len(rows & best)
        assert exact[q] == best
    print(kind, "recall", hits / 20 / len(found), stored)
    assert len(found) >= 120 and hits >= 0.95 * 20 * len(found)
