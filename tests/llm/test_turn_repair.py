"""Conversation repair against an exhaustive search over edit sequences."""

import hashlib
import random
import re
import sys
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from harrow.llm import turn_repair

sys.setrecursionlimit(10_000)  # the search goes down once for each turn
SPACE = " \t\n\x0b\x0c\r"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        yield from [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)


def cheapest(turns):
    """(faults, cost, audit, turns) of rows in order: the least (cost, audit) of all edit sequences."""
    seen, faults = set(), []
    for role, text in turns:
        bare = [c for c in text if c not in SPACE]
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    @cache
    def best(i, state, inserted):
        ways = [(0, "", ())] if i == len(turns) and state in ("", "a") else []

        def add(cost, edit, after, turn, rest):
            if after is not None and (b := best(*rest(after))):
                ways.append((cost + b[0], edit + b[1], turn + b[2]))

        for role in ("user", "assistant") if inserted < 3 else ():
            add(5, "I", STEP.get((state, role[0])), ((role, ""),), lambda s: (i, s, inserted + 1))
        if i < len(turns):
            (role, text), late = turns[i], 5 if faults[i] == "t" else 0
            on = lambda s: (i + 1, s, 0)
            add(2, "D", state, (), on)
            if faults[i] not in ("b", "d"):
                add(late, "K", STEP.get((state, role[:1])), (turns[i],), on)
                for other in ("user", "assistant"):
                    add(1 + late, "R", STEP.get((state, other[0])), ((other, text),), on)
        return min(ways) if ways else None

    return faults, *best(0, "", 0)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(damage([r for r in rows if r[0] == conv]), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns, roles = [r[1] for r in own if r[1] is not None], [r[2][:1] for r in own]
        faults, cost, audit, kept = cheapest([r[2:] for r in own])
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in kept).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in "bdt"), illegal, cost, audit, digest)
    return out


def made(seed):
    rng, rows = random.Random(seed), []
    for conv in [*range(60), None]:
        for k in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append((conv, rng.choice([None, k, k, k, k + 1]), rng.choice(["user", "assistant", "system", "user", "assistant", None, "tool", "", "sys"]), rng.choice(["a.", "b!", "c", "", "  \n", None, "d?", "e. "])))
    # A third of all rows in one conversation, which so lies in several ranges.
    return rows + [(1000, k // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b!", "c", f"é{k}.", f"z{k}", f"q{k}?", f"d{k // 7}"])) for k in range(150)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_edits(spark, seed):
    rows = made(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("audit", F.lit("mine")).withColumn("pos", F.lit(1))
    assert {r.conv_id: tuple(r)[1:] for r in turn_repair.audited(df).collect()} == brute(rows)


def test_repaired_turns(spark):
    rows = [r for r in made(3) if r[0] in range(20)] + [(2000, k, "user", "x" * 300_000 + f"{k}.") for k in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {}
    for r in sorted(turn_repair.repair(df).collect(), key=lambda r: (r.conv_id, r.place)):
        got.setdefault(r.conv_id, []).append((r.role, r.text))
        assert r.place == len(got[r.conv_id]) - 1
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1], r[2] if r[2] is not None else " ", r[3] if r[3] is not None else " ") for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        assert tuple(got.get(conv, ())) == cheapest([r[1:] for r in own])[3]
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in got.get(conv, ())))


def test_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.audited(none).count() == turn_repair.repair(none).count() == 0
    gone = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    only = spark.createDataFrame([(7, gone, "user", "a.")], none.schema)
    assert [tuple(r) for r in turn_repair.audited(only).collect()] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
