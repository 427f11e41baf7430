"""Repair of the structure of conversations by the cheapest edits.

A conversation is right if the initials of its roles are an optional s and then one or more pairs ua, or if it is empty. Costs to go are
computed backwards over (turn, state of that grammar); then a walk forwards takes, of the edits that keep to the cheapest cost, the one
whose initial comes first in ASCII.

No conversation has to fit into a task: turns are put in order by ranges, and a range's part of a conversation is a segment. A segment is
summed up by the cheapest costs between states (4 x 4). The costs to go at the ends of segments follow from these sums alone; then each
segment is walked from each state it may be entered in, and the walks are strung together when the repaired turns are put out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_dir, tidied, written

#: Costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States of the grammar: nothing yet, behind s, u or a; those a conversation may end in; where an initial leads to.
STATES, ENDS = range(4), (0, 3)
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The state behind the one user or assistant turn that may follow, and that turn's role.
NEXT, ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
NEVER = 1 << 60
#: Text that is no word character: space and the controls 9 to 13.
BLANK = "[\\x20\\x09-\\x0D]"


def damaged(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) with planted faults, by the remainder of crc32 of `conv_id:turn` by 20: 0 drops the row, 1 empties its
    text, 2 takes its `.!?` away, 3 repeats it, 4 makes it the user's. A null is one space, in the key too; a null turn or conv_id stays null."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    text = F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")), (F.crc32(key) % 20).alias("_k")).filter("_k <> 0")
    rows = rows.select("conv_id", "turn", F.when(F.col("_k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("_k") == 3, 2).otherwise(1))).alias("_copy"))
    return rows.drop("_copy")


def ordered(turns: DataFrame, folder: str) -> DataFrame:
    """turns in order as a written table: by conversation, turn (nulls first), role and text, with their place `pos` (range of the table and number
    in it), the initial of the role, and whether the text is blank or truncated. Equal rows are alike, so their order doesn't matter."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role"]
    # Ranges are found by the beginning of a text, so that the driver's sample of keys stays small.
    dealt = turns.repartitionByRange(parts, *order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    bare = F.regexp_replace("text", BLANK, "")
    flags = {"pos": F.monotonically_increasing_id(), "initial": F.substring("role", 1, 1), "blank": F.length(bare) == 0, "cut_off": ~F.substring(bare, -1, 1).isin(".", "!", "?")}
    return written(dealt.withColumns(flags), folder, "ordered")


def symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, initial, fault) of ordered rows: fault is b, d or t for the first of blank, duplicate (role and text stood before in the
    conversation) and truncated that a row is, or empty. Repeats are found by digests, each group as its first place."""
    digest = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    firsts = rows.groupBy("conv_id", digest.alias("_text")).agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("_first"))
    fault = F.when(F.col("blank"), "b").when(F.col("_first").isNull(), "d").when(F.col("cut_off"), "t").otherwise("")
    return rows.select("conv_id", "pos", "turn", "initial", "blank", "cut_off").join(firsts, "pos", "left").select("conv_id", "pos", "turn", "initial", fault.alias("fault"))


def edits(initial: str, fault: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, state behind it) of what may be done with a row. Inserting isn't among them: it leaves the row where it is."""
    yield "D", DELETE, state
    if fault not in ("b", "d"):
        stays = TRUNCATED if fault == "t" else 0
        if (state, initial) in STEPS:
            yield "K", stays, STEPS[state, initial]
        yield "R", REROLE + stays, NEXT[state]


def inserted(costs: list[int]) -> list[int]:
    """Costs to go by state, where turns may be inserted first."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
    return costs


def cost_before(row: tuple[str, str], behind: list[int]) -> list[int]:
    """Costs to go by state in front of an (initial, fault) row, from those behind it."""
    return inserted([min(cost + behind[to] for _, cost, to in edits(*row, s)) for s in STATES])


FINAL = inserted([0 if s in ENDS else NEVER for s in STATES])


@cache
def crossing(row: tuple[str, str]) -> list[list[int]]:
    """The costs of getting across a row from state to state."""
    to = [cost_before(row, [0 if s == t else NEVER for s in STATES]) for t in STATES]
    return [[to[t][s] for t in STATES] for s in STATES]


def then(so_far: list[list[int]], more: list[list[int]]) -> list[list[int]]:
    return [[min(NEVER, *(so_far[s][k] + more[k][t] for k in STATES)) for t in STATES] for s in STATES]


# Costs to go matter up to a common summand; without it there are few different ones, so each step is worked out once.
def least_zero(costs: list[int]) -> tuple[int, ...]:
    return tuple(c - min(costs) for c in costs)


@cache
def stepped(row: tuple[str, str], behind: tuple[int, ...]) -> tuple[int, ...]:
    return least_zero(cost_before(row, list(behind)))


@cache
def step(row: tuple[str, str], behind: tuple[int, ...], state: int) -> tuple[int, str]:
    """(state behind, edits) of a row: insertions first if they keep to the cheapest cost and come first in ASCII, then the row's own edit."""
    before, out = cost_before(row, list(behind)), ""
    while not out or out[-1] == "I":
        ways = [("I", INSERT + before[NEXT[state]], NEXT[state])] + [(name, cost + behind[to], to) for name, cost, to in edits(*row, state)]
        name, _, state = min(w for w in ways if w[1] == before[state])
        out += name
    return state, out


def walk(rows: list[tuple[str, str]], state: int, end: list[int], last: bool) -> tuple[int, str]:
    """(state behind, edits) of the walk through rows. end: costs to go behind them; behind the last segment, turns may still be inserted."""
    costs = [least_zero(end)]
    for row in reversed(rows):
        costs.append(stepped(row, costs[-1]))
    out = []
    for row, behind in zip(rows, reversed(costs[:-1]), strict=True):
        state, done = step(row, behind, state)
        out.append(done)
    while last and state not in ENDS:
        state = NEXT[state]
        out.append("I")
    return state, "".join(out)


def kind_of(row: dict) -> tuple[str, str]:
    """All initials that the grammar doesn't know are alike."""
    return row["initial"] if row["initial"] in ("s", "u", "a") else "", row["fault"]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _mapped(df: DataFrame, run: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """df's rows, in the order of each partition, through a function from rows to rows. Only what it holds on to stays in memory."""
    shape = df.sparkSession.createDataFrame([], schema).schema

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        arrow = pa.schema([pa.field(f.name, _arrow(f.dataType.simpleString())) for f in shape.fields])
        for row in run(_rows(batches)):
            out.append(row)
            if len(out) == 500:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    return df.mapInArrow(tidied(whole), shape)


def _arrow(name: str) -> pa.DataType:
    simple = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.list_(simple[name[6:-1]]) if name.startswith("array<") else simple[name]


SEGMENT = "conv_id long, part long, first long, costs array<bigint>, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, head string, tail string"


def segments(symbols_: DataFrame) -> DataFrame:
    """One row for each range's part of a conversation: its first place, its costs from state to state, and what its faults and turns come to."""
    place = symbols_.withColumn("part", F.shiftright("pos", 33))

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        own, key = {}, None
        for r in rows:
            if (r["part"], r["conv_id"]) != key:
                if own:
                    yield own | {"costs": [c for line in own["costs"] for c in line]}
                key = (r["part"], r["conv_id"])
                own = {"conv_id": r["conv_id"], "part": r["part"], "first": r["pos"], "costs": [[0 if s == t else NEVER for t in STATES] for s in STATES], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "low": None, "high": None, "head": r["initial"], "tail": None}
            own["costs"] = then(own["costs"], crossing(kind_of(r)))
            if r["fault"]:
                own[{"b": "blank", "d": "duplicate", "t": "truncated"}[r["fault"]]] += 1
            own["illegal"] += own["tail"] is not None and own["tail"] + r["initial"] not in ("su", "ua", "au")
            own["tail"] = r["initial"]
            if r["turn"] is not None and r["turn"] != own["high"]:
                own["turns"] += 1
                own["low"] = r["turn"] if own["low"] is None else own["low"]
                own["high"] = r["turn"]
        if own:
            yield own | {"costs": [c for line in own["costs"] for c in line]}

    return _mapped(place.repartition(F.col("part")).sortWithinPartitions("part", "pos"), run, SEGMENT)


def ends(segments_: DataFrame) -> DataFrame:
    """(conv_id, part, first, end, last) of each segment: costs to go behind it, by state, and whether nothing comes behind it (1 or 0).

    A conversation has at most one segment for each range; they pass from its last one to its first, one at a time."""

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        key, end, last = object(), FINAL, 1
        for r in rows:
            if r["conv_id"] != key:
                key, end, last = r["conv_id"], FINAL, 1
            yield {"conv_id": key, "part": r["part"], "first": r["first"], "end": end, "last": last}
            costs = r["costs"]
            end, last = [min(NEVER, *(costs[4 * s + t] + end[t] for t in STATES)) for s in STATES], 0

    sorted_ = segments_.select("conv_id", "part", "first", "costs").repartition(F.col("conv_id")).sortWithinPartitions("conv_id", F.col("part").desc())
    return _mapped(sorted_, run, "conv_id long, part long, first long, end array<bigint>, last int")


def walks(symbols_: DataFrame, ends_: DataFrame) -> DataFrame:
    """(conv_id, first, to, edits) of each segment: for each state it may be entered in (the first of a conversation only in one), where it is left
    and the edits. Costs to go reach a segment as a row in front of its own."""
    heads = ends_.select("part", F.col("first").alias("pos"), F.lit(0).alias("kind"), "conv_id", F.lit("").alias("initial"), F.lit("").alias("fault"), "end", "last")
    own = symbols_.select(F.shiftright("pos", 33).alias("part"), "pos", F.lit(1).alias("kind"), "conv_id", "initial", "fault", F.lit(None).cast("array<bigint>").alias("end"), F.lit(0).alias("last"))

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        head, held = None, []

        def done() -> Iterator[dict]:
            if head:
                found = [walk(held, s, head["end"], bool(head["last"])) for s in STATES]
                yield {"conv_id": head["conv_id"], "first": head["pos"], "to": [f[0] for f in found], "edits": [f[1] for f in found]}

        for r in rows:
            if r["kind"] == 0:
                yield from done()
                head, held = r, []
            else:
                held.append(kind_of(r))
        yield from done()

    return _mapped(heads.unionByName(own).repartition(F.col("part")).sortWithinPartitions("part", "pos", "kind"), run, "conv_id long, first long, to array<bigint>, edits array<string>")


def sums(segments_: DataFrame, ids: DataFrame) -> DataFrame:
    """gaps, blank, duplicate, truncated and illegal of each conv_id of ids; zeros where it has no rows. A window holds a row for each range at most."""
    w = Window.partitionBy("conv_id").orderBy("part")
    before = F.lag("tail").over(w)
    joint = F.when(before.isNotNull() & ~F.concat(before, "head").isin("su", "ua", "au"), 1).otherwise(0)
    rows = segments_.withColumns({"illegal": F.col("illegal") + joint, "turns": F.col("turns") - F.when(F.lag("high").over(w) == F.col("low"), 1).otherwise(0)})
    totals = rows.groupBy("conv_id").agg((F.max("high") - F.min("low") + 1 - F.sum("turns")).alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")))
    ids = ids.select(F.col("conv_id").alias("_id")).distinct()
    return ids.join(totals, F.col("_id").eqNullSafe(F.col("conv_id")), "left").select(F.col("_id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal")))


def rebuilt(rows: DataFrame, walks_: DataFrame, heads: DataFrame, run: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """run over a stream of rows in order: of each conversation its head (kind 0), and of each segment its walks (kind 1) and then its turns (2)."""
    names = [c for c in heads.columns if c != "conv_id"]
    shape = {"conv_id": "long", "pos": "long", "role": "string", "text": "string", "cut_off": "boolean", "to": "array<bigint>", "edits": "array<string>", **dict.fromkeys(names, "long")}

    def of(df: DataFrame, kind: int, columns: list[str]) -> DataFrame:
        return df.select(*(F.col(c) if c in columns else F.lit(None).cast(t).alias(c) for c, t in shape.items()), F.lit(kind).alias("kind"))

    stream = of(heads, 0, ["conv_id", *names]).unionByName(of(walks_.withColumnRenamed("first", "pos"), 1, ["conv_id", "pos", "to", "edits"]))
    stream = stream.unionByName(of(rows, 2, ["conv_id", "pos", "role", "text", "cut_off"])).repartition(F.col("conv_id"))
    return _mapped(stream.sortWithinPartitions("conv_id", F.col("pos").asc_nulls_first(), "kind"), run, schema)


def applied(stream: Iterator[dict]) -> Iterator[tuple[dict, str, int, str | None, str | None]]:
    """(head, edit, cost, role, text) of each edit, role and text None for a deletion; and (head, "", 0, None, None) first of each conversation."""
    head, state, left = None, 0, iter("")

    def insert() -> tuple[dict, str, int, str, str]:
        nonlocal state
        role, state = ROLE[state], NEXT[state]
        return head, "I", INSERT, role, ""

    for r in stream:
        if r["kind"] < 2:
            for _ in left:  # only insertions are left behind the last turn
                yield insert()
        if r["kind"] == 0:
            head, state, left = r, 0, iter("")
            yield head, "", 0, None, None
        elif r["kind"] == 1:
            left = iter(r["edits"][state])
        else:
            while (edit := next(left)) == "I":
                yield insert()
            stays = TRUNCATED if r["cut_off"] else 0
            if edit == "D":
                yield head, edit, DELETE, None, None
            elif edit == "R":
                role, state = ROLE[state], NEXT[state]
                yield head, edit, REROLE + stays, role, r["text"]
            else:
                state = STEPS[state, r["role"][:1]]
                yield head, edit, stays, r["role"], r["text"]
    for _ in left:
        yield insert()


def _plan(turns: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    folder = shared_dir(turns.sparkSession)
    rows = ordered(turns, folder)
    marks = written(symbols(rows), folder, "symbols")
    parts = written(segments(marks), folder, "segments")
    return rows, written(walks(marks, ends(parts)), folder, "walks"), sums(parts, ids)


def repair(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) as right conversations: conv_id, place (from 0), edit, role, text of each turn that stays or is inserted.

    Turns are taken by turn (nulls first), then role and text; nulls of role and text are one space. Rows with a null conv_id are one conversation.
    Blank turns and repeats of an earlier role and text go; a turn that ends without `.!?` costs 5 if it stays. Other columns are dropped.
    A conversation of any length is worked on range by range; the last step streams it in order, and keeps none of it.
    """
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    rows, walks_, heads = _plan(turns, turns)

    def run(stream: Iterator[dict]) -> Iterator[dict]:
        place = 0
        for head, edit, _, role, text in applied(stream):
            place = 0 if not edit else place
            if role is not None:
                yield {"conv_id": head["conv_id"], "place": place, "edit": edit, "role": role, "text": text}
                place += 1

    return rebuilt(rows, walks_, heads, run, "conv_id long, place long, edit string, role string, text string")


def audited(turns: DataFrame) -> DataFrame:
    """The faults that damaged() plants in turns, and their repair, of each conv_id: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256. Only a conversation's digest, cost and edits grow as its turns stream by; one whose turns all went has zeros and the empty text's digest."""
    rows, walks_, heads = _plan(damaged(turns), turns)
    names = ["conv_id", *(c for c in heads.columns if c != "conv_id")]

    def run(stream: Iterator[dict]) -> Iterator[dict]:
        own, audit, coded, first = None, [], hashlib.sha256(), True
        for head, edit, cost, role, text in applied(stream):
            if not edit:
                if own:
                    yield own | {"audit": "".join(audit), "repaired_sha256": coded.hexdigest()}
                own, audit, coded, first = {c: head[c] for c in names} | {"cost": 0}, [], hashlib.sha256(), True
            audit.append(edit)
            own["cost"] += cost
            if role is not None:
                coded.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        if own:
            yield own | {"audit": "".join(audit), "repaired_sha256": coded.hexdigest()}

    return rebuilt(rows, walks_, heads, run, ", ".join(f"{c} long" for c in [*names, "cost"]) + ", audit string, repaired_sha256 string")
