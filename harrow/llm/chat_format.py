"""Chat formatting: a finite-state machine over roles checks the order of turns, and a declarative template gives text segments with loss flags."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tidied


@dataclass(frozen=True)
class ChatTemplate:
    """How turns are written. Each turn is turn_open, role, text_open, text, turn_close.

    Control strings that occur in roles or texts are escaped: no first character of a control string is left as it
    is, so none can begin inside a text. follows: which roles may come after a role, "" being the start.
    """

    turn_open: str = "<|turn|>"
    text_open: str = "<|text|>"
    turn_close: str = "<|end|>"
    more_controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    loss_roles: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    last_roles: tuple[str, ...] = ("user", "assistant")

    @property
    def codes(self) -> dict[str, str]:
        """Each character that is escaped, the backslash first, and what is written for it."""
        firsts = sorted({c[0] for c in (self.turn_open, self.text_open, self.turn_close, *self.more_controls)} - {"\\"})
        return {"\\": "\\\\"} | {c: f"\\{chr(ord('a') + k)}" for k, c in enumerate(firsts)}

    def escape(self, text: Column) -> Column:
        for plain, code in self.codes.items():
            text = F.replace(text, F.lit(plain), F.lit(code))
        return text

    def unescape(self, text: str) -> str:
        back = {code: plain for plain, code in self.codes.items()}
        return re.sub(r"\\.", lambda m: back[m[0]], text) if "\\" in text else text


def format_conversations(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:  # noqa: B008
    """One row per conversation of turns (conv_id, turn, role, text): formatted, segments, n_turns, valid and first_bad.

    segments: array of (text, role, loss), the formatted string cut into marks and texts; loss is set on the texts of the
    template's loss_roles only. first_bad: position from 0 of the first turn that the role machine refuses, n_turns if the
    conversation ends in a role that it doesn't end with, else null. Refused conversations are formatted all the same.
    Turns go by turn number, then role and text (null numbers first); null roles and texts are empty, repeated rows stay;
    rows without a conv_id are left out. A conversation is one document and so is put together in one task.
    """
    t = template
    rows = turns.filter("conv_id IS NOT NULL").select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("x"))
    rows = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("x"))

    def turn_segments(x: Column) -> Column:
        segment = lambda text, loss: F.struct(text.alias("text"), x["role"].alias("role"), loss.alias("loss"))
        head = F.concat(F.lit(t.turn_open), t.escape(x["role"]), F.lit(t.text_open))
        return F.array(segment(head, F.lit(False)), segment(t.escape(x["text"]), x["role"].isin(*t.loss_roles)), segment(F.lit(t.turn_close), F.lit(False)))

    pairs = F.array(*[F.concat_ws("\x00", F.lit(a), F.lit(b)) for a, bs in t.follows.items() for b in bs])
    before = lambda i: F.when(i == 0, F.lit("")).otherwise(F.get(F.col("x"), i - 1)["role"])
    refused = F.transform("x", lambda x, i: F.when(F.array_contains(pairs, F.concat_ws("\x00", before(i), x["role"])), 0).otherwise(1))
    n = F.size("x")
    bad = F.array_position(refused, 1)
    out = rows.select(
        "conv_id",
        F.flatten(F.transform("x", turn_segments)).alias("segments"),
        n.cast("long").alias("n_turns"),
        F.when(bad > 0, bad - 1).when(~F.element_at("x", -1)["role"].isin(*t.last_roles), n).alias("first_bad"),
    )
    return out.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments", "n_turns", F.col("first_bad").isNull().alias("valid"), "first_bad")


def parse(formatted: str, template: ChatTemplate) -> list[tuple[str, str]]:
    """The (role, text) of each turn, from the formatted string alone."""
    out = []
    for turn in formatted.split(template.turn_open)[1:]:
        role, _, rest = turn.partition(template.text_open)
        out.append((template.unescape(role), template.unescape(rest.removesuffix(template.turn_close))))
    return out


def read_back(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:  # noqa: B008
    """Digests of what the formatted strings and the loss flags say: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
        for batch in batches:
            rows = []
            for conv, text, lost, valid in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                turns = parse(text, template)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(template.unescape(x) for x in lost)
                rows.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text), valid))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()), strict=True)], names)

    lost = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"])
    rows = formatted.select(F.col("conv_id").cast("long"), "formatted", lost.alias("lost"), "valid")
    return rows.mapInArrow(tidied(run), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")
