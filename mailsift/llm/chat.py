"""Chat formatting from a declarative template, DataFrame functions only.

A conversation is its rows in turn order. A finite-state machine over the
roles says whether the order is valid and where it first goes wrong; the
formatted text is a list of segments, marks and texts, each with a loss flag.

Control strings that stand inside a text or role are escaped: the escape sign
is doubled, and one is put after the first character of each control string,
so no mark can be forged and ``unescape`` gives back the exact text.

Rows are first gathered in blocks of up to ``BLOCK`` turns; a block carries its
segments and the machine's map from every state to the state after it, and the
blocks of a conversation are composed. Only the formatted conversation itself
is ever whole in one row.

Defined results: a null text or role is empty; turns that are null come first
and equal turns are ordered by role and text; roles that the template does not
name are formatted as they are and make the order invalid; a null conversation
id is one conversation; an empty table gives no rows. The rows' other columns
are not read, and results are in columns of their own names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"
BLOCK = 256
TEMPLATE = {
    "open": "<|im_start|>", "role_end": "<|im_sep|>", "close": "<|im_end|>\n",
    "loss": ("assistant",),
    # state -> role -> next state; "start" is the first state
    "order": {"start": {"system": "system", "user": "user"},
              "system": {"user": "user"},
              "user": {"assistant": "assistant"},
              "assistant": {"user": "user"}},
    "final": ("assistant",),
    # strings that must not appear inside a text: own marks and common ones
    "control": ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]",
                "<<SYS>>", "<</SYS>>"),
}


def escape(text: Column, template: dict = TEMPLATE) -> Column:
    parts = [f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in template["control"]]
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.regexp_replace(doubled, "(" + "|".join(parts) + ")", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _machine(template: dict) -> tuple[list[str], int, Column]:
    """States, the bad state's number, and the transition map ``"state role" -> state``."""
    states = list(template["order"])
    bad = len(states)
    moves = [(f"{states.index(s)} {role}", states.index(to))
             for s, by_role in template["order"].items() for role, to in by_role.items()]
    return states, bad, F.create_map(*[F.lit(x) for pair in moves for x in pair])


def format_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text",
                         template: dict = TEMPLATE) -> DataFrame:
    """One row per conversation: ``segments (text, loss)``, ``n_turns``, ``valid_order``, ``bad_turn``.

    ``bad_turn`` is the number (from 0) of the first turn that the machine does
    not allow, null if there is none; ``valid_order`` also asks for a final state.
    """
    states, bad, moves = _machine(template)
    known = sorted({r for by_role in template["order"].values() for r in by_role})
    clean = rows.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("block", F.floor(F.col("turn") / BLOCK))
    step = lambda s, t: F.when(t["role"].isin(*known),
                               F.coalesce(F.element_at(moves, F.concat_ws(" ", s, t["role"])),
                                          F.lit(bad))).otherwise(F.lit(bad))
    flag = lambda t: t["role"].isin(*template["loss"])
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        segment(F.concat(F.lit(template["open"]), escape(t["role"], template),
                         F.lit(template["role_end"])), no),
        segment(escape(t["text"], template), flag(t)),
        segment(F.lit(template["close"]), no))))
    # From each state: the state after the block, and how many turns went well.
    walked = [F.aggregate("turns", F.struct(F.lit(s).alias("at"), F.lit(0).alias("good")),
                          lambda acc, t: F.struct(
                              step(acc["at"], t).alias("at"),
                              (acc["good"] + F.when(step(acc["at"], t) == bad, 0).otherwise(1))
                              .alias("good"))) for s in range(bad + 1)]
    blocks = (clean.groupBy("conv_id", "block")
              .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
              .select("conv_id", "block", F.size("turns").alias("n"), segments.alias("segments"),
                      F.array(*walked).alias("walk")))
    whole = (blocks.groupBy("conv_id")
             .agg(F.array_sort(F.collect_list(F.struct(
                 F.coalesce("block", F.lit(-(2 ** 62))).alias("block"), "n", "segments", "walk")))
                 .alias("blocks")))
    start = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("good"))
    end = F.aggregate("blocks", start, lambda acc, b: F.struct(
        F.element_at(b["walk"], acc["at"] + 1)["at"].alias("at"),
        (acc["good"] + F.element_at(b["walk"], acc["at"] + 1)["good"]).alias("good")))
    final = [states.index(s) for s in template["final"]]
    n = F.aggregate("blocks", F.lit(0).cast("long"), lambda acc, b: acc + b["n"])
    return (whole.withColumn("end", end).select(
        "conv_id", n.alias("n_turns"),
        F.flatten(F.transform("blocks", lambda b: b["segments"])).alias("segments"),
        F.col("end.at").isin(*final).alias("valid_order"),
        F.when(F.col("end.at") == bad, F.col("end.good")).alias("bad_turn")))


def formatted_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_back(text: Column, template: dict = TEMPLATE) -> Column:
    """``array<struct<role, text>>`` from a formatted conversation."""
    parts = F.split(text, re.escape(template["close"]))
    skip = len(template["open"]) + 1

    def turn(part: Column) -> Column:
        body = F.substring(part, skip, F.length(part))
        cut = F.instr(body, template["role_end"])
        width = len(template["role_end"])
        return F.struct(unescape(F.substring(body, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substring(body, cut + width, F.length(body))).alias("text"))

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)
