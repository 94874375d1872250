"""Spans of regular expressions in texts as DataFrame expressions: arrays of (start, end, text), in code points."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY = "array<struct<start:int,end:int,text:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also inside a lambda."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """Leftmost non-overlapping matches; with ``group``, that group's text as ``part`` too.

    The gaps between the matches come from a split at the same pattern, so lengths of gaps and
    matches add up to the positions. Texts without a match, nearly all, cost one search.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    fields = [found.alias("text"), F.split(text, pattern, -1).alias("gap")]
    kind = EMPTY
    if group is not None:
        fields.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))
        kind = "array<struct<start:int,end:int,text:string,part:string>>"

    def extend(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["text"])
        more = [x["part"].alias("part")] if group is not None else []
        span = F.struct(start.alias("start"), end.alias("end"), x["text"].alias("text"), *more)
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    none = F.array().cast(kind)
    # The last gap has no match after it.
    pairs = F.filter(F.arrays_zip(*fields), lambda x: x["text"].isNotNull())
    walked = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("spans")), extend)["spans"]
    return F.when(F.rlike(text, F.lit(pattern)), walked).otherwise(none)


def named(spans: Column, kind: str, order: int) -> Column:
    """Spans as (start, order, end, kind), which sort by start and then by kind as listed."""
    return F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")),
    )


def of_order(spans: Column, order: int) -> Column:
    """The spans of one kind."""
    return F.filter(spans, lambda s: s["order"] == order)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def replaced(text: Column, spans: Column, label: str) -> Column:
    """The text with every span, given in the order of their starts, replaced by ``label``; overlapping spans by one."""
    def cut(state: Column, s: Column) -> Column:
        apart = s["start"] >= state["at"]
        kept = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(apart, F.concat(state["parts"], F.array(kept, F.lit(label)))).otherwise(state["parts"]).alias("parts"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), F.substring(text, state["at"] + 1, F.char_length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, cut, finish)).otherwise(text)
