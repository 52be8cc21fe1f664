"""Column helpers of the operators that use DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements that a fold gathers before it starts a new array; characters of a block of text.
CHUNK, BLOCK = 256, 4096


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Running totals (array<int>, from 0) of an array<int>.

    A fold that appends copies its array at every step, so the fold goes over chunks and over chunk totals.
    """

    def fold(xs: Column) -> Column:
        return F.aggregate(xs, F.array(F.lit(0)), lambda s, x: F.concat(s, F.array(add(F.element_at(s, -1), x))))

    def joined(parts: Column) -> Column:
        before = fold(F.transform(parts, lambda p: F.element_at(p, -1)))
        return F.flatten(F.zip_with(parts, F.slice(before, 1, F.size(parts)), lambda p, o: F.transform(F.slice(p, 2, F.size(p)), lambda x: add(o, x))))

    def chunks(xs: Column) -> Column:
        return let(F.transform(F.sequence(F.lit(1), F.size(xs), F.lit(CHUNK)), lambda i: fold(F.slice(xs, i, CHUNK))), joined)

    return let(values, lambda xs: F.when(F.size(xs) > 0, chunks(xs)).otherwise(F.array().cast("array<int>")))


def cut(blocks: Column, a: Column, b: Column) -> Column:
    """Characters a to b (counted from 0, b not included) of a text that is given in blocks of BLOCK characters."""
    i, j = F.floor(a / BLOCK).cast("int"), F.floor(b / BLOCK).cast("int")
    head = F.coalesce(F.get(blocks, i), F.lit(""))
    within = F.substring(head, a % BLOCK + 1, b - a)
    across = F.concat(F.substring(head, a % BLOCK + 1, F.lit(BLOCK)), F.array_join(F.slice(blocks, i + 2, F.greatest(j - i - 1, F.lit(0))), ""), F.substring(F.coalesce(F.get(blocks, j), F.lit("")), F.lit(1), b % BLOCK))
    return F.when(i == j, within).otherwise(across)


def filled(text: Column, spans: Column, fill: Callable[[Column, Column], Column]) -> Column:
    """``text`` with every span replaced by ``fill(new, length)``.

    ``spans`` is an array of structs with start and end in characters, by start. Of spans that overlap or
    touch the first is ``new``; ``length`` is what a span covers beyond those before it.
    """

    def whole(parts: Column, blocks: Column) -> Column:
        pieces = F.transform(parts, lambda p, n: F.concat(F.when(p["start"] > p["before"], cut(blocks, p["before"], p["start"])).otherwise(""), fill((n == 0) | (p["start"] > p["before"]), F.greatest(p["end"] - F.greatest(p["start"], p["before"]), F.lit(0)))))
        last = F.greatest(F.element_at(parts, -1)["before"], F.element_at(parts, -1)["end"])
        return F.concat(F.array_join(pieces, ""), cut(blocks, last, F.length(text)))

    ends = running(F.transform(spans, lambda s: s["end"]), F.greatest)
    before = let(ends, lambda e: F.concat(F.array(F.lit(0)), F.slice(e, 1, F.size(e) - 1)))
    parts = F.zip_with(spans, before, lambda s, b: F.struct(b.alias("before"), s["start"].alias("start"), s["end"].alias("end")))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, let(blocks, lambda b: let(parts, lambda p: whole(p, b)))).otherwise(text)


def pattern_spans(text: Column, pattern: str, rank: int, keep=None) -> Column:
    """array<struct<start, rank, end, hit>> of the leftmost non-overlapping matches that ``keep`` accepts.

    Places are code points from 0; they follow from the lengths of the matches and of the pieces between.
    """
    pairs = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda hits: F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(hits)), hits, lambda p, h: F.struct((F.length(p) + F.length(h)).alias("step"), h.alias("hit"))),
    )

    def placed(x: Column) -> Column:
        ends = running(F.transform(x, lambda p: p["step"]), lambda a, b: a + b)
        return F.zip_with(x, ends, lambda p, e: F.struct((e - F.length(p["hit"])).alias("start"), F.lit(rank).alias("rank"), e.alias("end"), p["hit"].alias("hit")))

    spans = let(pairs, placed)
    if keep is not None:
        spans = F.filter(spans, lambda s: keep(s["hit"]))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast("array<struct<start:int,rank:int,end:int,hit:string>>"))
