"""Secret scans with DataFrame functions only.

Three patterns give base spans. Long runs of key characters that no base span covers are candidates: a
window slides over each, the sum behind its entropy is updated by the counts of the character that comes
and the one that goes, and a candidate whose most disordered window exceeds the limit of its character
class is a span too, unless the allow-list holds it. Work grows with the length of a text, however many
hits it has and however long a run is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.columns import filled, free_name, let, pattern_spans

ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
KINDS = ("assign", "access", "hex", "entropy")
#: Characters a window holds; bits a window of hexadecimal digits, or of any key characters, must exceed.
WIDTH = 20
HEX_BITS = 3.0
KEY_BITS = 3.7
#: Candidates that are no secrets: words without digits, numbers, UUIDs.
ALLOWED = (
    r"^[A-Za-z+/_=-]*$",
    r"^[0-9+/_=-]*$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
)
#: A run that holds one of these is read part by part; only the parts that hold one are placeholders.
PLACEHOLDER = r"(?i)example|sample|placeholder|dummy|abcdefgh|01234567"
PART = r"[A-Za-z0-9+]{20,}"
#: Sums behind entropies are whole numbers of this fraction, so that a long run gathers no rounding errors.
UNIT = 1 << 40


def window_bits(key: Column, width: int = WIDTH, enough: Column | None = None) -> Column:
    """Largest Shannon entropy (bits a character) of the ``width``-character windows of a key; 0 for a shorter
    key. Windows after the first that exceeds ``enough`` are not looked at."""
    weight = F.array(*[F.lit(round(n * math.log2(n) * UNIT) if n else 0).cast("long") for n in range(width + 2)])

    def best(letters: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            held = F.slice(letters, F.greatest(i - width, F.lit(1)), F.least(i - 1, F.lit(width)))
            come, go = F.get(letters, i - 1), F.get(letters, i - 1 - width)
            n_go = F.size(held) - F.size(F.array_remove(held, go))
            n_come = F.size(held) - F.size(F.array_remove(held, come)) - F.when(come == go, 1).otherwise(0)
            gone = F.when(i > width, F.get(weight, n_go - 1) - F.get(weight, n_go)).otherwise(F.lit(0).cast("long"))
            total = state["total"] + gone + F.get(weight, n_come + 1) - F.get(weight, n_come)
            moved = F.struct(total.alias("total"), F.when(i >= width, F.least(state["least"], total)).otherwise(state["least"]).alias("least"))
            return moved if enough is None else F.when(bits(state["least"]) > enough, state).otherwise(moved)

        def bits(least: Column) -> Column:
            return F.greatest(math.log2(width) - least / F.lit(float(width * UNIT)), F.lit(0.0))

        start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(1 << 60).cast("long").alias("least"))
        return F.aggregate(F.sequence(F.lit(1), F.size(letters)), start, step, lambda s: bits(s["least"]))

    return F.when(F.length(key) >= width, let(F.split(key, ""), best)).otherwise(F.lit(0.0))


def entropy_spans(candidates: Column, allowed=ALLOWED) -> Column:
    """Those of the spans whose key is disordered enough and not allowed."""

    def parts(x: Column) -> Column:
        inner = F.transform(pattern_spans(x["hit"], PART, 3), lambda p: F.struct((p["start"] + x["start"]).alias("start"), p["rank"].alias("rank"), (p["end"] + x["start"]).alias("end"), p["hit"].alias("hit")))
        return F.when(x["hit"].rlike(PLACEHOLDER), inner).otherwise(F.array(x))

    def keep(x: Column) -> Column:
        key = x["hit"]
        listed = key.rlike(PLACEHOLDER)
        for pattern in allowed:
            listed = listed | key.rlike(pattern)
        limit = F.when(key.rlike("^[0-9a-fA-F]+$"), HEX_BITS).otherwise(KEY_BITS)
        return F.when(listed, F.lit(False)).otherwise(let(limit, lambda enough: window_bits(key, enough=enough) > enough))

    return F.filter(F.flatten(F.transform(candidates, parts)), keep)


def scan(docs: DataFrame, text_col: str = "text", allowed=ALLOWED) -> DataFrame:
    """``docs`` with base_spans and all_spans, arrays of (start, rank, end, hit) by start, then kind.

    Null and empty text has no spans. Very long texts and runs are read whole, in time in proportion to their
    length. Every input row keeps its columns, equal rows included; only columns named base_spans and all_spans
    are replaced. An empty table stays empty.
    """
    masked, candidates = free_name(docs, "masked"), free_name(docs, "candidates")
    text = F.coalesce(F.col(text_col), F.lit(""))
    assigned = pattern_spans(text, ASSIGN, 0, lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 1)) >= 8)
    access = pattern_spans(text, ACCESS, 1, lambda hit: F.length(hit) >= 16)
    hexes = pattern_spans(text, HEX, 2)
    found = docs.withColumn("base_spans", F.array_sort(F.concat(assigned, access, hexes)))
    blank = filled(text, F.col("base_spans"), lambda new, length: F.repeat(F.lit(" "), length))
    found = found.withColumn(masked, F.when(F.size("base_spans") > 0, blank).otherwise(text))
    found = found.withColumn(candidates, pattern_spans(F.col(masked), CANDIDATE, 3))
    added = F.when(F.size(candidates) > 0, entropy_spans(F.col(candidates), allowed))
    return found.withColumn("all_spans", F.array_sort(F.concat("base_spans", F.coalesce(added, F.expr("slice(base_spans, 1, 0)"))))).drop(masked, candidates)


def span_text(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[secret]", allowed=ALLOWED) -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by ``mask``; spans that overlap or touch become one mask.
    Null text stays null and empty text empty; very long texts are read whole; repeated rows stay; columns are those of
    ``docs``, whatever their names; an empty table stays empty."""
    found = scan(docs, text_col, allowed)
    masked = filled(F.col(text_col), F.col("all_spans"), lambda new, length: F.when(new, F.lit(mask)).otherwise(""))
    return found.withColumn(text_col, F.when(F.size("all_spans") > 0, masked).otherwise(F.col(text_col))).select(*docs.columns)
