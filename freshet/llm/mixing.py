"""Temperature mixing of sources, realised as block permutations within token budgets.

Weights are source shares to a power, normalised; the power is bisected until the weights are as even as
asked (entropy) without any source being repeated too often. Documents are dealt by hash to blocks of
about equal tokens, or of a bounded number of documents where most are empty. A source gives all its blocks once for every whole repetition that its weight buys, and
for the rest a beginning of a permutation of its blocks; the block in which the budget ends gives the
beginning of a permutation of its documents. Only sums by source and by block are ever brought together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.scratch import Scratch

#: Entropy of the weights as a share of the most possible, most repetitions of a source, tokens to draw as a
#: share of those there are, tokens of a block, and its documents where these have few tokens.
EVENNESS, MAX_REPEATS, BUDGET, BLOCK_TOKENS, BLOCK_ROWS = 0.95, 4.0, 1.0, 1 << 20, 1 << 16
#: Most sources (their sums go to the driver), most blocks that are broadcast.
MAX_SOURCES, MAX_BLOCKS = 200_000, 200_000
STEPS = 60
#: Parts (2 ** bits) of a source's permutation of blocks; a task orders the blocks of one part.
RANGE_BITS = 10


@dataclass(frozen=True)
class Mix:
    evenness: float = EVENNESS
    max_repeats: float = MAX_REPEATS
    budget: float = BUDGET
    block_tokens: int = BLOCK_TOKENS
    block_rows: int = BLOCK_ROWS
    seed: str = "mix"


def weights_at(tokens: list[int], power: float) -> list[float]:
    whole = sum(tokens)
    raw = [(t / whole) ** power for t in tokens]
    total = math.fsum(raw)
    return [x / total for x in raw]


def solve_power(tokens: list[int], mix: Mix) -> float:
    """The largest power up to 1 with enough entropy; more if some source were repeated too often."""
    if not tokens:
        return 1.0
    whole = sum(tokens)

    def even(power: float) -> bool:
        return -math.fsum(w * math.log(w) for w in weights_at(tokens, power) if w) >= mix.evenness * math.log(len(tokens)) - 1e-12

    def repeats(power: float) -> bool:
        return max(w * mix.budget * whole / t for w, t in zip(weights_at(tokens, power), tokens)) <= mix.max_repeats

    low, high = 0.0, 1.0
    if even(1.0):
        low = 1.0
    else:
        for _ in range(STEPS):
            mid = (low + high) / 2
            low, high = (mid, high) if even(mid) else (low, mid)
    if repeats(low):
        return low
    high = 1.0
    for _ in range(STEPS):
        mid = (low + high) / 2
        low, high = (low, mid) if repeats(mid) else (mid, high)
    return high


def _place(*parts: Column) -> Column:
    """A hash of 60 bits that other engines can repeat."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def count_tokens(text: Column) -> Column:
    """Runs of other than [\\x20\\x09-\\x0D]: each run and the blanks after it become one letter."""
    return F.length(F.regexp_replace(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")).cast("long")


def mixed(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with n_tokens, weight, copies and block; copies says how often a document is drawn.

    A token is a run of other than [\\x20\\x09-\\x0D]. A null source counts as the source ''. Null or empty
    texts have no tokens: they are drawn with their block like others and use no budget; a source without any
    tokens has weight 0 and copies 0. Equal rows are drawn together. A text longer than a block is a block of its
    own size and is drawn whole or not at all. An empty table stays empty. The four new columns replace columns
    of those names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    tagged = docs.withColumns({
        "n_tokens": count_tokens(text),
        "_source": F.coalesce(F.col(source_col).cast("string"), F.lit("")),
        "_place": _place(F.lit(mix.seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text)),
    })
    scratch = Scratch(docs.sparkSession)
    narrow = scratch.save(tagged.select("_source", "_place", "n_tokens"), "narrow")
    sums = narrow.groupBy("_source").agg(F.sum("n_tokens").alias("tokens"), F.count("n_tokens").alias("rows")).limit(MAX_SOURCES + 1).collect()
    if len(sums) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sums = sorted((r["_source"], r["tokens"], r["rows"]) for r in sums if r["tokens"])
    tokens = [t for _, t, _ in sums]
    power = solve_power(tokens, mix)
    rows = []
    for (source, have, many), weight in zip(sums, weights_at(tokens, power) if tokens else []):
        whole, rest = divmod(round(weight * mix.budget * sum(tokens)), have)  # whole tokens: a share of 1 is 1
        rows.append((source, round(weight, 9), whole, rest, max(-(-have // mix.block_tokens), -(-many // mix.block_rows))))
    plan = F.broadcast(docs.sparkSession.createDataFrame(rows, "_source string, weight double, whole long, rest long, _blocks long"))

    blocked = narrow.join(plan, "_source").withColumn("block", F.pmod("_place", "_blocks"))
    blocks = blocked.groupBy("_source", "block", "rest").agg(F.sum("n_tokens").alias("tokens"))
    # Running sums of a source's permuted blocks: over RANGES parts of the permutation, then within each.
    blocks = scratch.save(blocks.withColumn("_turn", _place(F.lit(mix.seed), F.col("_source"), F.col("block").cast("string"))).withColumn("_range", F.shiftright("_turn", 60 - RANGE_BITS)), "permuted")
    ranges = blocks.groupBy("_source", "_range").agg(F.sum("tokens").alias("_tokens"))
    ranges = ranges.select("_source", "_range", (F.sum("_tokens").over(Window.partitionBy("_source").orderBy("_range")) - F.col("_tokens")).alias("_before"))
    order = Window.partitionBy("_source", "_range").orderBy("_turn", "block")
    blocks = blocks.join(ranges, ["_source", "_range"]).withColumn("before", F.col("_before") + F.sum("tokens").over(order) - F.col("tokens"))
    blocks = blocks.where("before < rest or tokens = 0").withColumn("room", F.col("rest") - F.col("before")).select("_source", "block", "room", (F.col("room") >= F.col("tokens")).alias("all"))
    blocks = scratch.save(blocks, "blocks")
    small = blocks.limit(MAX_BLOCKS + 1).count() <= MAX_BLOCKS
    cut_blocks = blocks.where("not all").select("_source", "block", "room")
    within = Window.partitionBy("_source", "block").orderBy("_place").rangeBetween(Window.unboundedPreceding, 0)
    cut = blocked.join(F.broadcast(cut_blocks) if small else cut_blocks, ["_source", "block"]).withColumn("used", F.sum("n_tokens").over(within))
    cut = cut.where("used <= room").groupBy("_source", "block").agg(F.max("_place").alias("_last"))
    drawn = blocks.join(cut, ["_source", "block"], "left").select(F.col("_source").alias("_s"), F.col("block").alias("_block"), "all", "_last")
    drawn = scratch.finish(drawn)
    out = tagged.drop("weight", "copies", "block").join(plan, "_source", "left").withColumn("block", F.pmod("_place", "_blocks"))
    same = (F.col("_s") == F.col("_source")) & (F.col("_block") == F.col("block"))
    out = out.join(F.broadcast(drawn) if small else drawn, same, "left")
    more = F.when(F.col("all") | (F.col("_place") <= F.col("_last")), 1).otherwise(0)
    return out.withColumns({"weight": F.coalesce("weight", F.lit(0.0)), "copies": (F.coalesce("whole", F.lit(0)) + more).cast("long")}).drop("_source", "_place", "whole", "rest", "_blocks", "_s", "_block", "all", "_last")
