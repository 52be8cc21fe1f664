"""Language identification: the language whose frozen context tree codes the text in the fewest bits.

All languages are trained, and no context is dropped: the trees are Spark tables. Texts meet the languages
in groups. For each group the code lengths of the commonest grams are broadcast, with a column for each
language, and the other grams of a block of texts are joined; the best language and the sum of the
probabilities are carried from group to group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm import ppm
from freshet.llm.heaviest import heaviest
from freshet.llm.scratch import Scratch
from freshet.llm.textbytes import small_batches

ORDER = 3
#: Most grams of which a group's code lengths are broadcast, and languages of a group. No result depends on either.
MAX_CONTEXTS = 1 << 18
GROUP = 16


def normalise(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def train(labelled: DataFrame, order: int = ORDER, max_contexts: int = MAX_CONTEXTS) -> dict:
    """The trees of all languages as tables, from columns text and lang; rows with a null in either are not used.
    Repeated rows count each time; texts of any length are counted whole, in pieces of bounded size."""
    labelled = labelled.where("text is not null and lang is not null").select("text", "lang")
    scratch = Scratch(labelled.sparkSession)
    shares = scratch.save(labelled.groupBy("lang").count(), "shares")
    grams = scratch.save(ppm.count_grams(labelled, order, normalise, by="lang"), "grams")
    levels = ppm.Levels(grams, order, scratch, many=True)
    seen = scratch.save(levels.seen(), "seen")
    counts = {r["lang"]: r["count"] for r in shares.collect()}
    return {"langs": sorted(counts), "counts": counts, "levels": levels, "seen": seen, "most": max_contexts, "scratch": scratch}


def close(model: dict) -> None:
    """Deletes the tables of a model that is no longer needed."""
    model["scratch"].close()


def _lengths(codes: DataFrame, langs: DataFrame, model: dict) -> DataFrame:
    """(code, bits), bits an array by place of the language, of distinct codes."""
    wanted = codes.select("code").crossJoin(F.broadcast(langs)).withColumnRenamed("lang", "by")
    met = wanted.join(model["seen"].select("by", "code", "bits"), ["by", "code"], "left")
    known = met.where("bits is not null").select("by", "code", "bits")
    each = known.union(model["levels"].unseen(met.where("bits is null").select("by", "code"))).join(F.broadcast(langs.withColumnRenamed("lang", "by")), "by")
    placed = each.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("place", "bits"))).alias("all"))
    return placed.select("code", F.col("all.bits").alias("bits"))


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """One row per input row: id, lang_pred, score (posterior probability among all languages). Null text, or
    text without a letter, gives ``und`` and score 0; equal code lengths go to the first language by name;
    an empty table gives no rows. Very long texts are coded whole. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    langs, total = model["langs"], sum(model["counts"].values())
    if not langs:
        return scratch.finish(rows.select(F.col("id").alias(id_col), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score")))
    if len(langs) > group:
        rows = scratch.save(rows, "rows")
    parts = []
    for begin in range(0, len(langs), group):
        own = langs[begin : begin + group]
        parts.append(_group_best(rows, own, [np.log2(total / model["counts"][x]) for x in own], model, scratch, f"group{begin}"))
    best = parts[0]
    if len(parts) > 1:
        for part in parts[1:]:
            best = best.union(part)
        best = best.groupBy("row").agg(
            F.first("id").alias("id"), F.first("lettered").alias("lettered"), F.min(F.struct("least", "lang")).alias("top"), F.collect_list(F.struct("least", "mass")).alias("all")
        )
        mass = F.aggregate("all", F.lit(0.0), lambda s, x: s + x["mass"] * F.pow(F.lit(2.0), F.col("top.least") - x["least"]))
        best = best.select("id", "lettered", F.col("top.lang").alias("lang"), mass.alias("mass"))
    score = F.when(F.col("lettered"), 1 / F.col("mass")).otherwise(F.lit(0.0))
    return scratch.finish(best.select(F.col("id").alias(id_col), F.when(F.col("lettered"), F.col("lang")).otherwise(F.lit("und")).alias("lang_pred"), score.alias("score")))


def _group_best(rows: DataFrame, own: list[str], prior: list[float], model: dict, scratch: Scratch, name: str) -> DataFrame:
    """(row, id, lettered, least, lang, mass): the fewest bits, their language, and the sum of 2^(least - bits)."""
    spark = rows.sparkSession
    langs = spark.createDataFrame([(x, i) for i, x in enumerate(own)], "lang string, place int")
    codes = model["seen"].where(F.col("by").isin(own)).groupBy("code").agg(F.sum("n").alias("n"))
    common = heaviest(codes, "n", max(1, model["most"] // len(own)))
    top = _lengths(common, langs, model).select("code", "bits").toArrow()
    codes = top["code"].to_numpy().astype(np.uint64)
    bits = top["bits"].combine_chunks().flatten().to_numpy().astype(np.float32).reshape(-1, len(own))
    by_code = np.argsort(codes)
    order = model["levels"].order
    shared = spark.sparkContext.broadcast((codes[by_code], bits[by_code], order))
    kind = rows.schema["id"].dataType.simpleString()
    blocks = rows.mapInArrow(_block_rows(shared), f"row long, id {kind}, lettered boolean, bits array<double>, code long, uses array<struct<at:long,n:int>>")
    blocks = scratch.save(blocks, name)
    shared.destroy()
    rare = blocks.where("code is not null").select("code", "uses")
    lengths = _lengths(rare.select("code").distinct(), langs, model)
    each = rare.join(lengths, "code").select(F.explode("uses").alias("use"), "bits")
    found = each.groupBy(F.col("use.at").alias("row")).agg(F.array(*[F.sum(F.col("use.n") * F.col("bits")[i]) for i in range(len(own))]).alias("more"))
    sums = F.zip_with(F.zip_with("bits", F.coalesce("more", F.array_repeat(F.lit(0.0), len(own))), lambda a, b: a + b), F.array(*[F.lit(float(x)) for x in prior]), lambda a, b: a + b)
    whole = blocks.where("row is not null").select("row", "id", "lettered", "bits").join(found, "row", "left").select("row", "id", "lettered", sums.alias("bits"))
    whole = whole.withColumn("least", F.array_min("bits"))
    lang = F.element_at(F.array(*[F.lit(x) for x in own]), F.array_position("bits", F.col("least")).cast("int"))
    mass = F.aggregate("bits", F.lit(0.0), lambda s, b: s + F.pow(F.lit(2.0), F.col("least") - b))
    return whole.select("row", "id", "lettered", "least", lang.alias("lang"), mass.alias("mass"))


def _block_rows(shared):
    """Of each Arrow batch: a row for every text, and one for every gram that is not broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, bits, order = shared.value
        table = ppm.GramTable(codes, bits)
        use = pa.struct([("at", pa.int64()), ("n", pa.int32())])
        for batch in small_batches(batches, 2, 4 << 20):
            texts = batch.column(2).to_pylist()
            lettered = [bool(t) and any(map(str.isalpha, t)) for t in texts]
            coded = (normalise(t.encode()) if ok else b"" for t, ok in zip(texts, lettered))
            sums, (rare, places, times) = ppm.known_bits(table, coded, order)
            n, width = len(texts), bits.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(sums.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lettered, pa.bool_()), lists, pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(use))], names=NAMES)
            if len(rare):
                first = np.flatnonzero(np.append(True, rare[1:] != rare[:-1]))
                at = batch.column(0).to_numpy()[places]
                uses = pa.StructArray.from_arrays([pa.array(at, pa.int64()), pa.array(times, pa.int32())], fields=list(use))
                uses = pa.ListArray.from_arrays(pa.array(np.append(first, len(rare)), pa.int32()), uses)
                m = len(first)
                none = [pa.nulls(m, pa.int64()), pa.nulls(m, batch.column(1).type), pa.nulls(m, pa.bool_()), pa.nulls(m, lists.type)]
                yield pa.RecordBatch.from_arrays([*none, pa.array(rare[first].view(np.int64)), uses], names=NAMES)

    return run


NAMES = ["row", "id", "lettered", "bits", "code", "uses"]
