"""Language-model scores: a pretrained byte context tree, and a word-count base computed beside it.

The words of the corpus are counted without any cap. Looking a count up for every word of every text
would shuffle all words, so the commonest words (a bounded number) are broadcast, and only the rest are
joined, once for each block of documents and not for each document. No key can gather more rows than
there are blocks. The contexts of the tree are kept without any cap too: its tables stay in Spark, the code
lengths of the commonest grams (context and symbol) are broadcast, and all other grams of a block are joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm import ppm
from freshet.llm.heaviest import heaviest
from freshet.llm.scratch import Scratch
from freshet.llm.textbytes import ascii_words, small_batches, text_bytes

ORDER = 5
#: Most contexts of the longest order (each with one symbol) broadcast with their code lengths, and most words
#: with their counts. No result depends on either; what is not broadcast is joined.
MAX_CONTEXTS = 1 << 20
COMMON_WORDS = 1 << 17
#: Distinct words a task holds before it hands on partial counts.
HELD_WORDS = 300_000
#: Uses of grams handed on in one batch.
MOST_USES = 100_000
#: The end of a text is a token of its own; no word is empty.
END = b""


def normalise(text: bytes) -> bytes:
    return b" ".join(ascii_words(text))


def count_words(texts: DataFrame) -> DataFrame:
    """(token binary, n) over a column text; every text adds one END token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["token", "n"])

        for batch in small_batches(batches, 0):
            for text in text_bytes(batch.column(0)):
                held.update(ascii_words(text))
            held[END] += batch.num_rows
            if len(held) > HELD_WORDS:
                yield rows()
                held.clear()
        if held:
            yield rows()

    return texts.select("text").mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def score(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, max_contexts: int = MAX_CONTEXTS, common_words: int = COMMON_WORDS) -> DataFrame:
    """One row per input row: id, in_training, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is the log10 probability of the text as its words, A-Z lower-cased, joined by single blanks, and an
    end symbol. Texts are read whole, in pieces of bounded size; a very long one takes one row of a batch alone.
    ``training`` is a boolean column of ``docs``; null counts as false. Null text is empty: its only token
    is the end. Any number of rows may share an id; each keeps a row of its own. Without training rows
    (or an empty table) every count is 0: base_score is n_tokens * log10(1 / 1) = 0, and the tree has no
    contexts, so a byte costs 8 bits.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    used = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(training, F.lit(False)).alias("in_training"))
    learned = used.where("in_training")
    words = scratch.save(count_words(learned), "words")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("token")).first()
    top = heaviest(words, "n", common_words).toArrow()
    common = dict(zip(top["token"].to_pylist(), top["n"].to_pylist()))
    grams = scratch.save(ppm.count_grams(learned, order, normalise), "grams")
    model = ppm.Levels(grams, order, scratch)
    seen = scratch.save(model.seen(), "seen")
    shared = spark.sparkContext.broadcast((common, _commonest(seen, max_contexts)))
    kind = docs.schema[id_col].dataType.simpleString()
    blocks = scratch.save(used.mapInArrow(_block_rows(shared, order), f"block string, at int, id {kind}, in_training boolean, n_tokens long, known long, base double, score double, token binary, code long, uses array<struct<at:int,n:int>>"), "blocks")
    shared.destroy()

    rare = blocks.where("token is not null").select("block", "token", "uses").join(words, "token")
    rare = rare.select("block", F.explode("uses").alias("use"), F.lit(1).alias("known"), F.log10(F.col("n") + 1.0).alias("base"), F.lit(0.0).alias("bits"))
    others = blocks.where("code is not null").select("block", F.lit("").alias("by"), "code", "uses")
    unseen = scratch.save(others.select("by", "code").distinct().join(seen, ["by", "code"], "left_anti"), "unseen")
    lengths = seen.select("by", "code", "bits").union(model.unseen(unseen))
    others = others.join(lengths, ["by", "code"]).select("block", F.explode("uses").alias("use"), F.lit(0).alias("known"), F.lit(0.0).alias("base"), "bits")
    n = F.col("use.n")
    found = (
        rare.union(others).groupBy("block", F.col("use.at").alias("at"))
        .agg(F.sum(n * F.col("known")).alias("rare_known"), F.sum(n * F.col("base")).alias("rare_base"), F.sum(n * F.col("bits")).alias("rare_bits"))
    )
    whole = math.log10(total + distinct + 1)
    out = (
        blocks.where("at is not null").select("block", "at", "id", "in_training", "n_tokens", "known", "base", "score")
        .join(found, ["block", "at"], "left")
        .select(
            F.col("id").alias(id_col), "in_training", "n_tokens",
            (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
            (F.col("score") - F.coalesce("rare_bits", F.lit(0.0)) * F.lit(math.log10(2))).alias("score"),
        )
    )
    return scratch.finish(out)


def _commonest(seen: DataFrame, most: int) -> ppm.GramTable:
    top = heaviest(seen, "n", most).select("code", "bits", "n").toArrow()
    by_n = np.argsort(top["n"].to_numpy())
    return ppm.GramTable(top["code"].to_numpy().astype(np.uint64)[by_n], top["bits"].to_numpy()[by_n])


def _block_rows(shared, order: int):
    """Of each Arrow batch: a row for every document, and one for every word and gram that is not broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        common, table = shared.value
        logs = {w: math.log10(n + 1.0) for w, n in common.items()}
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(small_batches(batches, 1)):
            block = f"{part}-{number}"
            texts = text_bytes(batch.column(1))
            n_tokens, known, base, rare = [], [], [], {}
            for at, text in enumerate(texts):
                counts = Counter(ascii_words(text))
                counts[END] = 1
                n_tokens.append(sum(counts.values()))
                hits, sums = 0, []
                for word, n in counts.items():
                    log = logs.get(word)
                    if log is None:
                        rare.setdefault(word, []).append((at, n))
                    else:
                        hits += n
                        sums.append(n * log)
                known.append(hits)
                base.append(math.fsum(sums))
            bits, (codes, places, times) = ppm.known_bits(table, (normalise(t) for t in texts), order)
            rows, none = len(texts), pa.nulls
            uses = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * rows), pa.array(range(rows), pa.int32()), batch.column(0), batch.column(2), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(-bits * math.log10(2)), none(rows, pa.binary()), none(rows, pa.int64()), none(rows, uses)],
                names=NAMES,
            )
            if rare:
                lists = list(rare.values())
                flat = [x for y in lists for x in y]
                values = pa.StructArray.from_arrays([pa.array([x[0] for x in flat], pa.int32()), pa.array([x[1] for x in flat], pa.int32())], fields=list(uses.value_type))
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in lists]))), pa.int32())
                yield _rare_rows(block, batch.column(0).type, pa.array(list(rare), pa.binary()), None, pa.ListArray.from_arrays(offsets, values))
            for begin in range(0, len(codes), MOST_USES):
                piece = slice(begin, begin + MOST_USES)
                code, at, n = codes[piece], places[piece], times[piece]
                first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
                values = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(n, pa.int32())], fields=list(uses.value_type))
                offsets = pa.array(np.append(first, len(code)), pa.int32())
                yield _rare_rows(block, batch.column(0).type, None, pa.array(code[first].view(np.int64)), pa.ListArray.from_arrays(offsets, values))

    return run


def _rare_rows(block: str, kind: pa.DataType, tokens: pa.Array | None, codes: pa.Array | None, uses: pa.Array) -> pa.RecordBatch:
    n = len(uses)
    kinds = [pa.int32(), kind, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    keys = [pa.nulls(n, pa.binary()) if tokens is None else tokens, pa.nulls(n, pa.int64()) if codes is None else codes]
    return pa.RecordBatch.from_arrays([pa.array([block] * n, pa.string()), *[pa.nulls(n, k) for k in kinds], *keys, uses], names=NAMES)


NAMES = ["block", "at", "id", "in_training", "n_tokens", "known", "base", "score", "token", "code", "uses"]
