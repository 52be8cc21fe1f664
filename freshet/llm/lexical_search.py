"""Ranked lexical search by pipelined term partitioning.

Documents are numbered in blocks of bounded size, and each block is inverted: a row a term, with the places, counts
and lengths of its documents. The terms of all items belong to a few owners, bands of falling weight. Items travel in
bundles, one for every block, past the owners, the rarest terms first. At each owner a bundle meets the postings of its
block by cogroup, adds their integer contributions to sparse accumulators of documents, and goes on.

Between owners a histogram of the best partial sums gives every item a score that ``most`` documents have for sure.
Accumulators that cannot reach it with all that the later owners might add are dropped, which changes no result.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.scratch import Scratch
from freshet.llm.textbytes import byte_batches, text_bytes

#: Documents of a block and bytes of their texts, items of a bundle, owners.
BLOCK_ROWS, BLOCK_BYTES, BUNDLE, OWNERS = 8192, 16 << 20, 256, 4
#: Most terms of all items, and bytes of them, that are broadcast to leave other terms out before the shuffle; most
#: items, and pairs of item and term, that are broadcast to joins. What is beyond is joined; no result depends on it.
MAX_TERMS, MAX_TERM_BYTES, MAX_ITEMS, MAX_PAIRS = 1 << 18, 8 << 20, 1 << 18, 1 << 20
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
HELD = "array<struct<item:bigint,at:array<int>,score:array<bigint>>>"


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_FOLD).split()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_batches(batches, 1, BLOCK_BYTES):
        found = [sorted(set(terms_of(t))) for t in text_bytes(batch.column(1))]
        items = batch.column(0).take(pa.array(np.repeat(np.arange(len(found)), list(map(len, found)))))
        yield pa.RecordBatch.from_arrays([items, pa.array([t for x in found for t in x], pa.binary())], names=["item", "term"])


def _inverted(shared, block_rows: int):
    """Of each block: a row with its documents by rising id (null last), and a row for every term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known = shared.value if shared else None
        block = TaskContext.get().partitionId() << 32
        for whole in byte_batches(batches, 1, BLOCK_BYTES):
            for begin in range(0, whole.num_rows, block_rows):
                batch = whole.slice(begin, block_rows)
                order = pc.sort_indices(batch.column(0), null_placement="at_end")
                ids, lengths, number, met, tf, sizes = batch.column(0).take(order), [], {}, array("i"), array("i"), []
                for text in text_bytes(batch.column(1).take(order)):
                    words = terms_of(text)
                    lengths.append(len(words))
                    counts = Counter(words)
                    own = list(counts) if known is None else list(known.intersection(counts))
                    met.extend([number.setdefault(term, len(number)) for term in own])
                    tf.extend([counts[term] for term in own])
                    sizes.append(len(own))
                rows = batch.num_rows
                ints = pa.list_(pa.int32())
                head = [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, rows], pa.int32()), ids), pa.array([lengths], ints), *[pa.nulls(1, k) for k in (pa.binary(), ints, ints, ints)]]
                yield pa.RecordBatch.from_arrays(head, names=NAMES)
                if number:
                    term = np.frombuffer(met, np.int32)
                    by_term = np.argsort(term, kind="stable")
                    columns = [np.repeat(np.arange(rows, dtype=np.int32), sizes), np.frombuffer(tf, np.int32), np.repeat(np.array(lengths, np.int32), sizes)]
                    n = len(number)
                    cuts = pa.array(np.concatenate(([0], np.cumsum(np.bincount(term, minlength=n)))), pa.int32())
                    lists = [pa.ListArray.from_arrays(cuts, pa.array(x[by_term])) for x in columns]
                    yield pa.RecordBatch.from_arrays([pa.array([block] * n, pa.int64()), pa.nulls(n, pa.list_(ids.type)), pa.nulls(n, ints), pa.array(list(number), pa.binary()), *lists], names=NAMES)
                block += 1

    return run


NAMES = ["block", "ids", "lengths", "term", "at", "tf", "n"]


def scaled_lengths(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """m of documents of ``n`` terms: 100 - 50 + (50 * n * docs) div total, exact for any size."""
    if 50 * docs * int(n.max(initial=0)) >= 1 << 63:
        return np.array([50 + 50 * int(x) * docs // total for x in n], np.int64)
    return 50 + 50 * n.astype(np.int64) * docs // total


def _owner(docs: int, total: int, most: int, last: bool):
    """A bundle at an owner: what its items have found in a block, with the owner's postings of that block added."""

    def run(key, bundle: pa.Table, postings: pa.Table) -> pa.Table:
        facts = bundle.column("facts").combine_chunks().flatten()
        items, rest, bound = (facts.field(k).to_numpy(zero_copy_only=False) for k in ("item", "rest", "bound"))
        row = {item: k for k, item in enumerate(items.tolist())}
        size = bundle.column("docs")[0].as_py()
        sums = np.zeros((len(items), size), np.int64)
        held = bundle.column("held").combine_chunks().flatten()
        for item, at, score in zip(held.field("item").to_pylist(), held.field("at"), held.field("score")):
            sums[row[item], at.values.to_numpy()] = score.values.to_numpy()
        at, tf, n = (postings.column(k).combine_chunks().flatten().to_numpy() for k in ("at", "tf", "n"))
        tf = tf.astype(np.int64)
        gain = 1_000_000_000 * tf // (1000 * tf + 20 * scaled_lengths(n, docs, total))
        ends = np.cumsum(postings.column("at").combine_chunks().value_lengths().to_numpy(zero_copy_only=False))
        for begin, end, w, asked in zip([0, *ends], ends, postings.column("w").to_pylist(), postings.column("items").to_pylist()):
            part, add = at[begin:end], w * gain[begin:end]
            for item in asked:
                sums[row[item], part] += add
        if size > most:  # so many documents of this block alone
            bound = np.maximum(bound, np.partition(sums, size - most, axis=1)[:, size - most])
        keep = (sums > 0) & (sums + rest[:, None] >= bound[:, None])
        found, steps = [], []
        for k in np.flatnonzero(keep.any(1)):
            places = np.flatnonzero(keep[k])
            scores = sums[k, places]
            best = np.argsort(-scores, kind="stable")[:most]  # of equal ones the smaller id
            found.append((items[k], places[best], scores[best]) if last else (items[k], places, scores))
            step = np.floor(np.log2(scores[best].astype(np.float64)) * 64).astype(np.int64)
            for s in np.unique(step):
                steps.append({"item": items[k], "step": int(s), "n": int((step == s).sum()), "least": int(scores[best][step == s].min())})
        cuts = pa.array(np.cumsum([0, *[len(x[1]) for x in found]]), pa.int32())
        columns = [np.concatenate([x[k] for x in found]) if found else np.empty(0, np.int64) for k in (1, 2)]
        lists = [pa.ListArray.from_arrays(cuts, pa.array(x, kind)) for x, kind in zip(columns, (pa.int32(), pa.int64()))]
        fields = [pa.field("item", pa.int64()), pa.field("at", pa.list_(pa.int32())), pa.field("score", pa.list_(pa.int64()))]
        values = pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.int64()), *lists], fields=fields)
        step = pa.struct([("item", pa.int64()), ("step", pa.int32()), ("n", pa.int32()), ("least", pa.int64())])
        return pa.table({
            "block": pa.array([key[0].as_py()], pa.int64()), "bundle": pa.array([key[1].as_py()], pa.int32()), "docs": pa.array([size], pa.int32()),
            "held": pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), values), "steps": pa.array([steps], pa.list_(step)),
        })

    return run


def _bands(weights: list[tuple[int, int]], owners: int) -> list[int]:
    """The smallest weight of each owner's terms, so that all owners up to it have about 1, 4, 16, ... parts of the
    postings. ``weights`` holds (weight, postings) by falling weight."""
    total, sums, out = sum(n for _, n in weights), 0, []
    for w, n in weights:
        sums += n
        while len(out) < owners - 1 and sums * 4 ** (owners - 1 - len(out)) >= total:
            out.append(w)
    return [*out, *[0] * (owners - len(out))]


def ranked(docs: DataFrame, items: DataFrame, most: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", owners: int = OWNERS, bundle: int = BUNDLE, block_rows: int = BLOCK_ROWS, max_terms: int = MAX_TERMS) -> DataFrame:
    """(item, rank, id, score): of every item the ``most`` documents of highest score above 0.

    N counts the documents with a term, L all their terms; a term of df documents weighs floor(1000 ln((2N + 2) /
    (2 df + 1))); a document of n terms has m = 50 + (50 n N) div L, and its score sums weight * ((10^9 tf) div
    (1000 tf + 20 m)) over the item's terms, each once. Equal scores go by rising id, null ids last. Every row of
    ``docs`` is a document of its own, also where ids or texts repeat; null and empty texts have no terms and are never
    found. Rows of ``items`` that repeat id and text are one item, rows that share only the id are items of their own;
    items without terms, or whose terms no document has, give no rows. Very long texts are read whole. Other columns are
    not read. Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).where("text is not null").distinct()
    asked = scratch.save(asked.withColumn("item", F.monotonically_increasing_id()), "items")
    pairs = scratch.save(asked.select("item", "text").mapInArrow(_item_terms, "item long, term binary"), "asked")
    terms = scratch.save(pairs.select("term").distinct(), "terms")
    n_items = asked.count()
    n_terms, n_bytes = terms.agg(F.count("term"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    few = n_terms <= max_terms and n_bytes <= MAX_TERM_BYTES
    shared = spark.sparkContext.broadcast(frozenset(terms.toArrow()["term"].to_pylist())) if few else None
    kind = docs.schema[id_col].dataType.simpleString()
    used = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = used.mapInArrow(_inverted(shared, block_rows), f"block long, ids array<{kind}>, lengths array<int>, term binary, at array<int>, tf array<int>, n array<int>")
    rows = scratch.save(rows, "rows")
    if shared:
        shared.destroy()
    heads, postings = rows.where("term is null"), rows.where("term is not null").select("block", "term", "at", "tf", "n")
    if not few:
        postings = scratch.save(postings.join(terms, "term"), "postings")

    with_terms = F.filter("lengths", lambda x: x > 0)
    n_docs, total, least = heads.agg(
        F.coalesce(F.sum(F.size(with_terms)), F.lit(0)), F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x)), F.lit(0)), F.coalesce(F.min(F.array_min(with_terms)), F.lit(1))
    ).first()
    total = max(total, 1)
    known = postings.groupBy("term").agg(F.sum(F.size("at")).alias("df"), F.max(F.array_max("tf")).cast("long").alias("tf"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long").alias("w")
    room = 20 * (50 + 50 * least * n_docs // total)
    known = scratch.save(known.select("term", "df", weight, F.expr(f"1000000000 * tf div (1000 * tf + {room})").alias("top")).where("w > 0"), "known")
    by_weight = known.groupBy("w").agg(F.sum("df")).collect()  # weights are whole numbers below 1000 ln(2 N + 2)
    bands = _bands(sorted(map(tuple, by_weight), reverse=True), owners)
    owner = F.lit(owners - 1)
    for k in range(owners - 2, -1, -1):
        owner = F.when(F.col("w") >= bands[k], k).otherwise(owner)
    bundles = max(1, -(-n_items // bundle))
    place = F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int").alias("bundle")
    wanted = scratch.save(pairs.join(known, "term").select("item", "term", "w", "top", owner.alias("owner"), place), "wanted")
    met = wanted.groupBy("owner", "term", "bundle").agg(F.first("w").alias("w"), F.collect_list("item").alias("items"))
    if wanted.count() <= MAX_PAIRS:
        met = F.broadcast(met)
    rests = [F.sum(F.when(F.col("owner") > k, F.col("w") * F.col("top")).otherwise(0)).alias(f"rest{k}") for k in range(owners)]
    rests = scratch.save(wanted.groupBy("item", "bundle").agg(*rests), "rests")

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n_items <= MAX_ITEMS else df

    state = heads.select("block", F.size("ids").alias("docs"), F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle"), F.array().cast(HELD).alias("held"))
    bounds = rests.select("item", F.lit(0).cast("long").alias("bound"))
    for k in range(owners):
        facts = rests.join(small(bounds), "item", "left").groupBy("bundle").agg(F.collect_list(F.struct("item", F.col(f"rest{k}").alias("rest"), F.coalesce("bound", F.lit(0).cast("long")).alias("bound"))).alias("facts"))
        here = state.select("block", "docs", "bundle", "held").join(small(facts), "bundle").toDF("bundle", "block", "docs", "held", "facts")
        there = postings.join(met.where(F.col("owner") == k), "term").select("block", "bundle", "w", "items", "at", "tf", "n")
        step = here.groupBy("block", "bundle").cogroup(there.groupBy("block", "bundle")).applyInArrow(
            _owner(n_docs, total, most, k == owners - 1), f"block long, bundle int, docs int, held {HELD}, steps array<struct<item:bigint,step:int,n:int,least:bigint>>"
        )
        state = scratch.save(step, f"state{k}")
        if k:
            scratch.drop(f"state{k - 1}")
        best = state.select(F.explode("steps").alias("s")).groupBy("s.item", "s.step").agg(F.sum("s.n").alias("n"), F.min("s.least").alias("least"))
        down = Window.partitionBy("item").orderBy(F.desc("step"))
        bounds = best.withColumn("sum", F.sum("n").over(down)).where(F.col("sum") >= most).groupBy("item").agg(F.max("least").alias("bound"))
        bounds = scratch.save(bounds, f"bounds{k}")

    hits = state.select("block", F.explode("held").alias("h")).select("block", "h.item", F.explode(F.arrays_zip("h.at", "h.score")).alias("p")).select("block", "item", "p.at", "p.score")
    hits = hits.join(small(bounds), "item", "left").where("score >= coalesce(bound, 0)").drop("bound")
    names = heads.select("block", F.posexplode("ids").alias("at", "id"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    top = hits.join(names, ["block", "at"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    out = top.join(small(asked.select("item", "item_id")), "item").select(F.col("item_id").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
    return scratch.finish(out)
