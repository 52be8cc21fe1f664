"""Prediction by partial matching over bytes, with frozen statistics.

Training counts byte grams in Arrow tasks and sums them in Spark; the context tree is a table of grams and a
table of contexts, none of them left out. Every (context, symbol) pair has its exact code length: escape
method D, and symbols seen in a longer context are excluded from the shorter ones. Scoring looks the longest
gram before every byte up in a broadcast table of the commonest, and joins all others.

A text is coded as its bytes and one end symbol (byte 0); a byte 0 within a text is coded as byte 1.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.scratch import Scratch
from freshet.llm.textbytes import small_batches, text_bytes

#: Bytes handled at once by the array code, and rows of partial counts kept before they are merged.
WINDOW = 1 << 20
MERGE_ROWS = 1_500_000
#: Rows of counts handed on in one batch.
SENT_ROWS = 100_000


def _streams(texts: Iterable[bytes], order: int) -> Iterator[tuple[bytes, np.ndarray]]:
    """(stream, starts): texts joined with ``order`` zero bytes, each run of about WINDOW bytes."""
    pad = b"\0" * order
    run, starts, at = [pad], [], order
    for text in texts:
        text = text.replace(b"\0", b"\1")
        run += [text, pad]
        starts.append(at)
        at += len(text) + order
        if at >= WINDOW:
            yield b"".join(run), np.array(starts + [at], np.int64)
            run, starts, at = [pad], [], order
    if starts:
        yield b"".join(run), np.array(starts + [at], np.int64)


def _coded_grams(stream: bytes, starts: np.ndarray, order: int) -> np.ndarray:
    """The (order + 1)-byte gram that ends in each byte or end symbol, packed big-endian, text by text."""
    data = np.frombuffer(stream, np.uint8)
    coded = np.ones(len(data), bool)
    coded[:order] = False
    for shift in range(1, order):
        coded[starts[1:] - order + shift] = False
    code = np.zeros(len(data), np.uint64)
    for back in range(order + 1):
        code[back:] |= data[: len(data) - back].astype(np.uint64) << np.uint64(8 * back)
    return code[coded]


def gram_counts(texts: Iterable[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (order + 1)-byte grams, packed big-endian, that end in each byte or end symbol; their counts."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for stream, starts in _streams(texts, order):
        parts.append(np.unique(_coded_grams(stream, starts, order), return_counts=True))
        if sum(len(p[0]) for p in parts) > MERGE_ROWS:
            parts = [_merged(parts)]
    return _merged(parts)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.concatenate([np.empty(0, np.uint64), *[p[0] for p in parts]])
    by_code = np.argsort(codes, kind="stable")  # the parts are sorted, so this merges them
    codes = codes[by_code]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])[: len(codes)])
    counts = np.concatenate([np.empty(0, np.int64), *[p[1] for p in parts]])[by_code]
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def count_grams(texts: DataFrame, order: int, normalise, by: str | None = None) -> DataFrame:
    """(by, code, n) of a frame with columns text and, if named, ``by``. Partial counts are per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in small_batches(batches, 0):
            column = text_bytes(batch.column(0))
            keys = batch.column(1).to_pylist() if by else [""] * len(column)
            groups: dict = {}
            for key, text in zip(keys, column):
                groups.setdefault(key, []).append(normalise(text))
            for key, group in groups.items():
                parts = held.setdefault(key, [])
                parts.append(gram_counts(group, order))
                if sum(len(p[0]) for p in parts) > MERGE_ROWS:
                    held[key] = [_merged(parts)]
        for key, parts in held.items():
            codes, counts = _merged(parts)
            for begin in range(0, len(codes), SENT_ROWS):
                code, n = codes[begin : begin + SENT_ROWS], counts[begin : begin + SENT_ROWS]
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(code), pa.string()), pa.array(code.view(np.int64)), pa.array(n)], names=["by", "code", "n"])

    picked = texts.select("text", by) if by else texts.select("text")
    return picked.mapInArrow(run, "by string, code long, n long").groupBy("by", "code").agg(F.sum("n").alias("n"))


def _index(values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``wanted`` in sorted ``values``, and which are there."""
    at = np.searchsorted(values, wanted)
    at[at == len(values)] = 0
    return at, (values[at] == wanted) if len(values) else np.zeros(len(wanted), bool)


def _low(code: str, size):
    """The last ``size`` bytes of a packed gram; ``size`` is a number or a column."""
    return F.col(code).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (8 * F.lit(size) if isinstance(size, int) else 8 * size).cast("int")) - 1)


class Levels:
    """The whole model as two Spark tables: counts of the grams of all orders, and sums of all contexts.

    The symbols of a context are a subset of those of the context one byte shorter, so what exclusion takes
    from a level follows from two sums of the longer context: its kinds, and their mass one level below.
    """

    def __init__(self, grams: DataFrame, order: int, scratch: Scratch, many: bool = False):
        """``grams``: a saved table of (by, code, n), as ``count_grams`` makes it; ``many``: of many groups."""
        self.order, self.scratch, self.walks = order, scratch, 0
        #: Up to this order contexts are broadcast: at most 65,536, or 256 for each of many groups.
        self.near = 1 if many else min(2, order)
        shorter = grams.select("by", F.explode(F.sequence(F.lit(0), F.lit(order - 1))).alias("k"), "code", "n").withColumn("code", _low("code", F.col("k") + 1))
        shorter = shorter.groupBy("by", "k", "code").agg(F.sum("n").alias("n"))
        self.counts = scratch.save(grams.select("by", F.lit(order).alias("k"), "code", "n").union(shorter), "counts")
        below = self.counts.select("by", (F.col("k") + 1).alias("k"), F.col("code").alias("short"), F.col("n").alias("m"))
        level = self.counts.where("k > 0").withColumn("short", _low("code", F.col("k"))).join(below, ["by", "k", "short"]).select("by", "k", "code", "n", "m")
        level = level.union(self.counts.where("k = 0").select("by", "k", "code", "n", F.lit(0).cast("long").alias("m")))
        sums = level.groupBy("by", "k", F.shiftright("code", 8).alias("context")).agg(F.sum("n").alias("total"), F.count("n").alias("kinds"), F.sum("m").alias("mass"))
        self.contexts = scratch.save(sums, "contexts")

    def seen(self) -> DataFrame:
        """(by, code, n, bits) of every gram of the training texts."""
        grams = self.counts.where(F.col("k") == self.order).withColumn("context", F.shiftright("code", 8))
        return grams.join(self.contexts.where(F.col("k") == self.order).drop("k"), ["by", "context"]).select("by", "code", "n", _bits(2.0 * F.col("n") - 1, 2.0 * F.col("total")).alias("bits"))

    def unseen(self, wanted: DataFrame) -> DataFrame:
        """(by, code, bits) of distinct grams (by, code) that the training texts do not have.

        All orders of a gram are looked up at once; the escapes are then one expression over its row.
        """
        self.walks += 1
        wanted = self.scratch.save(wanted.select("by", "code"), f"wanted{self.walks}")
        k, near = F.col("k"), self.near

        def orders(first: int, last: int) -> DataFrame:
            each = wanted.select("by", "code", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("k"))
            return each.withColumns({"short": _low("code", k + 1), "context": F.shiftright(_low("code", k + 1), 8)})

        sums, counts = self.contexts, self.counts.withColumnRenamed("code", "short")
        met = orders(0, near).join(F.broadcast(sums.where(k <= near)), ["by", "k", "context"], "left")
        if near < self.order:
            met = met.union(orders(near + 1, self.order).join(sums.where(k > near), ["by", "k", "context"], "left"))
        low = met.where(k < near).join(F.broadcast(counts.where(k < near)), ["by", "k", "short"], "left")
        high = met.where((k >= near) & (k < self.order)).join(counts.where((k >= near) & (k < self.order)), ["by", "k", "short"], "left")
        top = met.where(k == self.order).withColumn("n", F.lit(None).cast("long"))
        names = ["by", "code", "k", "total", "kinds", "mass", "n"]
        found = low.select(names).union(high.select(names)).union(top.select(names))
        walk = found.groupBy("by", "code").agg(*[F.max(F.when(k == j, F.col(x))).alias(f"{x}{j}") for j in range(self.order + 1) for x in ("total", "kinds", "mass", "n")])
        zero = F.lit(0).cast("long")
        walk = walk.withColumns({"bits": F.lit(0.0), "done": F.lit(False), "out_kinds": zero, "out_mass": zero})
        for j in range(self.order, -1, -1):
            total, kinds, mass, n = (F.col(f"{x}{j}") for x in ("total", "kinds", "mass", "n"))
            whole, left = 2.0 * (total - F.col("out_mass")), kinds - F.col("out_kinds")
            open_ = ~F.col("done") & total.isNotNull()
            step = F.when(open_ & n.isNotNull(), _bits(2.0 * n - 1, whole)).when(open_ & (left > 0), _bits(left, whole)).otherwise(F.lit(0.0))
            walk = walk.withColumns({"bits": F.col("bits") + step, "done": F.col("done") | (open_ & n.isNotNull()), "out_kinds": F.coalesce(kinds, "out_kinds"), "out_mass": F.coalesce(mass, "out_mass")})
        rest = F.log2(F.greatest(256 - F.col("out_kinds"), F.lit(1)).cast("double"))
        return walk.select("by", "code", F.when(F.col("done"), F.col("bits")).otherwise(F.col("bits") + rest).alias("bits"))


def _bits(part, whole):
    return -F.log2(part / whole)


class GramTable:
    """Code lengths of some grams: one of them a hash slot, and a sorted search for those that lost their slot."""

    def __init__(self, codes: np.ndarray, bits: np.ndarray):
        """Of two grams of one slot the later one stays there. ``bits`` may have columns, one a language."""
        by_code = np.argsort(codes)
        self.codes, self.bits = codes[by_code], bits[by_code].astype(np.float32)
        self.shift = np.uint64(64 - max(8, int(2 * len(codes)).bit_length()))
        self.at = np.zeros(1 << 64 - int(self.shift), np.int32)
        place = np.empty(len(codes), np.int32)
        place[by_code] = np.arange(len(codes))
        self.at[self._slots(codes)] = place

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits (0 where unknown), and which are known."""
        bits, known = np.zeros((len(codes), *self.bits.shape[1:]), np.float32), np.zeros(len(codes), bool)
        for begin in range(0, len(codes) if len(self.codes) else 0, 1 << 17):
            part = codes[begin : begin + (1 << 17)]
            at = self.at[self._slots(part)]
            hit = self.codes[at] == part
            lost = np.flatnonzero(~hit)
            at[lost], hit[lost] = _index(self.codes, part[lost])
            own = bits[begin : begin + len(part)]
            own[:] = self.bits[at]
            own[~hit] = 0
            known[begin : begin + len(part)] = hit
        return bits, known


def known_bits(table: GramTable, texts: Iterable[bytes], order: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bits of each text by the grams in ``table``; (code, number of the text, times) of all other grams, by code."""
    sums, rest, done = [np.empty((0, *table.bits.shape[1:]))], [], 0
    for stream, starts in _streams(texts, order):
        codes = _coded_grams(stream, starts, order)
        sizes = np.diff(starts) - order + 1
        bits, known = table.find(codes)
        sums.append(np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.float64))
        other = np.flatnonzero(~known)
        rest.append((codes[other], done + np.searchsorted(np.cumsum(sizes), other, side="right")))
        done += len(sizes)
    codes = np.concatenate([np.empty(0, np.uint64), *[r[0] for r in rest]])
    at = np.concatenate([np.empty(0, np.int64), *[r[1] for r in rest]])
    by_code = np.lexsort((at, codes))
    codes, at = codes[by_code], at[by_code]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(codes)), bool), (codes[1:] != codes[:-1]) | (at[1:] != at[:-1]))))
    return np.concatenate(sums), (codes[first], at[first], np.diff(np.append(first, len(codes))))
