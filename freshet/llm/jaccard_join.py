"""Similarity join of whole texts by the Jaccard similarity of their word shingles.

1. Every text becomes a sorted array of distinct shingle hashes, a 128-bit content digest (texts of equal
   words are one from here on) and a hashed bitmap sized to its set. A counting sketch of all shingles,
   of fixed size, marks those that many texts share.
2. Two sets as similar as asked for share one of their first shingles in any common order. Ordered rare
   ones first, those prefixes make tiles: the sets that share a shingle, by size. Sizes and places in the
   order bound the overlap from above; a pair that passes is a candidate, unless the shingles before this
   one in both orders are equal too (then an earlier tile lists it). In a tile too large for all its
   pairs, each set is first compared only with the set that is in most large tiles (the likely origin of a
   family of near copies); once components are known, pairs within one component are settled, and the sets
   outside a tile's largest component look for others of the tile by size band, as far as their place allows.
3. The bits in which two bitmaps differ bound the overlap from above.
4. Sorted arrays of the survivors are intersected exactly, and links make components.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.components import components, hub_size, join_hubs
from freshet.llm.scratch import Scratch
from freshet.llm.textbytes import ascii_words, digest128, shingle_set, small_batches, text_bytes

SHINGLE = 5
PERCENT = 80
#: Buckets of the sketch (2 ** bits), and buckets sent as one row.
SKETCH_BITS = 22
SKETCH_ROW = 1 << 14
#: Largest tile whose pairs are all listed at once; tasks over which the tile of a common shingle is dealt.
TILE = 64
SALTS = 32
#: Bits of the filter that tells which texts have to be fetched for verification (2 MB).
FILTER_BITS = 24
SEEN = 300_000


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def bitmap(hashes: np.ndarray) -> bytes:
    """One bit for each hash, in a power of two of at least twice as many places (64 to 65536)."""
    width = min(1 << 16, max(64, 1 << int(2 * len(hashes) - 1).bit_length()))
    bits = np.zeros(width, np.uint8)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def overlap_bound(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """At most this many hashes are common: each differing bit needs a hash that one side lacks."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return (n_a + n_b - int(np.bitwise_count(x ^ y).sum())) // 2


def least_overlap(n_a, n_b, percent: int):
    """Smallest intersection with 100 * intersection >= percent * union."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def _described(width: int):
    """Of each text: digest, set size and bitmap; of each task: its share of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in small_batches(batches, 1):
            rows, sets = [], [np.empty(0, np.uint64)]
            for text in text_bytes(batch.column(1)):
                words = ascii_words(text)
                hashes = shingle_set(words, width)
                rows.append((*digest128(b" ".join(words)), len(hashes), bitmap(hashes)))
                sets.append(hashes)
            buckets = np.sort(_bucket(np.concatenate(sets)))
            first = np.flatnonzero(np.diff(buckets, prepend=-1))
            sketch[buckets[first]] += np.diff(first, append=len(buckets)).astype(np.uint32)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                names=["id", "r1", "r2", "n", "bits", "part", "counts"],
            )
            kind = batch.column(0).type
        parts = [(i, c) for i, c in enumerate(np.minimum(sketch, 255).astype(np.uint8).reshape(-1, SKETCH_ROW)) if c.any()]
        if parts:
            n = len(parts)
            packed = [zlib.compress(c.tobytes(), 1) for _, c in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, kind), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array([i for i, _ in parts], pa.int32()), pa.array(packed, pa.binary())],
                names=["id", "r1", "r2", "n", "bits", "part", "counts"],
            )

    return run


def _common_buckets(limit: float):
    """Adds the shares up and packs which buckets hold more than ``limit``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total = sums.setdefault(part, np.zeros(SKETCH_ROW, np.int64))
                total += np.frombuffer(zlib.decompress(counts), np.uint8)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.packbits(x > limit).tobytes() for x in sums.values()], pa.binary())], names=["part", "common"])

    return run


def _prefixes(shared, width: int, percent: int):
    """The first shingles of each distinct text in the common order: rare ones before common ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.unpackbits(shared.value).astype(bool)
        seen: set = set()
        for batch in small_batches(batches, 0):
            columns: list[list] = [[] for _ in range(6)]
            for text in text_bytes(batch.column(0)):
                words = ascii_words(text)
                ref = digest128(b" ".join(words))
                if not words or ref in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(ref)
                hashes = shingle_set(words, width)
                n = len(hashes)
                hot = common[_bucket(hashes)]
                first = np.argsort(hot, kind="stable")[: n - -(-percent * n // 100) + 1]
                size = len(first)
                salts = np.where(hot[first], ref[0] % SALTS + 1, 0)
                before = np.zeros(size, np.int64)  # 31 bits that tell the shingle before from others
                before[1:] = (hashes[first[:-1]] & np.uint64((1 << 31) - 2)).astype(np.int64) + 1
                for column, values in zip(columns, (hashes[first].view(np.int64), salts, np.full(size, ref[0]), np.full(size, ref[1]), np.full(size, n), np.arange(size) | before << 32)):
                    column.append(values)
            if columns[0]:
                flat = [np.concatenate(c) for c in columns]
                for i in range(0, len(flat[0]), 200_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[i : i + 200_000], t) for c, t in zip(flat, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names=["k", "salt", "r1", "r2", "n", "at"]
                    )

    return run


#: The place of a shingle in its set's order; the bits above tell the shingle before it.
PLACE = (1 << 32) - 1
KINDS = "kind int, k long, a1 long, a2 long, an int, at long, b1 long, b2 long"


def _rows(kind, a, k=None, at=None, b=None) -> pa.RecordBatch:
    """a, b: (r1, r2, n) arrays."""
    size = len(a[0])

    def cell(x, t):
        return pa.nulls(size, t) if x is None else pa.array(x, t)

    b = b or (None, None)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(size, kind), pa.int32()), cell(k, pa.int64()), cell(a[0], pa.int64()), cell(a[1], pa.int64()), cell(a[2], pa.int32()), cell(at, pa.int64()), cell(b[0], pa.int64()), cell(b[1], pa.int64())],
        names=["kind", "k", "a1", "a2", "an", "at", "b1", "b2"],
    )


def _tiles(percent: int):
    """Reads rows sorted by (k, salt, n, r1, r2): the candidate pairs (kind 0) of small tiles, the members
    (kind 1) of large ones and of those that are dealt over several tasks."""

    def small(c: dict, start: np.ndarray, length: np.ndarray) -> Iterator[pa.RecordBatch]:
        left = np.repeat(start + length, length) - np.arange(length.sum()) - np.repeat(start - np.concatenate(([0], np.cumsum(length)[:-1])), length)
        index = np.arange(length.sum()) + np.repeat(start - np.concatenate(([0], np.cumsum(length)[:-1])), length)
        pairs = []
        for gap in range(1, int(length.max())):
            i = index[left > gap]
            j = i + gap
            n_i, n_j = c["n"][i], c["n"][j]
            at_i, at_j = c["at"][i], c["at"][j]
            most = 1 + np.minimum(n_i - 1 - (at_i & PLACE), n_j - 1 - (at_j & PLACE))
            repeated = (at_i >> 32 == at_j >> 32) & (at_i >> 32 > 0)
            ok = ~repeated & (most >= least_overlap(n_i, n_j, percent)) & (100 * n_i >= percent * n_j)
            pairs.append((i[ok], j[ok]))
        i, j = (np.concatenate([p[s] for p in pairs]) for s in (0, 1))
        if len(i):
            swap = (c["r1"][i] > c["r1"][j]) | ((c["r1"][i] == c["r1"][j]) & (c["r2"][i] > c["r2"][j]))
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            _, once = np.unique(np.stack([c["r1"][i], c["r2"][i], c["r1"][j], c["r2"][j]], 1), axis=0, return_index=True)
            i, j = i[once], j[once]
            yield _rows(0, [c[x][i] for x in ("r1", "r2", "n")], b=[c[x][j] for x in ("r1", "r2")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("k", "salt", "r1", "r2", "n", "at")
        held: dict | None = None
        large = None  # (k, salt) of the large tile that the rows before ended in
        for batch in batches:
            c = {x: batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i, x in enumerate(names)}
            if held is not None:
                c = {x: np.concatenate([held[x], c[x]]) for x in names}
            for rows in _cut(c, names, large, small, percent, last=False):
                if isinstance(rows, tuple):
                    held, large = rows
                else:
                    yield rows
        if held is not None and len(held["k"]):
            for rows in _cut(held, names, large, small, percent, last=True):
                if not isinstance(rows, tuple):
                    yield rows

    return run


def _cut(c: dict, names, large, small, percent: int, last: bool):
    """Handles all tiles that end in these rows; yields what is held over as (rows, large)."""
    if not len(c["k"]):
        yield (None, large)
        return
    same = np.zeros(len(c["k"]), bool)
    same[1:] = (c["k"][1:] == c["k"][:-1]) & (c["salt"][1:] == c["salt"][:-1]) & (c["r1"][1:] == c["r1"][:-1]) & (c["r2"][1:] == c["r2"][:-1])
    c = {x: c[x][~same] for x in names}
    edge = np.flatnonzero((c["k"][1:] != c["k"][:-1]) | (c["salt"][1:] != c["salt"][:-1])) + 1
    start = np.concatenate(([0], edge))
    length = np.diff(np.concatenate((start, [len(c["k"])])))
    is_large = (length > TILE) | (c["salt"][start] > 0)
    is_large[0] |= (c["k"][0], c["salt"][0]) == large
    state = (c["k"][-1], c["salt"][-1]) if is_large[-1] else None
    hold = None
    if not last and not is_large[-1]:
        hold = {x: c[x][start[-1] :] for x in names}
        start, length, is_large = start[:-1], length[:-1], is_large[:-1]
    plain = ~is_large & (length > 1)
    if plain.any():
        yield from small(c, start[plain], length[plain])
    if is_large.any():
        rows = np.repeat(is_large, length)
        rows = {x: c[x][: len(rows)][rows] for x in names}
        yield _rows(1, [rows[x] for x in ("r1", "r2", "n")], k=rows["k"], at=rows["at"])
    yield (hold, state)


def _bounded(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b = (batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("abits", "bbits", "an", "bn"))
            ok = [overlap_bound(*x) >= least_overlap(x[2], x[3], percent) for x in zip(a, b, n_a, n_b)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _verified(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict = {}

        def hashes(packed: bytes) -> np.ndarray:
            if packed not in recent:
                if len(recent) > 256:
                    recent.clear()
                recent[packed] = shingle_set(zlib.decompress(packed).split(), width)
            return recent[packed]

        for batch in batches:
            ok = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = hashes(a), hashes(b)
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return run


def _fetched(shared):
    """Digest and packed words of the distinct texts that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(shared.value, bitorder="little")
        seen: set = set()
        for batch in small_batches(batches, 0):
            rows = []
            for text in text_bytes(batch.column(0)):
                words = b" ".join(ascii_words(text))
                ref = digest128(words)
                if words and wanted[ref[0] & ((1 << FILTER_BITS) - 1)] and ref not in seen:
                    if len(seen) < SEEN:
                        seen.add(ref)
                    rows.append((*ref, zlib.compress(words, 1)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["r1", "r2", "packed"])

    return run


REF = "struct<r1:bigint,r2:bigint>"


def _filter_bits(refs: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over the digests; more refs only let more texts through."""
    place = F.col("ref.r1").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) + 1  # bitmaps count from 1
    rows = refs.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in rows:
        out[(r["part"] - 1) * 4096 : r["part"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable by links).

    Texts link when 100 * intersection >= percent * union of their sets of ``width``-word shingles; a text
    of fewer words is one shingle. Null text, or text without words, has an empty set and links with
    nothing: its component is its own id. Equal texts are one node, so rows may repeat, ids included; a
    null id is never a component's id while another is there. Where texts share an id, two components may be
    named by one id: pass an id that tells them apart. Very long texts are read whole, one by one. An empty
    table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    used = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    described = scratch.save(used.mapInArrow(_described(width), f"id {kind}, r1 long, r2 long, n long, bits binary, part int, counts binary"), "described")
    texts = described.where("n is not null").select("id", F.struct("r1", "r2").alias("ref"), "n", "bits")
    mean = (texts.agg(F.sum("n")).first()[0] or 0) / (1 << SKETCH_BITS)
    shares = described.where("part is not null").select("part", "counts").repartition("part")
    common = np.zeros((1 << SKETCH_BITS) // 8, np.uint8)
    for row in shares.mapInArrow(_common_buckets(mean + 6 * mean**0.5 + 32), "part int, common binary").collect():
        common[row["part"] * SKETCH_ROW // 8 : (row["part"] + 1) * SKETCH_ROW // 8] = np.frombuffer(bytes(row["common"]), np.uint8)

    prefixes = used.select("text").mapInArrow(_prefixes(spark.sparkContext.broadcast(common), width, percent), "k long, salt int, r1 long, r2 long, n int, at long")
    sorted_rows = prefixes.repartition("k", "salt").sortWithinPartitions("k", "salt", "n", "r1", "r2")
    tiles = scratch.save(sorted_rows.mapInArrow(_tiles(percent), KINDS), "tiles")
    ref_a, ref_b = F.struct(F.col("a1").alias("r1"), F.col("a2").alias("r2")), F.struct(F.col("b1").alias("r1"), F.col("b2").alias("r2"))
    listed = tiles.where("kind = 0").select(ref_a.alias("a"), ref_b.alias("b"))
    place, before = F.col("at").bitwiseAND(F.lit(PLACE)).alias("at"), F.shiftright("at", 32).alias("before")
    members = tiles.where("kind = 1").select("k", ref_a.alias("ref"), F.col("an").alias("n"), place, before)
    near = _near(texts, listed.union(_to_likely_origin(members)), percent, scratch, "near-1")
    packed = scratch.save(_packed(used, near.select(F.explode(F.array("a", "b")).alias("ref")).union(members.select("ref"))), "packed")
    links = scratch.save(_similar(near, packed, width, percent), "links-1")
    if not members.isEmpty():
        pairs = _unsettled(members, components(links, scratch, "components-1"), percent)
        near = _near(texts, pairs, percent, scratch, "near-2")
        links = links.union(scratch.save(_similar(near, packed, width, percent), "links-2"))
    found = components(links, scratch, "components")
    rows = texts.select("id", "ref", F.col("n").alias("n_shingles"))
    out = join_hubs(rows, scratch.save(_smallest(texts, found), "smallest"), "ref", hub_size(rows.count()))
    out = out.select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("id")).alias("component_id"))
    return scratch.finish(out)


def _smallest(texts: DataFrame, found: DataFrame) -> DataFrame:
    """(ref, smallest, n): the smallest id in each distinct text's component, and the rows of the text. Only texts with
    links look their component up, and a large component is dealt over SALTS tasks."""
    own = texts.groupBy("ref").agg(F.min("id").alias("own"), F.count("ref").alias("n"))
    linked = found.union(found.select(F.col("component").alias("node"), "component").distinct()).withColumnRenamed("node", "ref").join(own.drop("n"), "ref")
    least = linked.groupBy("component").agg(F.min("own").alias("least")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    named = linked.withColumn("salt", F.pmod(F.xxhash64("ref"), F.lit(SALTS))).join(least, ["component", "salt"]).select("ref", "least")
    return own.join(named, "ref", "left").select("ref", F.coalesce("least", "own").alias("smallest"), "n")


def _by_tile(members: DataFrame, tiles: DataFrame) -> DataFrame:
    """``members`` with what ``tiles`` has of their tile, a row a tile; the members of a common tile are dealt over
    SALTS tasks, and every large tile has more members than that."""
    salted = members.withColumn("salt", F.pmod(F.xxhash64("ref"), F.lit(SALTS)))
    return salted.join(tiles.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), ["k", "salt"]).drop("salt")


def _to_likely_origin(members: DataFrame) -> DataFrame:
    """Each set with the one, of those it shares a large tile with, that is in most large tiles."""
    counted = members.join(members.groupBy("ref").agg(F.count("k").alias("tiles")), "ref")
    first = counted.groupBy("k").agg(F.max(F.struct("tiles", "ref")).alias("first"))
    met = _by_tile(counted, first).where(F.col("ref") != F.col("first.ref"))
    return met.groupBy(F.col("ref").alias("a")).agg(F.max("first").alias("first")).select("a", F.col("first.ref").alias("b"))


def _band(n):
    """Bands of sizes: from a size down to the smallest that can be similar it is about eight."""
    return F.floor(F.log(n.cast("double")) / (math.log(100 / PERCENT) / 8)).cast("int")


def _unsettled(members: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs of a large tile whose sets are in different components, one of them outside the tile's largest,
    and which sizes and places allow.

    The larger set of a pair looks for smaller ones band by band. Its place in the tile's order bounds the
    overlap, and with it the sizes from above: a set that meets the tile late looks into few bands or none, so
    texts that share a passage, but not enough of it, do not meet. A common tile is dealt over more tasks.
    """
    placed = members.join(found.withColumnRenamed("node", "ref"), "ref", "left").select("k", "ref", "n", "at", "before", F.coalesce("component", "ref").alias("c"))
    sizes = placed.groupBy("k", "c").count()
    main = sizes.groupBy("k").agg(F.max(F.struct("count", "c")).alias("main"), F.count("c").alias("n_c"), F.sum("count").alias("members")).where("n_c > 1")
    salts = F.greatest(F.lit(1), F.least(F.lit(SALTS), F.ceil(F.col("members") / (16 * TILE)))).cast("int")
    placed = _by_tile(placed, main.select("k", F.col("main.c").alias("main"), salts.alias("salts")))
    # overlap <= n - at, and percent * (n + m) <= (100 + percent) * overlap for a partner of size m <= n
    largest = F.least(F.col("n"), F.floor((F.col("n") - F.col("at")) * (100 + percent) / percent) - F.col("n"))
    least = F.ceil(F.col("n") * percent / 100)
    def dealt(df: DataFrame, key: str, copied: bool) -> DataFrame:
        own = F.pmod(F.xxhash64(key), F.col("salts")).cast("int")
        return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)) if copied else own).drop("salts")

    asks = placed.where(largest >= least).withColumn("band", F.explode(F.sequence(_band(least), _band(largest))))
    asks = asks.select("k", "band", "salts", "main", *[F.col(x).alias(f"x{x}") for x in ("ref", "n", "at", "before", "c")])
    held = placed.withColumn("band", _band(F.col("n")))
    n = F.col("n") + F.col("xn")
    most = 1 + F.least(F.col("n") - 1 - F.col("at"), F.col("xn") - 1 - F.col("xat"))
    repeated = (F.col("before") == F.col("xbefore")) & (F.col("before") > 0)
    near = (F.col("c") != F.col("xc")) & ~repeated & (F.col("n") <= F.col("xn")) & (100 * F.col("n") >= percent * F.col("xn")) & (most * (100 + percent) >= percent * n)
    # Either the larger set is outside, or it is not and the smaller one is; the side that is outside is copied.
    larger = dealt(asks.where("xc <> main"), "xref", True).join(dealt(held, "ref", False).drop("main"), ["k", "band", "salt"]).where(near)
    smaller = dealt(asks.where("xc = main"), "xref", False).join(dealt(held.where("c <> main"), "ref", True).drop("main"), ["k", "band", "salt"]).where(near)
    pairs = larger.select("ref", "xref").union(smaller.select("ref", "xref"))
    return pairs.select(F.least("ref", "xref").alias("a"), F.greatest("ref", "xref").alias("b"))


def _near(texts: DataFrame, pairs: DataFrame, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """(a, b) of the distinct pairs that their bitmaps do not rule out. A text of many pairs, such as the likely origin
    of a family, meets them by broadcast."""
    pairs = scratch.save(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), f"{name}-pairs")
    few = hub_size(pairs.count())
    sketches = texts.where("n > 0").select("ref", "n", "bits").dropDuplicates(["ref"])
    for s in "ab":
        side = sketches.select(*[F.col(x).alias(y) for x, y in (("ref", s), ("n", f"{s}n"), ("bits", f"{s}bits"))])
        keyed = scratch.save(side.join(pairs.groupBy(s).agg(F.count(s).alias("n")), s), f"{name}-{s}")
        met = join_hubs(pairs if s == "a" else met, keyed, s, few)
    return scratch.save(met.select("a", "an", "abits", "b", "bn", "bbits").mapInArrow(_bounded(percent), f"a {REF}, b {REF}"), name)


def _packed(used: DataFrame, refs: DataFrame) -> DataFrame:
    """(ref, packed words) of the wanted texts, each once."""
    refs = refs.distinct()
    shared = used.sparkSession.sparkContext.broadcast(_filter_bits(refs))
    packed = used.select("text").mapInArrow(_fetched(shared), "r1 long, r2 long, packed binary").select(F.struct("r1", "r2").alias("ref"), "packed").dropDuplicates(["ref"])
    return packed.join(refs, "ref", "left_semi")


def _similar(near: DataFrame, packed: DataFrame, width: int, percent: int) -> DataFrame:
    """(u, v) of the pairs that are similar, by exact intersection."""
    left, right = packed.select(F.col("ref").alias("a"), F.col("packed").alias("apacked")), packed.select(F.col("ref").alias("b"), F.col("packed").alias("bpacked"))
    whole = near.join(left, "a").join(right, "b").select(F.col("a").alias("u"), F.col("b").alias("v"), "apacked", "bpacked")
    return whole.mapInArrow(_verified(width, percent), f"u {REF}, v {REF}")
