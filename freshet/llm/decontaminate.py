"""Benchmark decontamination with DataFrame functions only.

The windows of all benchmark items are a broadcast hash set, keyed by the hash of their words. A document's
words are scanned once: at every place the hash of the window that begins there is looked up, and a hit is
verified word by word. Only hits are shuffled. Of a benchmark beyond the bound of rows or bytes a bitmap of fixed size
is broadcast instead, with a bit for every hash: what it lets through, hits and few others, is written with its words,
meets the windows by a join on the hash (hashes of many hits by broadcast) and is verified there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.columns import filled, free_name, let, pattern_spans
from freshet.llm.components import hub_size, join_hubs
from freshet.llm.scratch import Scratch

WINDOW = 10
#: Most distinct benchmark windows that are broadcast, and most bytes of their words and item ids.
MAX_WINDOWS, MAX_BYTES = 200_000, 64 << 20
#: Words of 64 bits in the bitmap of a larger benchmark (about 32 bytes each as a broadcast row): of 2 M windows it lets
#: 3 % of other windows through, of 20 M a quarter.
BITMAP_WORDS = 1 << 20
#: Most contaminated texts whose keys (about 40 bytes each) are broadcast to drop them.
MAX_FOUND = 1_000_000
#: What separates words: every ASCII character but digits and lower-case letters; and words before lower-casing.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_parts(text: Column) -> Column:
    return F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAK)


def trimmed(parts: Column) -> Column:
    """Without the empty strings that a separator leaves at either end."""
    first = F.when(parts[0] == "", 1).otherwise(0)
    last = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return F.slice(parts, first + 1, F.size(parts) - first - last)


def with_words(df: DataFrame, text_col: str, to: str) -> DataFrame:
    return df.withColumn("_parts", word_parts(F.col(text_col))).withColumn(to, trimmed(F.col("_parts"))).drop("_parts")


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(key, window, items): distinct windows, the hash of their words, and the items that hold them. An item
    of fewer words than ``window`` is one window; items without words or id, and null texts, have none."""
    items = with_words(benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")), "text", "words")
    items = items.where((F.size("words") > 0) & F.col("item").isNotNull())
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    windows = items.select("item", "words", F.explode(starts).alias("start")).select("item", F.slice("words", F.col("start"), window).alias("window"))
    return windows.groupBy("window").agg(F.collect_set("item").alias("items")).select(F.xxhash64("window").alias("key"), "window", "items")


def occurrences(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """(id, hash, size, n_words, start, width, items): a row for every occurrence of a window, start counted from
    1, and for every row of ``docs`` one row with a null start. hash and size tell texts of one id apart. Very
    long texts are read whole: their words are the largest thing a task holds of them."""
    known = benchmark_windows(benchmark, window=window)
    bytes_ = F.sum(F.octet_length(F.array_join("window", " ")) + F.octet_length(F.array_join("items", " "))).alias("bytes")
    facts = known.agg(F.count("key").alias("n"), bytes_, F.array_sort(F.collect_set(F.size("window"))).alias("widths")).first()
    widths = facts["widths"]  # at most ``window`` numbers
    one = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"), F.coalesce(F.octet_length(text_col), F.lit(-1)).alias("size"))
    cut = with_words(one, "text", "words").select("id", "hash", "size", F.size("words").alias("n_words"), "words")
    blank = F.lit(None)
    if facts["n"] <= max_windows and (facts["bytes"] or 0) <= max_bytes:
        # At place 0 every row meets the mark, whose window is null.
        mark = docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("key"), blank.cast("array<string>").alias("window"), blank.cast("array<string>").alias("items"))
        each = cut.select("id", "hash", "size", "n_words", "words", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n_words") - min(widths, default=0) + 1, F.lit(0)))).alias("start"))
        keys = {w: F.when(F.col("start") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.slice("words", F.greatest("start", F.lit(1)), w))) for w in widths or [0]}
        near = each.withColumn("key", keys[widths[0]]) if len(widths) == 1 else each.withColumn("key", F.explode(F.array_distinct(F.array(*keys.values()))))
        met = near.join(F.broadcast(known.union(mark)), "key")
        same = F.col("window").isNotNull() & (F.col("start") > 0) & (F.slice("words", F.greatest("start", F.lit(1)), F.size("window")) == F.col("window"))
        found = met.where(same | (F.col("window").isNull() & (F.col("start") == 0)))
        return found.select("id", "hash", "size", "n_words", F.when(F.col("start") > 0, F.col("start")).alias("start"), F.size("window").alias("width"), "items").withColumn("width", F.when(F.col("start").isNotNull(), F.col("width")))
    scratch = Scratch(docs.sparkSession)
    known = scratch.save(known, "windows")
    word, bit = F.shiftright("key", 6).bitwiseAND(BITMAP_WORDS - 1).alias("word"), F.col("key").bitwiseAND(63).cast("int").alias("bit")
    bits = known.select(word, bit).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))

    def windows_of(w: int) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.col("n_words") - w + 1), lambda i: F.struct(i.alias("start"), F.lit(w).alias("width"), F.xxhash64(F.slice("words", i, w)).alias("key")))
        return F.when(F.col("n_words") >= w, each).otherwise(F.array().cast("array<struct<start:int,width:int,key:bigint>>"))

    places = F.concat(*map(windows_of, widths))
    each = cut.select("id", "hash", "size", "n_words", "words", F.explode(places).alias("p")).select("id", "hash", "size", "n_words", "words", "p.start", "p.width", "p.key").withColumns({"word": word, "bit": bit})
    through = each.join(F.broadcast(bits), "word").where(F.expr("shiftright(bits, bit) & 1") == 1)
    through = scratch.save(through.select("id", "hash", "size", "n_words", "start", "width", "key", F.slice("words", F.col("start"), F.col("width")).alias("here")).distinct(), "through")
    counts = through.groupBy("key").agg(F.count("key").alias("n"))
    met = join_hubs(through, scratch.save(known.join(counts, "key"), "met"), "key", hub_size(through.count()))
    true = met.where(F.col("here") == F.col("window"))
    marks = cut.select("id", "hash", "size", "n_words", blank.cast("int").alias("start"), blank.cast("int").alias("width"), blank.cast("array<string>").alias("items"))
    return true.select("id", "hash", "size", "n_words", "start", "width", "items").union(marks)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """One row per input row: id, n_words, n_hit, items (sorted array of strings), contaminated.

    A word inside any occurrence of a window is hit. Very long texts are read whole; an empty table of documents gives
    no rows; other columns are not read. Null or empty text has no words and no hits. Items
    without words or id have no windows; with an empty benchmark nothing is hit. Rows that share id and
    text get equal results and keep their number; rows that share only the id are told apart by text.
    """
    hits = occurrences(docs, benchmark, id_col, text_col, window, max_windows)
    span = F.when(F.col("start").isNotNull(), F.struct("start", "width"))
    docs_hit = hits.groupBy("id", "hash", "size").agg(
        F.count(F.when(F.col("start").isNull(), 1)).alias("rows"), F.first("n_words").alias("n_words"),
        F.collect_set(span).alias("spans"), F.collect_set("items").alias("items"),
    )
    places = F.flatten(F.transform("spans", lambda s: F.sequence(s.start, s.start + s.width - 1)))
    return (
        docs_hit.withColumns({"n_hit": F.size(F.array_distinct(places)), "items": F.array_sort(F.array_distinct(F.flatten("items")))})
        .withColumn("_copy", F.explode(F.expr("sequence(1, cast(rows as int))")))
        .select(F.col("id").alias(id_col), F.col("n_words").cast("long"), F.col("n_hit").cast("long"), "items", (F.col("n_hit") > 0).alias("contaminated"))
    )


def _same(a: Column, hash_: str, size: str, id_col: str, text_col: str) -> Column:
    return F.col(id_col).eqNullSafe(a) & (F.xxhash64(text_col) == F.col(hash_)) & (F.coalesce(F.octet_length(text_col), F.lit(-1)) == F.col(size))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text holds no benchmark window. Null and empty texts stay, repeated rows
    stay or go together, very long texts are read whole, columns of any name are kept; an empty table stays empty, and
    with an empty benchmark all rows stay."""
    hits = occurrences(docs, benchmark, id_col, text_col, window, max_windows).where("start is not null")
    names = [free_name(docs, x) for x in ("hit_id", "hit_hash", "hit_size")]
    bad = Scratch(docs.sparkSession).save(hits.select("id", "hash", "size").distinct().toDF(*names), "contaminated")
    if bad.count() <= MAX_FOUND:
        bad = F.broadcast(bad)
    return docs.join(bad, _same(F.col(names[0]), names[1], names[2], id_col, text_col), "left_anti")


def cut_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The rows of ``docs`` (all columns) without the words of benchmark windows: each window goes from the first
    letter of its first word to the last letter of its last. Texts without hits stay as they are; null stays null.
    Rows keep their number and columns; very long texts are read whole; an empty table stays empty."""
    hits = occurrences(docs, benchmark, id_col, text_col, window, max_windows).where("start is not null")
    names = [free_name(docs, x) for x in ("hit_id", "hit_hash", "hit_size", "hit_spans")]
    found = hits.groupBy("id", "hash", "size").agg(F.array_sort(F.collect_set(F.struct("start", "width"))).alias("spans")).toDF(*names)
    text, spans = F.col(text_col), F.col(names[3])

    def cut_out(places: Column) -> Column:
        """Word numbers become places of letters; runs that touch in words are one span."""
        return filled(text, F.transform(spans, lambda s: F.struct(F.get(places, s["start"] - 1)["start"].alias("start"), F.get(places, s["start"] + s["width"] - 2)["end"].alias("end"))), lambda new, length: F.lit(""))

    cleaned = F.when(spans.isNotNull(), let(pattern_spans(text, WORD, 0), cut_out)).otherwise(text)
    joined = docs.join(found, _same(F.col(names[0]), names[1], names[2], id_col, text_col), "left")
    return joined.withColumn(text_col, cleaned).select(*docs.columns)
