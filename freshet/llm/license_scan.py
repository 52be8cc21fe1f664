"""License scans with DataFrame functions only: canonical text, digest, hash join with known digests.

The canonical text does not depend on how lines are wrapped, but for whole lines that name a copyright owner:
they are no part of a license, nor are the lines in which a list of owners goes on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.license_texts import KNOWN, PROSE, SPELLINGS, TITLES

_YEAR = r"\b(?:19|20)[0-9][0-9]\b"
#: What begins a line that names owners: a copyright mark with a year or a second mark, or the word with a name, that is
#: anything but the words that license texts put after it.
_OWNER = rf"copyright\b[^\n]*?(?:\(c\)|©|{_YEAR})|\(c\)[^\n]*?{_YEAR}|©|copyright[ \t]+(?=\S)(?!(?:{'|'.join(PROSE)})\b)"
#: Whole lines, each ended by what follows it: owners, with the next line as long as a line ends with a comma, "and" or
#: "&"; and "All rights reserved".
COPYRIGHT_LINE = rf"(?imd)^[^\p{{L}}\p{{N}}\n]*(?:(?:{_OWNER})[^\n]*(?:(?<=(?:,|&|\band)[ \t\r]{{0,4}})\n[^\n]*)*|all rights reserved[^\p{{L}}\p{{N}}\n]*$)"
#: Most known digests that are broadcast (about 100 bytes each).
MAX_KNOWN = 100_000


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, no punctuation, equal spellings, single blanks."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT_LINE, "")
    # Two blanks between words: every word has one of its own on either side, so neighbours can both be replaced.
    words = F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.lower(bare), r"[^\p{L}\p{N}]+", "  ")), F.lit(" "))
    for spelling, plain in SPELLINGS:
        words = F.replace(words, F.lit(f" {spelling.replace(' ', '  ')} "), F.lit(f" {plain.replace(' ', '  ')} "))
    return F.btrim(F.replace(words, F.lit("  "), F.lit(" ")))


def known_licenses(spark: SparkSession) -> DataFrame:
    """(license, body, restricted): notices, whole texts, and whole texts below their titles."""
    rows = [(name, f"{title}\n\n{body}", restricted) for name, body, restricted in KNOWN for title in ["", *(TITLES.get(name, []) if "\n" in body else [])]]
    return spark.createDataFrame(rows, "license string, body string, restricted boolean")


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, text_digest, text_license, n_license_lines, licenses, restricted.

    A whole text or a line of it is a license if its canonical form has the digest of a known one. A text
    without letters or digits (null and empty too) has a null digest and matches nothing. Known licenses
    of one canonical form count under the first name. Rows that share id and text get equal results and
    keep their number. Very long texts are read whole. Other columns are not read; an empty table gives no rows.
    """
    digests = (
        known.withColumn("digest", F.when(canonical(F.col("body")) != "", F.sha2(canonical(F.col("body")), 256)))
        .where("digest is not null and license is not null")
        .groupBy("digest").agg(F.min("license").alias("license"), F.max("restricted").alias("restricted"))
    )
    if digests.limit(MAX_KNOWN + 1).count() <= MAX_KNOWN:
        digests = F.broadcast(digests)
    one = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.coalesce(F.octet_length(text_col), F.lit(-1)).alias("size"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.col("text").alias("body"))), F.transform(F.split("text", "\r?\n"), lambda x: F.struct(F.lit(False).alias("whole"), x.alias("body"))))
    each = one.select("id", "hash", "size", F.explode(pieces).alias("piece")).select("id", "hash", "size", "piece.whole", canonical(F.col("piece.body")).alias("body"))
    each = each.select("id", "hash", "size", "whole", F.when(F.col("body") != "", F.sha2("body", 256)).alias("digest"))
    # Only a whole text, or a line with a known digest, is worth shuffling.
    met = each.join(digests, "digest", "left").where("whole or license is not null")
    line = ~F.col("whole")
    return (
        met.groupBy("id", "hash", "size").agg(
            F.count(F.when(F.col("whole"), 1)).alias("rows"),
            F.max(F.when(F.col("whole"), F.col("digest"))).alias("text_digest"),
            F.max(F.when(F.col("whole"), F.col("license"))).alias("text_license"),
            F.count(F.when(line, 1)).alias("lines"),
            F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
            F.coalesce(F.max("restricted"), F.lit(False)).alias("restricted"),
        )
        .withColumn("_copy", F.explode(F.expr("sequence(1, cast(rows as int))")))
        .select(F.col("id").alias(id_col), "text_digest", "text_license", F.expr("lines div rows").alias("n_license_lines"), "licenses", "restricted")
    )
