"""A corpus pipeline: five operators in a row, each over what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import decontaminate, jaccard_join, mixing, secret_scan, toxicity
from freshet.llm.scratch import Scratch

#: Documents that score at least this go.
TOXIC = 0.7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity model rejects; it is trained on all labels of ``docs``. Null and empty texts
    stay (they have no hits), repeated rows stay or go together, very long texts are scored whole; an empty table stays
    empty."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.below(docs, model, TOXIC)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of similar ones: that of the smallest id, of one id that of the smallest
    hash; a null id comes last. Texts without words stay, rows that repeat id and text are one."""
    no_id, text = F.col("doc_id").isNull(), F.col("text")
    name = F.struct(no_id.alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64(text).alias("hash"), F.coalesce(F.octet_length(text), F.lit(-1)).alias("size"))
    found = jaccard_join.similar_components(docs.select(name.alias("name"), "text"), id_col="name")
    kept = found.where("name = component_id").select(*[F.col(f"name.{x}").alias(f"_{x}") for x in ("no_id", "id", "hash", "size")]).distinct()
    same = [name[x] == F.col(f"_{x}") for x in ("id", "hash", "size", "no_id")]
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"]).select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of a benchmark item. Null and empty texts stay, very long ones are read
    whole; an empty table stays empty."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets masked in the texts, n_chars counted anew (null for a null text). No row goes; very long texts are read
    whole; an empty table stays empty."""
    masked = secret_scan.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the mixture, with their weight and number of copies. A null source is the source ''; texts
    without tokens are drawn with their block, and sources without any tokens are not drawn; an empty table stays
    empty."""
    drawn = mixing.mixed(docs)
    return drawn.where("copies > 0").select(*docs.columns, "n_tokens", "weight", "copies", "block")


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
]

#: A learned score has no SQL form; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to a shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    scratch = Scratch(spark)
    before = None
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
