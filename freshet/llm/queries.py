"""Registered queries of the operators in this subpackage: one for each, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import decontaminate, embedding_dedup, jaccard_join, language_id, lexical_search, license_scan, lm_score, mixing, neighbours, oracles, secret_scan, token_align, token_count, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(n: int, column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string")) % n


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document; the tokenizer file is a parameter of the operator."""
    import public_tokenizers

    return token_count.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of every document; a third of them by id is held out of training."""
    docs = _table(spark, sf_dir, "documents")
    held = F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out")
    model = language_id.train(docs.where(_fold(3) != 1).select("text", "lang"))
    tagged = docs.select(F.struct("doc_id", held).alias("key"), "text")
    found = language_id.predict(tagged, model, id_col="key")
    language_id.close(model)
    return found.select("key.doc_id", "key.held_out", "lang_pred", "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a third of the labels by id is held out of training."""
    docs = _table(spark, sf_dir, "documents")
    held = F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), _fold(3) != 1)
    scored = toxicity.predict(docs.select(F.struct("doc_id", held).alias("key"), "text"), model, id_col="key")
    return scored.select("key.doc_id", "key.held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_hits", "n_quoted")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and base scores of every document; a seventh by id is held out of training (a null id is not)."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm_score.score(docs, ~F.coalesce(_fold(7) == 2, F.lit(False)))
    return scored.select("doc_id", (~F.col("in_training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License statements of every document, whole or as lines."""
    docs = _table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.known_licenses(spark))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-identical documents."""
    return jaccard_join.similar_components(_table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base spans by pattern, and the spans that entropy adds."""
    found = secret_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def kind(rank: int):
        return F.size(F.filter("base_spans", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        "doc_id", kind(0).alias("n_assign"), kind(1).alias("n_access"), kind(2).alias("n_hex"),
        F.sha2(secret_scan.span_text(F.col("base_spans")), 256).alias("base_sha256"), secret_scan.span_text(F.col("all_spans")).alias("spans"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is drawn for a mixture of sources to target weights."""
    drawn = mixing.mixed(_table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "source", "n_tokens", "weight", "copies", "block")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-identical embeddings of one label."""
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.93)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two public tokenizers that end together in every document."""
    import public_tokenizers

    texts, _ = token_align.alignment(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return texts


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical_search.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors, of those found, of every vector whose id is divisible by 20."""
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_language_id, op3_license_scan, op4_toxicity, op5_lm_score, op6_jaccard_join, op7_secret_scan, op8_decontamination, op9_mixing, op10_embedding_dedup, op11_token_alignment, op12_lexical_search, op13_nearest_neighbours)}
ORACLE_SQL: dict[str, str] = oracles.ORACLE_SQL
