"""Toxicity scores: a lexicon learned from labels, matched with misspellings, read in context.

Stems that toxic texts use far more often than clean ones make the lexicon. Each document is described by
its exact, misspelled and quoted hits; a logistic regression over these gives the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.lexicon_trie import LexiconTrie
from freshet.llm.scratch import Scratch
from freshet.llm.textbytes import small_batches

#: Most labelled rows that lexicon and regression are fitted on; of more, the first by id hash.
MAX_LABELLED = 50_000
#: Least uses in toxic texts, distinct neighbourhoods (of 64) and ratio of rates of a term; lengths of stems.
MIN_USES, MIN_PLACES, MIN_RATIO = 5, 4, 5.0
STEM_LENGTHS = (4, 14)
#: Characters on either side of a hit in which quotation marks or cue words are looked for.
REACH = 40
WORD = re.compile(r"[^\W_]+")
OPENING, CLOSING = '"“„«‹‚‘', '"”“»›’‘'
# Words that report or discuss another word rather than use it.
CUES = {"said", "says", "called", "calls", "quote", "quoted", "term", "word", "insult", "slur", "genannt", "wort", "zitat", "sagte", "appelé", "mot", "dit", "citation", "palabra", "dijo", "llamado", "cita"}


@dataclass
class Model:
    terms: list[str]
    weights: np.ndarray  # (term, 0): log ratio of rates, 0 to 6; (term, 1): belief in its misspellings, 0 to 1
    coefficients: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def quoted(text: str, start: int, end: int) -> bool:
    """Whether the hit stands between quotation marks of its line, or shortly after a cue word."""
    before = text[max(0, start - REACH) : start].rpartition("\n")[2]
    after = text[end : end + REACH].partition("\n")[0]
    opened = max(map(before.rfind, OPENING))
    if opened >= 0 and any(x in after for x in CLOSING) and sum(before.count(x) for x in set(OPENING + CLOSING)) % 2:
        return True
    return not CUES.isdisjoint(WORD.findall(before.lower())[-3:])


def describe(text: str | None, trie: LexiconTrie) -> tuple[int, int, dict[int, int]]:
    """Words, quoted hits, and unquoted hits by 2 * term + edits."""
    text = text or ""
    lower = text.lower()
    words = WORD.findall(lower)
    match, known = trie.match, trie.words
    hit = {w for w in set(words) if (known[w] if w in known else match(w)) is not None}
    counts: dict[int, int] = {}
    n_quoted = 0
    if hit:
        for m in WORD.finditer(lower):
            if m[0] in hit:
                if quoted(lower, m.start(), m.end()):
                    n_quoted += 1
                else:
                    term, edits = match(m[0])
                    counts[2 * term + edits] = counts.get(2 * term + edits, 0) + 1
    return len(words), n_quoted, counts


def features(n_words: int, n_quoted: int, counts: dict[int, int], weights: np.ndarray) -> list[float]:
    """A misspelled hit counts as much as the belief that it is the term."""
    believed = [(k // 2, n * (weights[k // 2, 1] if k % 2 else 1.0)) for k, n in counts.items()]
    uses = sum(n for _, n in believed)
    strong = sum(n * weights[t, 0] for t, n in believed)
    kinds = len({t for t, n in believed if n >= 0.5})
    rate = 100 * strong / max(n_words, 20)
    return [min(uses, 12.0), np.log1p(strong), min(kinds, 8), np.log1p(rate), np.log1p(n_words), np.log1p(n_quoted), float(uses >= 2)]


FEATURES = 7


def _labelled(docs: DataFrame, labels: DataFrame, usable) -> DataFrame:
    """(text, y) of at most MAX_LABELLED usable rows, the first by id hash; their labels are broadcast, 16 bytes each."""
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    share = min(1.0, 1.05 * MAX_LABELLED / max(1, marks.count()))
    drawn = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), "doc_id").limit(MAX_LABELLED)
    return docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", "y")


def _word_uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic, clean, places): uses by label; places has a bit for the hash of each word before."""
    from zlib import crc32

    uses: dict[str, list[int]] = {}
    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            before = 0
            for word in WORD.findall((text or "").lower()):
                row = uses.setdefault(word, [0, 0, 0])
                row[0 if y else 1] += 1
                if y:
                    row[2] |= 1 << before
                    before = crc32(word.encode()) & 63
        if len(uses) > 300_000:
            yield _uses(uses)
            uses = {}
    if uses:
        yield _uses(uses)


def _uses(uses: dict[str, list[int]]) -> pa.RecordBatch:
    rows = list(uses.values())
    places = np.array([r[2] for r in rows], np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(list(uses)), pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array(places)], names=["word", "toxic", "clean", "places"])


def learn_terms(labelled: DataFrame, scratch: Scratch) -> list[str]:
    """Stems by the likelihood ratio of their use in toxic texts, none the beginning of another.

    Every stem that passes the tests of support and ratio takes part; the labelled sample bounds how many can.
    Null texts have no words; of stems that are alike in use the longer, then the first by name, goes first.
    """
    words = labelled.mapInArrow(_word_uses, "word string, toxic long, clean long, places long")
    words = scratch.save(words.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("places").alias("places")), "words")
    low, high = STEM_LENGTHS
    stems = words.where(F.length("word") >= low).select(F.explode(F.transform(F.sequence(F.lit(low), F.least(F.length("word"), F.lit(high))), lambda n: F.substring("word", F.lit(1), n))).alias("stem"), "toxic", "clean", "places")
    uses = stems.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("places").alias("places"))
    total = words.agg(F.sum("toxic"), F.sum("clean")).first()
    all_toxic, all_clean = (float(x or 0) + 1 for x in total)
    share = all_toxic / (all_toxic + all_clean)
    n = F.col("toxic") + F.col("clean")
    ratio = (F.col("toxic") / all_toxic) / ((F.col("clean") + 0.5) / all_clean)
    gain = F.col("toxic") * F.log(F.col("toxic") / (n * share)) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (n * (1 - share)))).otherwise(0.0)
    best = uses.where((F.col("toxic") >= MIN_USES) & (F.bit_count("places") >= MIN_PLACES) & (ratio >= MIN_RATIO)).select("stem", gain.alias("gain")).collect()
    terms: dict[str, None] = {}
    begun: set[str] = set()  # beginnings of the terms
    for r in sorted(best, key=lambda r: (-r["gain"], -len(r["stem"]), r["stem"])):
        starts = [r["stem"][:k] for k in range(low, len(r["stem"]) + 1)]
        if r["stem"] not in begun and not any(x in terms for x in starts):
            terms[r["stem"]] = None
            begun.update(starts)
    return list(terms)


def _descriptions(terms: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = LexiconTrie(terms)
        for batch in batches:
            rows = [describe(t, trie) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([list(r[2]) for r in rows], pa.list_(pa.int32())), pa.array([list(r[2].values()) for r in rows], pa.list_(pa.int32())), batch.column(1).cast(pa.int64())],
                names=["n_words", "n_quoted", "hits", "uses", "y"],
            )

    return run


def train(docs: DataFrame, labels: DataFrame, usable) -> Model:
    """``usable``: a condition on labels. Without labels of both kinds every score is 0.5 * (share of toxic). Labels of null
    id or value are not used, of several for an id the largest counts; null texts have no words, very long ones are read
    whole, repeated documents count each time; columns other than doc_id, text and toxic are not read; empty tables
    give a model without terms."""
    scratch = Scratch(docs.sparkSession)
    labelled = scratch.save(_labelled(docs, labels, usable), "labelled")
    terms = learn_terms(labelled, scratch)
    rows = labelled.mapInArrow(_descriptions(terms), "n_words long, n_quoted long, hits array<int>, uses array<int>, y long").toArrow().to_pylist()
    y = np.array([float(r["y"] > 0) for r in rows])
    counts = [dict(zip(r["hits"], r["uses"])) for r in rows]
    tallies = np.full((len(terms), 2, 2), 0.5)
    words = np.ones(2)
    for r, c, label in zip(rows, counts, y.astype(int)):
        words[label] += r["n_words"]
        for k, n in c.items():
            tallies[k // 2, k % 2, label] += n
    weights = np.clip(np.log(tallies[:, :, 1] / words[1]) - np.log(tallies[:, :, 0] / words[0]), 0, 6)
    # Forms that clean texts hold as often as toxic ones are other words; forms never seen are misspellings.
    toxic, clean = tallies[:, 1, 1] - 0.5, (tallies[:, 1, 0] - 0.5) * words[1] / words[0]
    weights[:, 1] = np.clip((toxic + 1 - clean - 2 * np.sqrt(clean)) / (toxic + 1), 0, 1)
    x = np.array([features(r["n_words"], r["n_quoted"], c, weights) for r, c in zip(rows, counts)]).reshape(len(rows), FEATURES)
    mean, scale = (x.mean(0), x.std(0) + 1e-9) if len(x) else (np.zeros(FEATURES), np.ones(FEATURES))
    scratch.close()
    return Model(terms, weights, fit(scaled(x, mean, scale), y), mean, scale)


def scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """In standard deviations, at most four either way: a text unlike all labelled ones is not extrapolated."""
    return np.clip((x - mean) / scale, -4, 4)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method; the last coefficient is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x.shape[1])
    beta[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    if not 0 < y.sum() < len(y):
        return beta
    penalty = np.eye(len(beta)) * ridge
    penalty[-1, -1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score (0 to 1), n_hits, n_quoted. Null text counts as empty, and an empty
    text is scored like one without hits. Very long texts are scored whole, one by one. The model is broadcast;
    the labelled sample bounds it. No other column is read; rows that share an id keep their number; an empty
    table gives no rows.
    """
    return _scored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model, 1, 1).withColumnRenamed("id", id_col)


def below(docs: DataFrame, model: Model, limit: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that score less than ``limit``. Null and empty texts score like texts
    without hits, very long ones are scored whole, repeated rows stay or go together; an empty table stays empty."""
    at = docs.columns.index(text_col)
    return _scored(docs, model, at, len(docs.columns), limit).select(docs.columns)


def _scored(docs: DataFrame, model: Model, at: int, keep: int, limit: float | None = None) -> DataFrame:
    """The first ``keep`` columns with score, n_hits and n_quoted of the text in column ``at``; with a ``limit``,
    only those columns of rows that score less."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        trie = LexiconTrie(m.terms)
        for batch in small_batches(batches, at):
            rows = [describe(t, trie) for t in batch.column(at).to_pylist()]
            x = scaled(np.array([features(*r, m.weights) for r in rows]).reshape(len(rows), FEATURES), m.mean, m.scale)
            score = 1 / (1 + np.exp(-np.clip(x @ m.coefficients[:-1] + m.coefficients[-1], -30, 30)))
            if limit is not None:
                yield batch.filter(pa.array(score < limit))
                continue
            more = [pa.array(score), pa.array([sum(r[2].values()) for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], *more], names=[*batch.schema.names[:keep], "score", "n_hits", "n_quoted"])

    if limit is not None:
        return docs.mapInArrow(run, docs.schema)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:keep])
    return docs.mapInArrow(run, f"{kinds}, score double, n_hits long, n_quoted long")
