"""Components, mixing, and the pipeline against a plain version of its stages."""

import math
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from freshet.llm import mixing, toxicity
from freshet.llm.components import components
from freshet.llm.scratch import Scratch
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("kind", ["path", "star", "random", "none", "hubs"])
def test_components(spark, kind, monkeypatch):
    rng = random.Random(3)
    n = 300
    if kind == "hubs":
        monkeypatch.setattr("freshet.llm.components.HUB", 3)
        monkeypatch.setattr("freshet.llm.components.RUN_LINKS", 20)
    links = {"hubs": [(rng.choice([7, 150, 299, 40 + i % 3]), rng.randrange(n)) for i in range(250)], "path": [(i, i + 1) for i in range(n)], "star": [(0, i) for i in range(1, n)], "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(180)], "none": []}[kind]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "u long, v long").repartition(7)
    got = {r.node: r.component for r in components(df, Scratch(spark), "c").collect()}
    want = {k: v for k, v in brute.union_find(range(n + 1), links).items() if k != v}
    assert got == want


def test_components_of_structs(spark):
    df = spark.createDataFrame([((1, 5), (1, 2)), ((0, 9), (1, 2))], "u struct<a:int,b:int>, v struct<a:int,b:int>")
    assert {(tuple(r.node), tuple(r.component)) for r in components(df, Scratch(spark), "c").collect()} == {((1, 5), (0, 9)), ((1, 2), (0, 9))}


def test_power():
    tokens = [1000, 100, 10]
    mix = mixing.Mix(evenness=0.9, max_repeats=1e9)
    w = mixing.weights_at(tokens, mixing.solve_power(tokens, mix))
    assert -sum(x * math.log(x) for x in w) / math.log(3) == pytest.approx(0.9)
    mix = mixing.Mix(evenness=0.9, max_repeats=5)
    w = mixing.weights_at(tokens, mixing.solve_power(tokens, mix))
    assert max(x * 1110 / t for x, t in zip(w, tokens)) == pytest.approx(5)
    assert mixing.solve_power([5, 5, 5], mixing.Mix()) == 1.0 and mixing.solve_power([], mixing.Mix()) == 1.0
    assert mixing.weights_at([5], 0.3) == [1.0]


def test_mixed(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), "big" if i % 10 < 7 else "mid" if i % 10 < 9 else "small", 3, 4) for i in range(600)]
    rows += [(1000, None, "big", 1, 1), (1001, "", "none", 1, 1), (1002, "a b", None, 1, 1), (1003, "c d", "", 1, 1), (0, rows[0][1], "big", 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, block int, tokens int")
    mix = mixing.Mix(evenness=0.98, max_repeats=3.0, block_tokens=500)
    out = mixing.mixed(docs, mix).collect()
    assert len(out) == len(rows)
    have, drawn, weight = {}, {}, {}
    for r in out:
        s = r.source or ""
        n = len((r.text or "").split())
        assert r.n_tokens == n
        have[s] = have.get(s, 0) + n
        drawn[s] = drawn.get(s, 0) + n * r.copies
        weight[s] = r.weight
    total = sum(have.values())
    assert weight["none"] == 0.0 and sum(weight.values()) == pytest.approx(1, abs=1e-6)
    for s in ("big", "mid", "small"):
        want = weight[s] * total
        assert want - 45 <= drawn[s] <= want + 1e-6 * total
        copies = {r.copies for r in out if r.source == s}
        assert copies <= {math.floor(want / have[s]), math.floor(want / have[s]) + 1}
    for most in (mixing.MAX_BLOCKS, 0):  # blocks are broadcast, or joined
        monkeypatch.setattr(mixing, "MAX_BLOCKS", most)
        again = {(r.doc_id, r.text): r.copies for r in mixing.mixed(docs.repartition(5), mix).collect()}
        assert again == {(r.doc_id, r.text): r.copies for r in out}
    assert mixing.mixed(docs.limit(0), mix).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), F.lit(True))
    scores = {r.doc_id: r.score for r in toxicity.predict(docs, model).collect()}
    kept = [i for i in sorted(rows) if scores[i] < corpus_pipeline.TOXIC]
    groups = brute.jaccard_components([(i, rows[i]) for i in kept])
    kept = [i for i in kept if groups[i][1] == i]
    kept = [i for i in kept if not brute.contamination(rows[i], bench)[4]]
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) <= set(kept) and len(kept) - len(out) < 0.6 * len(kept)
    for i, r in out.items():
        assert not brute.secret_base(r.text) and r.n_chars == len(r.text) and r.copies >= 1
        if not brute.secret_base(rows[i]):
            assert r.text == rows[i]
    staged = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        staged = stage(spark, staged, SF)
        assert staged.columns == docs.columns
    assert {r.doc_id for r in staged.collect()} == set(kept)


def test_one_of_each_group_stays_though_ids_repeat(spark):
    """A near copy goes even if its id also has a text that stays."""
    base, other = (" ".join(f"{p}{i}" for i in range(60)) for p in "ab")
    rows = [(1, base), (2, base + " tail"), (2, other), (5, other), (None, other), (7, None), (7, ""), (2, base + " tail"), (3, "few words"), (3, "few words too")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()), key=str)
    assert got == sorted([(1, base), (2, other), (7, None), (7, ""), (3, "few words"), (3, "few words too")], key=str)


def test_pipeline_copies_and_weights(spark):
    """Copies and weights of the whole result, by the SQL of the mixing operator over what reaches the last stage."""
    import duckdb

    from freshet.llm import oracles

    staged = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        staged = stage(spark, staged, SF)
    documents = staged.toPandas()  # noqa: F841  (read by DuckDB)
    con = duckdb.connect()
    con.register("documents", documents)
    want = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, n_tokens, weight, copies, block FROM ({oracles.MIXING}) WHERE copies > 0").fetchall()}
    got = {r.doc_id: (r.n_tokens, r.weight, r.copies, r.block) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and len(got) > 50


def test_many_blocks_of_one_source(spark):
    """A source of thousands of blocks: what is drawn stays within its share."""
    docs = spark.range(20_000).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 7 as int)) as text", "if(id % 3 = 0, 'a', 'b') as source")
    mix = mixing.Mix(block_tokens=8, budget=0.5)
    rows = mixing.mixed(docs, mix).groupBy("source").agg(F.sum("n_tokens").alias("have"), F.sum(F.col("n_tokens") * F.col("copies")).alias("drawn"), F.max("weight").alias("weight"), F.countDistinct("block").alias("blocks")).collect()
    total = sum(r.have for r in rows)
    for r in rows:
        assert r.blocks > 2000 and r.weight * total / 2 - 8 <= r.drawn <= r.weight * total / 2 + 1


def test_a_source_of_texts_without_tokens_is_many_blocks(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "if(id = 7, 'one two', '') as text", "'a' as source").union(spark.range(10).selectExpr("id + 9000", "repeat('w ', 300)", "'b'"))
    rows = mixing.mixed(docs, mixing.Mix(block_rows=50)).where("source = 'a'").groupBy("block").count().collect()
    assert len(rows) > 80
    assert max(r["count"] for r in rows) < 120


def test_texts_longer_than_a_block_are_drawn_whole(spark):
    docs = spark.range(6).selectExpr("id as doc_id", "repeat('w ', cast(200000 * (1 + id % 2) as int)) as text", "'a' as source")
    rows = mixing.mixed(docs, mixing.Mix(block_tokens=1000)).collect()
    assert {r.copies for r in rows} == {1} and sorted(r.n_tokens for r in rows) == [200_000] * 3 + [400_000] * 3


def test_stages_over_hard_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "some words here", "en", None, 15), (3, "some words here", "en", "a", 15), (3, "some words here", "en", "a", 15), (4, "password: abcdefgh12", "en", "b", 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    # After each stage: no text is toxic; the copy of 3 and the row of null id, which has the same text, go; nothing is in
    # the benchmark; the secret is masked; the source of texts without tokens is not drawn.
    kept = [[1, 2, 3, 3, 4, None], [1, 2, 3, 4], [1, 2, 3, 4], [1, 2, 3, 4]]
    frame, none = docs, docs.limit(0)
    for (name, stage), want in zip(corpus_pipeline.STAGES, [*kept, None]):
        frame, none = stage(spark, frame, SF), stage(spark, none, SF)
        rows = frame.collect()
        assert none.count() == 0
        if want is not None:
            assert sorted((r.doc_id for r in rows), key=lambda x: (x is None, x)) == want, name
    assert {r.doc_id for r in rows} <= {1, 2, 3, 4} and {3, 4} <= {r.doc_id for r in rows} and all(r.copies > 0 for r in rows)
    assert [r.text for r in rows if r.doc_id == 4] == ["[secret]"]
