"""Ranked lexical search against a plain scoring of every document, and its SQL."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from freshet.llm import lexical_search, queries
from tests.harness import compare

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, most=50):
    """Sorted (item, rank, id, score) by the definition; docs and items are lists of (id, text)."""
    words = [(i, Counter(cut(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in words), sum(sum(c.values()) for _, c in words)
    df = Counter(t for _, c in words for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        scored = []
        for i, c in words:
            m = 50 + 50 * sum(c.values()) * n_docs // total if total else 0
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(cut(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scored)[:most])]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


def made(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(2000)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    docs = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    docs += [(5, None), (6, ""), (7, "!?"), (None, texts[0]), (None, texts[1]), (8, texts[0]), (8, texts[0]), (9, "Ünï w1 W2 naïve w1"), (10, "w3 " * 3000)]
    docs += [(2000 + i, texts[2]) for i in range(300)]  # a large group of copies
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 25)))) for i in range(40)]
    items += [(3, "w1 W1 w1"), (3, "w1 W1 w1"), (3, texts[2]), (4, None), (5, ""), (6, "nowhere"), (None, "w2 w5"), (99, "NAÏVE naïve ünï")]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"block_rows": 37, "bundle": 5, "owners": 5}, {"max_terms": 3, "block_rows": 50, "owners": 2}, {"owners": 1, "most": 3, "block_rows": 16}])
def test_equals_plain_scoring(spark, options):
    docs, items = made(500, 2)
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string").repartition(3)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int").repartition(2)
    assert got(lexical_search.ranked(d, q, **options)) == plain(docs, items, options.get("most", 50))


def test_accumulators_that_cannot_win_are_dropped(spark, monkeypatch):
    """The rare terms of an item come first; after them hardly any document that lacks them stays."""
    docs = [(i, "common often " + ("rare" if i < 60 else f"x{i}")) for i in range(2000)]
    kept = []
    plain_save = lexical_search.Scratch.save

    def save(self, df, name):
        out = plain_save(self, df, name)
        if name.startswith("state"):
            kept.append(sum(len(h["at"]) for r in out.select("held").collect() for h in r["held"]))
        return out

    monkeypatch.setattr(lexical_search.Scratch, "save", save)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame([(1, "rare common often")], "item_id long, text string")
    assert got(lexical_search.ranked(d, q)) == plain(docs, [(1, "rare common often")])
    assert max(kept) <= 60 + 50


def test_lengths_beyond_64_bits_and_empty_tables(spark):
    n = np.array([10**6, 3], np.int32)
    assert lexical_search.scaled_lengths(n, 10**14, 10**15).tolist() == [50 + 50 * 10**6 * 10**14 // 10**15, 50 + 15]
    none = spark.createDataFrame([], "doc_id long, text string")
    no_items = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    item = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert got(lexical_search.ranked(none, item)) == [] and got(lexical_search.ranked(one, no_items)) == []
    assert got(lexical_search.ranked(one, item)) == plain([(1, "a b")], [(1, "a b")])
    assert got(lexical_search.ranked(one.selectExpr("doc_id", "cast(null as string) text"), item)) == []


def test_whole_tables_equal_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        assert compare(spark, "op12", queries.op12_lexical_search, queries.ORACLE_SQL["op12_lexical_search"], f"/root/testdata/{sf}") == []
