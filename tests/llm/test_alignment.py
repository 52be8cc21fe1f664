"""Cross-tokenizer alignment against the libraries' encodings of whole texts and a plain merge."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from freshet.llm import queries, token_align

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def plain(texts):
    """One tuple a text, by the definition."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    tools = token_align.Tokenizers(A, B)
    rows, links = [], []
    for text in texts:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        joined = [b"".join(names[i] for i in ids) for names, ids in ((tools.bytes_a, ids_a), (tools.bytes_b, ids_b))]
        if not text or any(x != (" " + text).encode() for x in joined):
            rows.append((0, 0, 0, ""))
            links.append([])
            continue
        ends = []
        for names, ids in ((tools.bytes_a, ids_a), (tools.bytes_b, ids_b)):
            at, out = 0, []
            for i in ids:
                at += len(names[i])
                out.append(at)
            ends.append(out)
        common = set(ends[0]) & set(ends[1])
        held, groups = [[], []], defaultdict(lambda: ([], []))
        for side, ids in enumerate((ids_a, ids_b)):
            g = 0
            for i, e in zip(ids, ends[side]):
                groups[g][side].append(i)
                g += e in common
        del held
        last = [dict(zip(e, ids)) for e, ids in zip(ends, (ids_a, ids_b))]
        links.append([(last[0][e], last[1][e]) for e in sorted(common)])
        said = ";".join("|".join(",".join(map(str, side)) for side in groups[g]) for g in sorted(groups))
        rows.append((len(ids_a), len(ids_b), len(groups), hashlib.sha256(said.encode()).hexdigest()))
    count = Counter(x for y in links for x in y)
    best = defaultdict(int)
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return [(n_a, n_b, n_groups, len(x), sum(count[p] == best[p[1]] for p in x), sum(count[p] for p in x), digest) for (n_a, n_b, n_groups, digest), x in zip(rows, links)]


def got(df, key="doc_id"):
    return sorted((r[key] is None, r[key] or 0, r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in df.collect())


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    parts = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\r", ";\r", "　", " ", "▁", "é", "é", "中文字", "😀", "<s>", "</s>", "<|endoftext|>", "<0x0A>", "'s", "123", "foo.bar", "ＡＢ", "\x00", "\x1c", " ", ".", " \n", "﻿", "{", "}", "Ω≈ç"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_whole_table_equals_plain_merge(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((False, r["doc_id"], *x) for r, x in zip(docs, plain([r["text"] for r in docs])))
    assert got(queries.op11_token_alignment(spark, sf)) == want


def test_odd_texts_and_pairs_beyond_the_broadcast(spark):
    texts = [*odd_texts(400), None, "", " ", "  ", "\n", "x", "x", " lead", "trail ", "a\n b", "a\n  b", "a　  b"]
    df = spark.createDataFrame([(i if i % 9 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, key string").repartition(3)
    want = sorted(((i % 9 == 0), i if i % 9 else 0, *x) for i, x in enumerate(plain(texts)))
    few, pairs = token_align.alignment(df, A, B, common=5)
    assert got(few) == want
    assert got(token_align.alignment(df, A, B)[0]) == want
    assert pairs.groupBy("b").agg({"n": "max"}).count() == pairs.where("best").select("b").distinct().count()


def test_long_texts_move_in_segments_and_lanes(spark, monkeypatch):
    words = ["retion", "the", "a,", "naïve", "ellec.\n", "x=1;", "über"]
    rng = random.Random(1)
    text = " ".join(rng.choice(words) for _ in range(4000))
    texts = [text, "y" * 3000 + " " + "z" * 5000, text + "▁", "é" * 4000]
    tools = token_align.Tokenizers(A, B)
    monkeypatch.setattr(token_align, "BATCH_BYTES", 1000)
    monkeypatch.setitem(token_align._loaded, (A, B), tools)
    want = plain(texts)
    segments = [token_align._segments(t.encode()) for t in texts]
    assert len(segments[0]) > 15 and b" ".join(segments[0]).decode() == text
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert got(token_align.alignment(df, A, B)[0]) == sorted((False, i, *x) for i, x in enumerate(want))
    run = token_align._align((A, B))  # in this process, where the bound is 1,000 bytes

    class Context:
        partitionId = staticmethod(lambda: 0)

    import pyarrow as pa
    import pyspark

    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(lambda: Context))
    rows = [r for b in run([pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(texts)], names=["id", "text"])]) for r in b.to_pylist() if r["key"] is not None]
    assert [(r["n_a"], r["n_b"], r["n_groups"], r["groups_sha256"]) for r in rows] == [(x[0], x[1], x[2], x[6]) for x in want]


def test_empty_table(spark):
    texts, pairs = token_align.alignment(spark.createDataFrame([], "doc_id long, text string"), A, B)
    assert texts.count() == 0 and pairs.count() == 0 and texts.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_tokenizers_that_do_not_separate_get_whole_texts(spark):
    assert not token_align.separates({"pre_tokenizer": {"type": "ByteLevel", "use_regex": True}}, ["a▁b"])
    assert not token_align.separates({"normalizer": {"type": "NFC"}, "pre_tokenizer": {"type": "ByteLevel", "use_regex": True}}, ["a"])
    tools = token_align.Tokenizers(A, B)
    assert tools.cuts
    tools.cuts = False
    texts = [t.encode() for t in odd_texts(50, 5)]
    whole = [tools.numbers([t])[0] for t in texts]
    fine = [t for t, n in zip(texts, whole) if tools.fine[n].all()]
    found = token_align.aligned([n for n in whole if tools.fine[n].all()], tools)
    assert [tuple(x) for x in zip(found["n_a"], found["n_b"], found["n_groups"])] == [x[:3] for x in plain([t.decode() for t in fine])]
