"""Operators over texts against brute force: nulls, empty and long texts, repeated rows, other columns."""

import math
import os
import random
import re
import textwrap
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from freshet.llm import decontaminate, jaccard_join, language_id, license_scan, license_texts, lm_score, ppm, queries, secret_scan, textbytes, token_count, toxicity
from freshet.llm.lexicon_trie import LexiconTrie
from freshet.llm.scratch import Scratch
from tests.harness import compare
from tests.llm import brute

SF = "/root/testdata/sf0.001"
WORDS = "the of river flow basin rain gauge storm delta mouth bank reach stage crest flood plain".split()
TRICKY = [None, "", " \t\n ", "One", "one  TWO three", "Été à Zürich, ça va? ÉTÉ", "x" * 5000, "a\u0000b c", "it's   we'll <|endoftext|> 123 !!", "é café", "日本語 テスト", "𝄞 music 𝄞", " line space"]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", "er"]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rows = [prose(i, 30 + 7 * i) for i in range(25)]
    rows += [rows[3], rows[3].upper(), rows[4] + " tail", rows[24] + " more words", *TRICKY, TRICKY[3]]
    return rows


def frame(spark, texts, schema="doc_id long, text string, id string, n long, word string, source string"):
    return spark.createDataFrame([(i, t, "x", 5, "w", f"s{i % 3}") for i, t in enumerate(texts)], schema)


def twice(df):
    """Every row again: same ids, same texts."""
    return df.union(df)


def test_token_counts(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    long = " ".join(prose(99, 40_000).split()) + "\n" + "z" * 3000
    docs = frame(spark, [*texts, long])
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    want = [len(e) for e in Tokenizer.from_file(path).encode_batch([t or "" for t in [*texts, long]], add_special_tokens=False)]
    got = {r.doc_id: r for r in token_count.token_counts(docs, path).collect()}
    assert [got[i].n_tokens for i in range(len(want))] == want
    assert [got[i].n_bytes for i in range(len(texts))] == [len((t or "").encode()) for t in texts]
    assert got[len(texts)].over_limit and not got[0].over_limit
    assert token_count.token_counts(twice(docs), path).count() == 2 * docs.count()
    assert token_count.token_counts(docs.limit(0), path).count() == 0


def test_token_counts_of_runs_without_blanks(spark):
    """Long pieces are cut beside digits; other tokenizers encode whole texts. Both equal the library."""
    import public_tokenizers
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    rng = random.Random(11)
    marks = "abcXYZ0123456789+/=_-.'" + "\u0301\u0327é字ſ\u1e9e"
    texts = ["".join(rng.choices(marks, k=n)) for n in (5000, 9000, 20_000)] + ["".join(rng.choices("abcdef0123456789", k=50_000)), "漢字" * 3000, "it's1't2'll" * 900, "<|endoftext|>" * 500 + "1<|endoftext|>2" * 500, "a1\u0301" * 3000]
    texts += ["".join(rng.choices(marks, k=rng.randrange(60))) for _ in range(300)]
    path = public_tokenizers.path("word_bpe_49k.json")
    assert token_count._Encoder(path).cuts
    assert max(map(len, token_count.safe_pieces(texts[3].encode()))) < 100
    want = [len(e) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert token_count.count_texts([t.encode() for t in texts], path) == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.n_tokens for r in token_count.token_counts(docs, path).orderBy("doc_id").collect()] == want
    for other in sorted(x for x in os.listdir(os.path.dirname(path)) if x.endswith(".json")):
        other = public_tokenizers.path(other)
        try:
            whole = Tokenizer.from_file(other)
        except Exception:  # noqa: BLE001, S112  (a file of another kind)
            continue
        whole.no_truncation()
        whole.no_padding()
        few = ["  two  blanks\n\nand lines ", texts[0][:500], *texts[-20:]]
        assert token_count.count_texts([t.encode() for t in few], other) == [len(e) for e in whole.encode_batch(few, add_special_tokens=False)], other


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    texts = ["é" * 10, None, "x" * 50, "", "y" * 5, "z" * 5]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["i", "t"])
    parts = [p.column(0).to_pylist() for p in textbytes.byte_batches([batch.slice(0, 6)], 1, 25)]
    assert parts == [[0, 1], [2], [3, 4, 5]]


def plain_ppm(texts, order, whole=True):
    """Counts by context string; PPM with escape D and exclusion, one symbol at a time. Not ``whole``: the bits
    of the last symbol of a gram."""
    counts = {}
    for t in texts:
        s = "\0" * order + t + "\0"
        for i in range(order, len(s)):
            for k in range(order + 1):
                row = counts.setdefault(s[i - k : i], {})
                row[s[i]] = row.get(s[i], 0) + 1

    def bits(text):
        s, total = "\0" * order + text + "\0" if whole else text, 0.0
        for i in range(order, len(s)):
            excluded = set()
            for k in range(order, -1, -1):
                row = {a: n for a, n in counts.get(s[i - k : i], {}).items() if a not in excluded}
                if s[i - k : i] not in counts or not row:
                    continue
                mass = 2 * sum(row.values())
                if s[i] in row:
                    total -= math.log2((2 * row[s[i]] - 1) / mass)
                    break
                total -= math.log2(len(row) / mass)
                excluded |= set(row)
            else:
                total += math.log2(256 - len(excluded))
        return total

    return bits


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_code_lengths_equal_symbol_by_symbol_coding(spark, order):
    """Of grams that training texts have, and of all others; over the symbols of a context they are a distribution."""
    train = ["the river ran", "the rain ran", "", "then the river rose", "aaaa"]
    texts = spark.createDataFrame([(t,) for t in train], "text string")
    scratch = Scratch(spark)
    levels = ppm.Levels(scratch.save(ppm.count_grams(texts, order, lambda t: t), "grams"), order, scratch)
    codes = ppm.gram_counts([t.encode() for t in ["the river", "", "xyz the", "rain rose then", "aaaaab"]], order)[0]
    context = int(codes[len(codes) // 2]) >> 8 << 8
    asked = sorted({int(c) for c in codes} | {context + x for x in range(256)})
    wanted = spark.createDataFrame([("", c) for c in asked], "by string, code long")
    seen = {r.code: r.bits for r in levels.seen().collect()}
    got = seen | {r.code: r.bits for r in levels.unseen(wanted.where(~F.col("code").isin(list(seen)))).collect()}
    bits = plain_ppm(train, order, whole=False)
    for c in asked:
        gram = c.to_bytes(order + 1, "big").decode("latin-1")
        assert got[c] == pytest.approx(bits(gram), rel=1e-9), gram
    assert sum(2 ** -got[context + x] for x in range(256)) == pytest.approx(1.0, abs=1e-9)
    scratch.close()


def test_many_windows_cost_the_same():
    text = prose(5, 3000).encode()
    codes, counts = ppm.gram_counts([text, b"x", text], 3)
    held, ppm.WINDOW = ppm.WINDOW, 1000
    try:
        again = ppm.gram_counts([text, b"x", text], 3)
        assert np.array_equal(again[0], codes) and np.array_equal(again[1], counts)
    finally:
        ppm.WINDOW = held


def test_language_id(spark):
    de, fr = "der die und ist nicht schlüssel straße über", "le la et est été naïve français où"
    rows = [(i, " ".join(random.Random(i).choices((de if i % 2 else fr).split(), k=30)), "de" if i % 2 else "fr") for i in range(60)]
    docs = spark.createDataFrame(rows + [(60, None, "de"), (61, "", "de"), (62, "123 !!", "fr"), (63, "die straße", None), (None, "le naïve", "fr")], "doc_id long, text string, lang string")
    model = language_id.train(docs.where("doc_id % 3 = 0"))
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert all(got[i].lang_pred == ("de" if i % 2 else "fr") for i in range(60))
    assert [got[i].lang_pred for i in (60, 61, 62, 63)] == ["und", "und", "und", "de"] and got[60].score == 0.0
    assert all(0 <= r.score <= 1 for r in got.values())
    none = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model).count() == 0


def test_language_id_keeps_every_language_and_context(spark):
    rng = random.Random(3)
    names = [f"l{i:02}" for i in range(70)]
    words = {x: ["".join(rng.choices("abcdefghij", k=5)) for _ in range(4)] for x in names}
    rows = [(i, " ".join(words[x] * 2), x) for i, x in enumerate([*names, *names[:60]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = {i: x for i, _, x in rows}
    bits = {x: plain_ppm([" ".join(words[x] * 2)] * (1 + (x < "l60")), 3) for x in names}
    prior = {x: math.log2(130 / (1 + (x < "l60"))) for x in names}
    for most, group in ((1 << 18, 100), (90, 40)):
        model = language_id.train(docs, max_contexts=most)
        probe = docs.withColumn("text", F.concat("text", F.lit(" zab")))
        got = {r.doc_id: r for r in language_id.predict(probe, model, group=group).collect()}
        assert {i: got[i].lang_pred for i in want} == want
        for i in (0, 65, 69):
            costs = [bits[x](rows[i][1] + " zab") + prior[x] for x in names]
            assert got[i].score == pytest.approx(1 / sum(2 ** (min(costs) - c) for c in costs), rel=1e-4)


def test_lm_score(spark, texts):
    docs = frame(spark, texts)
    training = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    flags = [zlib.crc32(str(i).encode()) % 7 != 2 for i in range(len(texts))]
    want = brute.base_score(texts, flags)
    for common in (1 << 17, 3):
        got = {r.doc_id: r for r in lm_score.score(docs, training, common_words=common, max_contexts=500).collect()}
        for i, (n, known, total, base) in enumerate(want):
            r = got[i]
            assert (r.n_tokens, r.n_known, r.train_tokens, r.in_training) == (n, known, total, flags[i])
            assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    bits = plain_ppm([" ".join(brute.ascii_words(t)).replace("\0", "\1").encode().decode("latin-1") for t, f in zip(texts, flags) if f], 2)
    got = {r.doc_id: r.score for r in lm_score.score(docs, training, order=2, max_contexts=1 << 16).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(-bits(" ".join(brute.ascii_words(t)).replace("\0", "\1").encode().decode("latin-1")) * math.log10(2), rel=1e-4)
    assert lm_score.score(twice(docs), training, max_contexts=50).count() == 2 * len(texts)
    none = lm_score.score(docs, F.lit(None).cast("boolean"), max_contexts=50).collect()
    assert {r.base_score for r in none} == {0.0} and {r.n_known for r in none} == {0}
    assert lm_score.score(docs.limit(0), training, max_contexts=50).count() == 0


@pytest.mark.parametrize("most", [20, 1 << 20])
def test_lm_score_of_many_batches_a_task(spark, most):
    """Words and grams that are not broadcast come back to the block of their own task and batch."""
    rng = random.Random(8)
    rows = [" ".join(rng.choice(WORDS) if rng.random() < 0.3 else f"w{rng.randrange(300)}" for _ in range(20 + i % 9)) for i in range(240)]
    docs = frame(spark, rows).repartitionByRange(3, "doc_id")
    flags = [i % 7 != 2 for i in range(len(rows))]
    bits = plain_ppm([t for t, f in zip(rows, flags) if f], 3)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = spark.conf.get(key)
    spark.conf.set(key, "16")
    try:
        got = {r.doc_id: r for r in lm_score.score(docs, F.col("doc_id") % 7 != 2, order=3, common_words=20, max_contexts=most).collect()}
    finally:
        spark.conf.set(key, held)
    for i, (n, known, total, base) in enumerate(brute.base_score(rows, flags)):
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (n, known, total)
        assert got[i].base_score == pytest.approx(base, rel=1e-9)
        assert got[i].score == pytest.approx(-bits(rows[i]) * math.log10(2), rel=1e-5)


def test_lm_query_with_odd_rows(spark, tmp_path):
    """A null id has no remainder, so it is learned from and not held out; bytes that are not UTF-8 are bytes of words."""
    rows = [(i, prose(i, 30).encode()) for i in range(20)] + [(None, b"Alpha the"), (None, None), (40, b"ok \xff\xfe Bad"), (41, b"\xff\xfe bad \xc3( bad"), (41, b"")]
    texts = [(t or b"").decode("latin-1") for _, t in rows]
    ids = pa.array([i for i, _ in rows], pa.int64())
    pq.write_table(pa.table({"doc_id": ids, "text": pa.array([t for _, t in rows], pa.binary()).view(pa.string())}), tmp_path / "documents.parquet")
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    assert any(held) and not all(held)
    want = Counter((i, h, n, k, t, f"{b:.9g}") for (i, _), h, (n, k, t, b) in zip(rows, held, brute.base_score(texts, [not h for h in held])))
    got = queries.op5_lm_score(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, f"{r.base_score:.9g}") for r in got) == want


@pytest.mark.parametrize("order", [2, 5])
def test_lm_score_keeps_every_context(spark, texts, order):
    docs = frame(spark, [*texts, "zq rain-gauge, reach", "riverriver flow"])
    training = F.col("doc_id") % 7 != 2
    coded = [" ".join(brute.ascii_words(r.text)).replace("\0", "\1").encode().decode("latin-1") for r in docs.orderBy("doc_id").collect()]
    bits = plain_ppm([t for i, t in enumerate(coded) if i % 7 != 2], order)
    want = [-bits(t) * math.log10(2) for t in coded]
    for most in (0, 50, 1 << 20):
        got = {r.doc_id: r.score for r in lm_score.score(docs, training, order=order, max_contexts=most).collect()}
        assert [got[i] for i in range(len(want))] == pytest.approx(want, rel=1e-6)


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(" ".join(part.split()), width) for part in text.split("\n\n"))


def test_license_scan(spark):
    body = "Licenced under the APACHE Licence, version 2.0"
    texts = ["Copyright (c) 2020 Someone\n" + body, f"prose\n{body}!!\nReleased under the MIT License.\nmore", None, "", "!!!", "prose about a license", "(c) 1999 A\n(C) 2000 B\nlicensed under cc by-nc 4.0"]
    docs = frame(spark, texts)
    known = license_scan.known_licenses(spark)
    got = {r.doc_id: r for r in license_scan.scan(docs, known).collect()}
    assert got[0].text_license == "Apache-2.0" and got[0].n_license_lines == 1
    assert got[1].licenses == "Apache-2.0,MIT" and got[1].text_license is None and got[1].n_license_lines == 2
    assert [got[i].text_digest for i in (2, 3, 4)] == [None] * 3 and got[5].licenses == ""
    assert got[6].text_license == "CC-BY-NC-4.0" and got[6].restricted and not got[1].restricted
    assert license_scan.scan(twice(docs), known).count() == 2 * len(texts)
    assert license_scan.scan(docs.limit(0), known).count() == 0
    assert license_scan.scan(docs.withColumnRenamed("word", "digest").withColumnRenamed("source", "license"), known).count() == len(texts)


def test_known_digests_are_joined_when_there_are_many(spark, monkeypatch):
    docs = frame(spark, [license_texts.MIT, "Licensed under the MIT License.\nmore", None])
    want = sorted(map(tuple, license_scan.scan(docs, license_scan.known_licenses(spark)).collect()))
    monkeypatch.setattr(license_scan, "MAX_KNOWN", 3)
    assert sorted(map(tuple, license_scan.scan(docs, license_scan.known_licenses(spark)).collect())) == want


HEADERS = [
    "Copyright (c) 1998 A\nAll rights reserved.\nCopyright (c) 2003 B\nAll rights reserved.\n", "Copyright (c) 2003 Alice Example, Bob Example,\n   and Carol Example\n\n", "# Copyright B Ltd\n#\n",
    "/* (C) 2001 A & B and\r\n * C\r\n */\n", "© Owner\nCopyright <YEAR> <OWNER>\nAll Rights Reserved\n", "Copyright 1999 A,\nB,\nC and\nD\nCopyright by E\n", "",
]


def test_headers_with_several_owners_before_every_license(spark):
    rows = [(name, header + text) for name, text, _ in license_texts.KNOWN for header in HEADERS]
    docs = frame(spark, [r[1] for r in rows])
    got = {r.doc_id: r for r in license_scan.scan(docs, license_scan.known_licenses(spark)).collect()}
    assert [(r[0], got[i].text_license) for i, r in enumerate(rows) if got[i].text_license != r[0]] == []
    assert [got[i].text_digest for i in range(len(rows))] == [brute.sha(brute.license_form(r[1])) for r in rows]


def test_sql_of_license_scans_tells_the_same_headers(spark, tmp_path):
    """The SQL has rules of its own, line by line."""
    import duckdb

    texts = [h + license_texts.MIT for h in HEADERS] + ["Copyright (c) 2001 A,\nnot a license", "copyright holders\nCopyright Holder Inc", None, "and\nall rights reserved,\nand more"]
    rows = [(i, t) for i, t in enumerate(texts)]
    frame(spark, texts).select("doc_id", "text").write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    names = ("doc_id", "text_digest", "text_license", "n_license_lines", "licenses", "restricted")
    want = sorted(con.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLE_SQL['op3_license_scan']})").fetchall())
    assert sorted(tuple(r[n] for n in names) for r in license_scan.scan(frame(spark, texts), license_scan.known_licenses(spark)).collect()) == want and len(want) == len(rows)


def test_whole_licenses_however_wrapped(spark):
    """Every known text matches below its title and owner, wrapped to any width, in capitals, with other spellings."""
    head = "\n\nCopyright (c) 1999-2021, Some Owner <mail@example.org>\n(C) 2022 Another One\nAll rights reserved.\n\n"
    rows = []
    for name, text, _ in license_texts.KNOWN:
        british = text.replace("license", "licence").replace("acknowledgment", "acknowledgement").replace("copyright holder", "copyright owner")
        for title in license_texts.TITLES.get(name, [""])[:1] if "\n" in text else [""]:
            rows += [(name, title + head + x) for x in (text, wrapped(text, 30), wrapped(text, 55), wrapped(text, 200), text.upper(), wrapped(british, 40), "# " + text.replace("\n", "\n# "))]
    rows += [(None, license_texts.MIT + " and more"), (None, license_texts.MIT.replace("free of charge", "for a charge")), ("MIT", license_texts.MIT), ("MIT", "\u00a9 Owner\n" + license_texts.MIT)]
    rows += [(None, "word " * 300_000 + license_texts.MIT), (None, "copyright law\nCopyright holders be liable\nlicence licence licenced licenced sub licence sub license")]
    docs = frame(spark, [r[1] for r in rows])
    got = {r.doc_id: r for r in license_scan.scan(docs, license_scan.known_licenses(spark)).collect()}
    assert [(i, got[i].text_license) for i in range(len(rows))] == [(i, r[0]) for i, r in enumerate(rows)]
    assert [got[i].text_digest for i in range(len(rows))] == [brute.sha(brute.license_form(r[1])) for r in rows]


def test_canonical_form_equals_word_by_word(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.text_digest for r in license_scan.scan(docs, license_scan.known_licenses(spark)).collect()}
    for r in docs.collect():
        form = brute.license_form(r.text)
        assert got[r.doc_id] == (brute.sha(form) if form else None)


SECRETS = [
    None, "", "password: hunter2!", 'API_KEY = "abcd1234efgh" and token=short token: secret: abcdefgh1', "AKIA" + "Q" * 16 + " AKIAABC AKIA", "é𝄞 passwd='p4ssw0rd__x'" + "0123456789abcdef" * 2,
    "hex " + "ab12" * 8 + "G" + "f" * 31, "token=token=token=abcdefgh", "Kx9vQ2mZ7pL4tR8wB3nY6cJ1", "123e4567-e89b-12d3-a456-426614174000", "thequickbrownfoxjumpsoverthelazydog", "key exampleKx9vQ2mZ7pL4tR8wB3nY6cJ1",
    "secret" + " " * 50 + "=" + " " * 50 + "'zzzzzzzz", "\n".join(f"password={i:08d}x" for i in range(300)),
]


KEY = "Kx9vQ2mZ7pL4tR8wB3nY6cJ1"
SECRETS += [
    "AKIA" + "Q" * 16 + "/" + KEY + KEY, "0123456789abcdef" * 2 + "_" + KEY, "see example-bucket/" + KEY, KEY + "EXAMPLE" + KEY, f"token={KEY}token={KEY} {KEY}", "api_key: PASSWORD=AKIA" + "B" * 20 + "x", KEY + "\U0001d11e" + KEY,
]


def spans_of(row):
    return [(s["start"], s["rank"], s["end"]) for s in row]


def test_secret_scan(spark):
    docs = frame(spark, SECRETS)
    got = {r.doc_id: r for r in secret_scan.scan(docs).collect()}
    for i, text in enumerate(SECRETS):
        assert spans_of(got[i].base_spans) == brute.secret_base(text), text
        assert spans_of(got[i].all_spans) == brute.secret_spans(text), text
        assert all(s["hit"] == text[s["start"] : s["end"]] for s in got[i].all_spans)
    assert [s["rank"] for s in got[8].all_spans] == [3]
    assert all(not got[i].all_spans for i in (9, 10, 11))
    assert [[s["rank"] for s in got[i].all_spans] for i in (14, 15, 16, 17)] == [[1, 3], [2, 3], [3], []]
    assert secret_scan.scan(docs).count() == len(SECRETS) and secret_scan.scan(twice(docs)).count() == 2 * len(SECRETS)
    assert secret_scan.scan(docs.limit(0)).count() == 0
    clashing = docs.withColumnRenamed("word", "masked").withColumnRenamed("source", "candidates")
    assert secret_scan.scan(clashing).columns == [*clashing.columns, "base_spans", "all_spans"]
    assert {r.masked for r in secret_scan.redact(clashing).collect()} == {"w"}


def test_incremental_entropy(spark):
    rng = random.Random(4)
    keys = ["".join(rng.choices(secret_scan.ALPHABET[: 2 + 6 * i], k=20 + 3 * i)) for i in range(10)] + ["a" * 40, "short", ""]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", secret_scan.window_bits(F.col("k")).alias("b")).collect()
    for r in rows:
        assert r.b == pytest.approx(brute.window_entropy(r.k), abs=1e-9)


def test_long_runs_and_many_hits(spark):
    """A run of a megabyte and 50,000 hits in one text take seconds, not hours."""
    rng = random.Random(8)
    run = "".join(rng.choices(secret_scan.ALPHABET[:64], k=1_000_000))
    low = "ab12" * 20_000 + "-G"
    many = "\U0001d11e " + " ".join(f"password={i:08d}x" for i in range(50_000))
    keys = " ".join("".join(rng.choices(secret_scan.ALPHABET[:62], k=24)) for _ in range(5_000))
    texts = [run, low, many, keys, many + run]
    began = time.time()
    got = {r.doc_id: r for r in secret_scan.scan(frame(spark, texts)).collect()}
    masked = {r.doc_id: r.text for r in secret_scan.redact(frame(spark, texts)).collect()}
    assert time.time() - began < 120
    assert spans_of(got[0].all_spans) == [(0, 3, 1_000_000)] and masked[0] == "[secret]"
    assert spans_of(got[1].base_spans) == [(0, 2, 80_000)] and masked[1] == "[secret]-G"
    for i in (2, 3):
        assert spans_of(got[i].all_spans) == brute.secret_spans(texts[i]) and masked[i] == brute.redacted(texts[i])
    assert len(got[4].base_spans) == 50_000


def test_redaction(spark):
    got = {r.doc_id: r.text for r in secret_scan.redact(frame(spark, SECRETS)).collect()}
    assert got[0] is None
    for i, text in enumerate(SECRETS[1:], 1):
        assert got[i] == brute.redacted(text), text


def test_decontamination(spark, monkeypatch):
    items = [(1, prose(1, 40)), (2, "short benchmark item"), (3, None), (4, "!!!"), (None, prose(2, 20)), (5, "the"), (6, prose(3, 10))]
    cut = prose(1, 40).split()
    texts = [" ".join(cut[5:30]) + " and " + prose(50, 40), prose(60, 30) + " Short, BENCHMARK... item " + prose(3, 10), " ".join(cut[:9]), None, "", "--", prose(2, 20), prose(7, 300) + " été " + " ".join(cut), "x" * 4000, " ".join(cut) * 2]
    texts += [texts[0]]
    for some in (items, [x for x in items if x[0] != 5], []):
        bench = spark.createDataFrame(some, "item_id long, text string")
        want = [brute.contamination(t, some) for t in texts]
        for most in (decontaminate.MAX_WINDOWS, 1):
            rows = decontaminate.contamination(frame(spark, texts), bench, max_windows=most).collect()
            got = {r.doc_id: (r.n_words, r.n_hit, len(r["items"]), brute.sha(",".join(r["items"])), r.contaminated) for r in rows}
            assert [got[i] for i in range(len(texts))] == want
    bench = spark.createDataFrame(items[:2], "item_id long, text string")
    docs = frame(spark, texts)
    assert decontaminate.contamination(twice(docs), bench).count() == 2 * len(texts)
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert kept == {i for i, t in enumerate(texts) if not brute.contamination(t, items[:2])[4]}
    assert decontaminate.drop_contaminated(docs, bench).columns == docs.columns
    clashing = docs.withColumnRenamed("word", "hit_id").withColumnRenamed("id", "hash").withColumnRenamed("source", "words")
    assert decontaminate.drop_contaminated(clashing, bench).count() == len(kept)
    monkeypatch.setattr(decontaminate, "MAX_FOUND", 0)
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()} == kept


def test_only_hits_pass_the_bitmap_of_a_large_benchmark(spark, monkeypatch):
    """Of what is not broadcast, hits and few others are written and shuffled; a window in every text meets them by broadcast."""
    items = [(i, prose(1000 + i, 30)) for i in range(30)]
    common = items[0][1]
    texts = [prose(i, 60) + " " + common for i in range(400)] + [prose(7, 150_000) + " " + items[3][1], None, ""]
    docs, bench = frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    kept = {}
    plain_save = decontaminate.Scratch.save

    def save(self, df, name):
        out = plain_save(self, df, name)
        kept[name] = out.count()
        return out

    monkeypatch.setattr(decontaminate.Scratch, "save", save)
    monkeypatch.setattr(decontaminate, "hub_size", lambda rows: 100)
    got = {r.doc_id: (r.n_words, r.n_hit, len(r["items"])) for r in decontaminate.contamination(docs, bench, max_windows=1).collect()}
    assert [got[i] for i in range(len(texts))] == [brute.contamination(t, items)[:3] for t in texts]
    windows = sum(max(0, n - 9) for n, _, _ in got.values())
    assert windows > 150_000 and 400 * 21 + 21 <= kept["through"] <= 400 * 21 + 21 + windows // 500


def without_hits(text, items):
    """Letters of hit words, and what stands between hit words of one run, go."""
    words = [(m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    plain = [text[a:b].lower() for a, b in words]
    gone = set()
    for item in items:
        own = brute.bench_words(item)
        width = min(10, len(own))
        for win in {tuple(own[i : i + width]) for i in range(len(own) - width + 1)}:
            for i in range(len(plain) - width + 1):
                if tuple(plain[i : i + width]) == win:
                    gone.update(range(words[i][0], words[i + width - 1][1]))
    return "".join(c for i, c in enumerate(text) if i not in gone)


def test_removing_spans(spark):
    items = [prose(1, 40), "short benchmark item", prose(3, 10)]
    cut = prose(1, 40).split()
    texts = ["before: " + ", ".join(cut[5:30]) + " and " + prose(50, 40), "\U0001d11e Short, BENCHMARK... item! " + prose(3, 10) + " short benchmark item", prose(9, 50), "", " ".join(cut) * 2, prose(7, 3000) + " " + " ".join(cut).upper() + "."]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = frame(spark, [*texts, None])
    for most in (decontaminate.MAX_WINDOWS, 1):
        got = {r.doc_id: r.text for r in decontaminate.cut_contaminated(docs, bench, max_windows=most).collect()}
        assert [got[i] for i in range(len(texts))] == [without_hits(t, items) for t in texts] and got[len(texts)] is None


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("tile", [64, 4])
def test_jaccard_components(spark, monkeypatch, tile):
    """tile 4: most tiles are large, so that firsts and unsettled pairs decide."""
    rng = random.Random(9)
    passage = prose(1000, 60)
    bases = [" ".join(f"{a}{rng.randrange(400)}" for a in rng.choices(WORDS, k=rng.randrange(30, 150))) for _ in range(12)]
    texts = [*bases, *[edited(b, rng, rng.randrange(0, 6)) for b in bases for _ in range(5)], *[b + " " + passage for b in bases], *[edited(passage, rng, rng.randrange(3)) for _ in range(12)]]
    texts += [None, "", "  ", "one two", "One  two", "one two three", bases[0].upper(), " ".join(bases[1].split()[:-3]), "x " * 500, "x " * 700]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    import pyspark.cloudpickle as cp

    cp.register_pickle_by_value(jaccard_join)
    try:
        docs = spark.createDataFrame([(i, t, "r", 1) for i, t in zip(ids, texts)], "doc_id long, text string, ref string, n int")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_components(docs).collect()}
    finally:
        cp.unregister_pickle_by_value(jaccard_join)
    assert got == brute.jaccard_components(list(zip(ids, texts)))


def test_passage_in_all_texts(spark, monkeypatch):
    """2,000 otherwise different texts hold one passage, most of each text but not enough to be similar: they are
    not listed pair by pair."""
    passage = prose(4000, 164)
    listed = []
    unsettled = jaccard_join._unsettled
    monkeypatch.setattr(jaccard_join, "_unsettled", lambda *a: listed.append(unsettled(*a)) or listed[-1])
    rows = [(i, " ".join(f"u{i}x{j}" for j in range(32 + i % 5)) + " " + passage) for i in range(2000)]
    rows += [(5000 + i, rows[i][1] + " tail") for i in range(0, 2000, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = []
    near = jaccard_join._near
    monkeypatch.setattr(jaccard_join, "_near", lambda texts, pairs, percent: counts.append(pairs.count()) or near(texts, pairs, percent))
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_components(docs).collect()}
    assert got == {i: i if i < 5000 else i - 5000 for i, _ in rows}
    assert sum(counts) < 64 * len(rows)


@pytest.mark.parametrize("hub", [256, 1])
def test_jaccard_repeated_and_empty(spark, monkeypatch, hub):
    monkeypatch.setattr("freshet.llm.components.HUB", hub)
    docs = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (3, "A b c d e f"), (None, "a b c d e f"), (None, None), (9, None)], "doc_id long, text string")
    rows = [tuple(r) for r in jaccard_join.similar_components(docs).collect()]
    assert sorted(rows, key=str) == sorted([(5, 2, 3), (5, 2, 3), (3, 2, 3), (None, 2, 3), (None, 0, None), (9, 0, 9)], key=str)
    assert jaccard_join.similar_components(docs.limit(0)).count() == 0


def test_structured_words_do_not_collide():
    """Words of a Thue-Morse sequence collide under any polynomial hash modulo a power of two."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    one, other = ("".join("ab"[b ^ x] for b in bits).encode() for x in (0, 1))
    sets = [textbytes.shingle_set([w, b"c", b"d", b"e", b"f"]) for w in (one, other)]
    assert sets[0] != sets[1]
    words = prose(1, 500).encode().split()
    assert len(textbytes.shingle_set(words)) == len({tuple(words[i : i + 5]) for i in range(496)})
    assert len(textbytes.shingle_set(words[:3])) == 1 and len(textbytes.shingle_set([])) == 0
    assert textbytes.shingle_set([b"a", b"b"]) != textbytes.shingle_set([b"b", b"a"])


def test_bitmap_bound_is_never_too_low():
    rng = np.random.default_rng(0)
    for _ in range(60):
        pool = textbytes.mix64(rng.integers(0, 2**63, 900).astype(np.uint64))
        a, b = np.unique(rng.choice(pool, rng.integers(1, 900), False)), np.unique(rng.choice(pool, rng.integers(1, 900), False))
        common = len(np.intersect1d(a, b))
        assert common <= jaccard_join.overlap_bound(jaccard_join.bitmap(a), jaccard_join.bitmap(b), len(a), len(b)) <= min(len(a), len(b)) + abs(len(a) - len(b))


def distance_to_prefix(term, word):
    """Least edit distance between the term and any beginning of the word."""
    row = list(range(len(word) + 1))
    for i, c in enumerate(term, 1):
        row, before = [i], row
        for j, d in enumerate(word, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != d)))
    return min(row)


def test_lexicon_trie_equals_edit_distance():
    rng = random.Random(2)
    terms = ["idiot", "idol", "moron", "réeux", "achlich", "scum", "trash"]
    trie = LexiconTrie(terms)
    words = [*terms, "idi0t", "idiots", "iddiot", "idot", "xidiot", "trsh", "scm", "scumm", "", "achliche"]
    words += ["".join(rng.choices("idotmrnscumtashlé", k=rng.randrange(1, 9))) for _ in range(2000)]
    for word in words:
        options = [(distance_to_prefix(t, word), -len(t), i) for i, t in enumerate(terms)]
        options = [x for x in options if x[0] == 0 or (x[0] == 1 and -x[1] >= 5)]
        want = (min(options)[2], min(options)[0]) if options else None
        assert trie.match(word) == want, word


def test_toxicity(spark):
    rng = random.Random(6)
    rude = ["grumblefart", "snotweasel", "muckbrain"]

    def text(i):
        words = prose(i, 30 + i % 60).split()
        for _ in range(3 if i % 5 == 0 else 0):
            words.insert(rng.randrange(len(words)), rng.choice(rude))
        return " ".join(words)

    rows = [(i, text(i)) for i in range(300)]
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (902, prose(902, 40) + " snotweazel and muckbrian grumblefart grumblfart"), (903, 'she said "grumblefart" and "muckbrain" are words ' + prose(903, 50))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i % 5 == 0)) for i in range(300)] + [(None, 0, 1), (5, 0, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    assert all(any(r.startswith(t) for t in model.terms) for r in rude)
    got = {r.doc_id: r for r in toxicity.predict(docs, model).collect()}
    assert all((got[i].score >= 0.7) == (i % 5 == 0) for i in range(300))
    assert got[902].score >= 0.7 and got[903].n_quoted == 2 and got[903].score < 0.7 and got[900].score == got[901].score < 0.5
    none = toxicity.train(docs, labels.limit(0), F.lit(True))
    assert len({r.score for r in toxicity.predict(docs, none).collect()}) == 1
    assert toxicity.predict(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    assert compare(spark, name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF) == []


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL) - {"op11_token_alignment", "op13_nearest_neighbours"}))  # these have files of their own
def test_queries_without_sql(spark, name):
    """A row for each document; counts and base scores by brute force."""
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: r for r in queries.QUERIES[name](spark, SF).collect()}
    assert list(sorted(got)) == [i for i, _ in docs]
    if name == "op1_token_counts":
        want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode_batch([t for _, t in docs], add_special_tokens=False)
        assert all(got[i].n_tokens == len(e) and got[i].over_limit == (len(e) > 2048) for (i, _), e in zip(docs, want))
    elif name == "op5_lm_score":
        want = brute.base_score([t for _, t in docs], [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in docs])
        for (i, _), (n, known, total, base) in zip(docs, want):
            assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (n, known, total) and got[i].base_score == pytest.approx(base)
        coded = {i: " ".join(brute.ascii_words(t)).replace("\0", "\1").encode().decode("latin-1") for i, t in docs}
        bits = plain_ppm([t for i, t in coded.items() if zlib.crc32(str(i).encode()) % 7 != 2], lm_score.ORDER)
        for i in coded:
            assert got[i].score == pytest.approx(-bits(coded[i]) * math.log10(2), rel=1e-5)
    else:
        assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 for i, r in got.items())


def test_language_query_equals_plain_coding(spark):
    """Every row of the registered query, by symbol-by-symbol coding of the learned rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    coded = {r.doc_id: language_id.normalise((r.text or "").encode()).replace(b"\0", b"\1").decode("latin-1") for r in docs}
    learned = {}
    for r in docs:
        if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.lang is not None and r.text is not None:
            learned.setdefault(r.lang, []).append(coded[r.doc_id])
    total = sum(map(len, learned.values()))
    bits = {x: plain_ppm(t, language_id.ORDER) for x, t in learned.items()}
    got = {r.doc_id: r for r in queries.op2_language_id(spark, SF).collect()}
    for r in docs:
        if not any(map(str.isalpha, r.text or "")):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        costs = {x: b(coded[r.doc_id]) + math.log2(total / len(learned[x])) for x, b in bits.items()}
        best = min(costs.values())
        assert costs[got[r.doc_id].lang_pred] == pytest.approx(best, rel=1e-5)
        assert got[r.doc_id].score == pytest.approx(1 / sum(2.0 ** (best - c) for c in costs.values()), rel=1e-3, abs=1e-6)


def one_edit(a, b):
    """0 if equal, 1 if one letter more, less or another makes them equal, else None."""
    if a == b:
        return 0
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return 1 if a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :] else None


def plain_hit(word, terms):
    """(term, edits): of all terms within one edit of a beginning of the word that with fewest edits, then the longest."""
    found = []
    for number, term in enumerate(terms):
        edits = [e for n in (len(term) - 1, len(term), len(term) + 1) if n <= len(word) for e in [one_edit(word[:n], term)] if e is not None]
        if edits and (min(edits) == 0 or len(term) >= 5):
            found.append((min(edits), -len(term), number))
    return (min(found)[2], min(found)[0]) if found else None


def plain_quoted(text, start, end):
    before, after = text[max(0, start - 40) : start].split("\n")[-1], text[end : end + 40].split("\n")[0]
    marks = set(toxicity.OPENING) | set(toxicity.CLOSING)
    between = any(c in toxicity.OPENING for c in before) and any(c in toxicity.CLOSING for c in after)
    if between and sum(c in marks for c in before) % 2 == 1:
        return True
    return any(w in toxicity.CUES for w in re.findall(r"[^\W_]+", before.lower())[-3:])


def test_toxicity_query_equals_plain_scoring(spark):
    """Every row of the registered query: all terms against all beginnings of every word, features by their definition, and
    the coefficients that the labels which may be learned from give."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    got = {r.doc_id: r for r in queries.op4_toxicity(spark, SF).collect()}
    memo, n_hits = {}, 0
    for r in docs.collect():
        lower = (r.text or "").lower()
        words, uses, strong, kinds, quotes = 0, 0.0, 0.0, Counter(), 0
        for m in re.finditer(r"[^\W_]+", lower):
            words += 1
            if m[0] not in memo:
                memo[m[0]] = plain_hit(m[0], model.terms)
            if memo[m[0]] is None:
                continue
            if plain_quoted(lower, m.start(), m.end()):
                quotes += 1
                continue
            term, edits = memo[m[0]]
            belief = model.weights[term][1] if edits else 1.0
            uses, strong, n_hits = uses + belief, strong + belief * model.weights[term][0], n_hits + 1
            kinds[term, edits] += belief
        x = [min(uses, 12), math.log1p(strong), min(len({t for (t, _), n in kinds.items() if n >= 0.5}), 8), math.log1p(100 * strong / max(words, 20)), math.log1p(words), math.log1p(quotes), uses >= 2]
        z = sum(max(-4.0, min(4.0, (v - a) / b)) * c for v, a, b, c in zip(x, model.mean, model.scale, model.coefficients)) + model.coefficients[-1]
        score = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
        assert got[r.doc_id].score == pytest.approx(score, abs=1e-9) and got[r.doc_id].predicted == (score >= 0.7)
    assert len(got) == 200 and n_hits > 20 and len(model.terms) > 0


def with_tables(spark, folder, **changed):
    """A folder with documents and labels of SF, some of them changed."""
    for name in ("documents", "labels"):
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        changed.get(name, lambda x: x)(df).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_held_out_languages_and_labels_do_not_matter(spark, tmp_path):
    """What is held out, and every column but text, can be anything."""
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    folder = with_tables(
        spark, tmp_path, documents=lambda d: d.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s")).withColumn("score", F.lit("clash")),
        labels=lambda d: d.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic"))).withColumn("y", F.lit("clash")),
    )
    for query, column in ((queries.op2_language_id, "lang_pred"), (queries.op4_toxicity, "predicted")):
        was, now = ({r.doc_id: (r[column], round(r.score, 9), r.held_out) for r in query(spark, d).collect()} for d in (SF, folder))
        assert was == now and (column != "lang_pred" or "xx" not in {v[0] for v in now.values()})


def test_held_out_quality(spark):
    """Accuracy of languages and precision and recall of toxicity on rows that were not learned from."""
    folder = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = [r for r in queries.op2_language_id(spark, folder).collect() if r.held_out and r.lang_pred != "und" and lang[r.doc_id]]
    assert len(rows) > 200 and sum(lang[r.doc_id] == r.lang_pred for r in rows) >= 0.97 * len(rows)
    folder = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r.toxic is not None}
    rows = [(r.predicted, toxic[r.doc_id]) for r in queries.op4_toxicity(spark, folder).collect() if r.held_out and r.doc_id in toxic]
    hits = sum(p and t for p, t in rows)
    assert hits >= 0.93 * sum(p for p, _ in rows) and hits >= 0.85 * sum(t for _, t in rows) > 100


def test_repeated_rows_and_ties_of_language(spark):
    rows = [(1, "abc abc", "b"), (1, "abc abc", "b"), (1, "abd", "a"), (2, "abc abc", "a"), (3, "zzz", "a"), (3, "zzz", "b")]
    docs = spark.createDataFrame([(*r, "row", 1) for r in rows], "doc_id long, text string, lang string, row string, bits int")
    same = docs.where("doc_id = 3")
    got = language_id.predict(docs, language_id.train(same)).collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got} == {"a"} and {r.score for r in got} == {0.5}
    long = spark.createDataFrame([(1, "zzz " * 200_000, "a")], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language_id.predict(long, language_id.train(docs)).collect()] != ["und"]


def test_toxicity_of_long_texts_and_repeated_rows(spark):
    word = ["lovely", "grumblefart"]
    docs = spark.createDataFrame([(i, " ".join(f"{x} {word[i % 2]}" if j % 10 == 5 else x for j, x in enumerate(prose(i, 30).split())), "s") for i in range(80)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    long = spark.createDataFrame([(1, "grumblefart " * 100_000, "s"), (1, "grumblefart " * 100_000, "s"), (2, "x" * 1_000_000, "s"), (2, None, "s")], docs.schema)
    got = sorted((r.doc_id, r.n_hits) for r in toxicity.predict(long, model).collect())
    assert got == [(1, 100_000), (1, 100_000), (2, 0), (2, 0)]
    kept = toxicity.below(docs.union(docs), model, 0.7)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(2 * list(range(0, 80, 2)))
