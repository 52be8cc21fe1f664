"""Cross-tokenizer alignment: where tokens of two tokenizers end at the same byte.

Pointers into the A and B tokens of all documents of a batch are one NumPy state vector. A step compares the
ends that all pointers stand at, emits a link and a cut where they are equal, moves the pointer that is behind
(or both), and drops what is finished from the state. A document of many tokens moves in several lanes, split
at byte offsets, so the number of steps does not follow the longest text.

Both tokenizers separate a text before a blank or line end that follows anything but white space (checked in their
files, otherwise texts stay whole). Texts are encoded by such pieces, and pieces seen before come from a bounded
memo. How often an id pair is linked in the corpus is counted in Spark; the counts of the commonest pairs (a bounded
number) are broadcast, and those of all others are joined.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.heaviest import heaviest
from freshet.llm.scratch import Scratch
from freshet.llm.textbytes import byte_batches, text_bytes

#: Bytes of text aligned at once, bytes of a lane, and pieces that a worker remembers.
BATCH_BYTES, LANE_BYTES, MEMO_PIECES = 1 << 20, 512, 300_000
#: Longest piece worth remembering (bytes).
MEMO_LENGTH = 64
#: Bytes of pieces encoded in one call.
CALL_BYTES = 64 << 10
#: Distinct pairs that a task holds before it hands on partial counts, and most pairs broadcast with their counts.
HELD_PAIRS, COMMON_PAIRS = 1 << 20, 1 << 20
BLANK = "▁"
_MARK, _BREAKS = BLANK.encode(), (b" ", b"\n")

_loaded: dict = {}


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the others
    for the letters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Pool:
    """Growing arrays of token ids and byte lengths; ``first`` and ``count`` say where each piece lies."""

    def __init__(self):
        self.ids, self.sizes, self.first, self.count = (np.empty(0, kind) for kind in (np.int32, np.int32, np.int64, np.int64))

    def add(self, ids: np.ndarray, counts: np.ndarray, size_of: np.ndarray) -> None:
        self.first = np.concatenate((self.first, len(self.ids) + np.cumsum(counts) - counts))
        self.count = np.concatenate((self.count, counts))
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
        self.sizes = np.concatenate((self.sizes, size_of[ids].astype(np.int32)))

    def tokens(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, sizes, number of each piece) of the pieces' tokens in order."""
        counts = self.count[pieces]
        at = np.arange(int(counts.sum())) + np.repeat(self.first[pieces] - np.cumsum(counts) + counts, counts)
        return self.ids[at].astype(np.int64), self.sizes[at], counts


class Tokenizers:
    """A: a byte-level .json; B: a .model with byte fallback. Encodes pieces of texts with both."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in y], np.int64) for y in (self.bytes_a, self.bytes_b))
        self.blank_b = self.b.piece_to_id(BLANK)
        with open(path_a, encoding="utf-8") as f:
            self.cuts = separates(json.load(f), pieces) and pieces[self.blank_b] == BLANK
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.long: list[bytes] = []
        self.pools = Pool(), Pool()
        self.fine, self.odd = np.empty(0, bool), np.empty(0, bool)

    def numbers(self, texts: list[bytes]) -> list[np.ndarray]:
        """The piece numbers of each text, which hold until the next call."""
        if len(self.memo) > MEMO_PIECES:
            self._forget()
        if not self.cuts:
            keys = [[b" " + text] for text in texts]  # the blank before the text is part of the key
            self._learn(keys)
            return [np.array([self.memo.pop(k) for k in x]) for x in keys]
        cut = [text.replace(b"\n", b" \n").split(b" ") for text in texts]
        self._learn(cut)
        out = [np.fromiter(map(self.memo.__getitem__, x), np.int64, len(x)) for x in cut]
        late = [k for k, x in enumerate(out) if self.odd[x].any()]
        if late:  # white space meets white space: such pieces stay together
            joined = [_joined(cut[k]) for k in late]
            self._learn(joined)
            for k, x in zip(late, joined):
                out[k] = np.fromiter(map(self.memo.__getitem__, x), np.int64, len(x))
        for piece in self.long:
            self.memo.pop(piece, None)
        self.long = []
        return out

    def _learn(self, cut: list[list[bytes]]) -> None:
        fresh = sorted(set().union(*cut).difference(self.memo))
        if not fresh:
            return
        self.long += [key for key in fresh if len(key) > MEMO_LENGTH]
        whole = [key if key[:1] in _BREAKS else b" " + key for key in fresh]
        odd = [x[-1] > 127 and x.decode()[-1].isspace() or x[-1:].isspace() for x in whole]
        alone = {k for k, x in enumerate(whole) if odd[k] or _MARK in x} if self.cuts else set(range(len(whole)))
        plain = [k for k in range(len(whole)) if k not in alone]
        for part, bulk in ((plain, True), (sorted(alone), False)):
            begin = len(self.fine)
            text = [whole[k] for k in part]
            if not text:
                continue
            if not (bulk and self._learn_joined(text)):
                self._learn_each(text)
            self.memo.update(zip((fresh[k] for k in part), range(begin, begin + len(part))))
            self.odd = np.concatenate((self.odd, np.array([odd[k] for k in part], bool)))

    def _learn_joined(self, whole: list[bytes]) -> bool:
        """Pieces after one another, in calls of CALL_BYTES that each begin with a word of their own: all tokens of a
        piece end by its end."""
        call = np.cumsum([len(x) for x in whole]) // CALL_BYTES
        firsts = np.searchsorted(call, np.unique(call))
        parts = [[b" x", *whole[i:j]] for i, j in zip(firsts, [*firsts[1:], len(whole)])]
        joined = [b"".join(p) for p in parts]
        text = [x.decode() for x in joined]
        ends = np.cumsum([len(x) for p in parts for x in p])
        real = np.ones(len(ends), bool)
        real[firsts + np.arange(len(firsts))] = False
        got = []
        for calls, names, sizes in (
            ([x.ids for x in self.a.encode_batch_fast(text, add_special_tokens=False)], self.bytes_a, self.size_a),
            (self.b.encode([t[1:] for t in text], num_threads=1), self.bytes_b, self.size_b),
        ):
            if any(b"".join(map(names.__getitem__, ids)) != x for ids, x in zip(calls, joined)):
                return False
            ids = np.concatenate([np.array(x, np.int64) for x in calls])
            stops = np.cumsum(sizes[ids])
            last = np.searchsorted(stops, ends)
            if (stops[last] != ends).any():
                return False
            counts = np.diff(last, prepend=-1)
            got.append((ids[np.repeat(real, counts)], counts[real]))
        for pool, (ids, counts), sizes in zip(self.pools, got, (self.size_a, self.size_b)):
            pool.add(ids, counts, sizes)
        self.fine = np.concatenate((self.fine, np.ones(len(whole), bool)))
        return True

    def _learn_each(self, whole: list[bytes]) -> None:
        text = [x.decode() for x in whole]
        a = [e.ids for e in self.a.encode_batch_fast(text, add_special_tokens=False)]
        b = self._encode_b(text)
        for pool, got, sizes in zip(self.pools, (a, b), (self.size_a, self.size_b)):
            counts = np.fromiter(map(len, got), np.int64, len(got))
            pool.add(np.fromiter((i for e in got for i in e), np.int64, int(counts.sum())), counts, sizes)
        same = [b"".join(map(self.bytes_a.__getitem__, x)) == w and b"".join(map(self.bytes_b.__getitem__, y)) == w for x, y, w in zip(a, b, whole)]
        self.fine = np.concatenate((self.fine, np.array(same, bool)))

    def _encode_b(self, texts: list[str]) -> list[list[int]]:
        """The tokenizer adds a blank before what it gets, and nothing to an empty text."""
        got = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        return [[self.blank_b] if t == " " else x if t[0] == " " else x[1:] for t, x in zip(texts, got)]


def separates(spec: dict, pieces: list[str]) -> bool:
    """Whether both tokenizers separate before a blank or line end after anything but white space: A's first step is
    the byte-level pattern, whose matches hold white space only at their beginning or hold nothing else; no piece of B
    has a line end or, after another letter, a blank."""
    pre = spec.get("pre_tokenizer") or {}
    a = spec.get("normalizer") is None and spec.get("post_processor") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") is True and not pre.get("add_prefix_space")
    return a and not any("\n" in p or re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces)


def _joined(pieces: list[bytes]) -> list[bytes]:
    """Pieces of a text, those that follow white space joined to it. A key that begins with a blank or line end is
    its own text; all others have a blank before them."""
    out: list[bytes] = []
    held = b""
    for piece in pieces:
        text = piece if piece[:1] == b"\n" else b" " + piece
        if held and not held.decode()[-1].isspace():
            out.append(held)
            held = b""
        held += text
    out.append(held)
    return [x[1:] if x[:1] == b" " and x[1:2] not in (b"", b" ", b"\n") else x for x in out]


def merged(end_a: np.ndarray, end_b: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all tokens of A and B that end together, by i. Both end arrays rise; ``bounds`` are offsets, the first
    0 and the last the common end, between which pointers of their own move."""
    at_a, at_b = np.searchsorted(end_a, bounds, side="right"), np.searchsorted(end_b, bounds, side="right")
    state = np.stack((at_a[:-1], at_b[:-1], at_a[1:], at_b[1:]))
    state = state[:, (state[0] < state[2]) & (state[1] < state[3])]
    links = []
    while state.shape[1]:
        x, y = end_a[state[0]], end_b[state[1]]
        met = x == y
        links.append(state[:2, met])
        state[0] += x <= y
        state[1] += y <= x
        live = (state[0] < state[2]) & (state[1] < state[3])
        if not live.all():
            state = state[:, live]
    i, j = np.concatenate(links, axis=1) if links else np.empty((2, 0), np.int64)
    order = np.argsort(i)
    return i[order], j[order]


def aligned(numbers: list[np.ndarray], tools: Tokenizers) -> dict:
    """Of each text, given as numbers of pieces that join to it: n_a, n_b, n_groups (arrays), groups (bytes, each
    group followed by ;), and of all texts ``pairs`` (text, A id, B id: sorted columns) of the links."""
    pieces = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
    of = np.repeat(np.arange(len(numbers)), [len(x) for x in numbers])
    (a, size_a, count_a), (b, size_b, count_b) = (pool.tokens(pieces) for pool in tools.pools)
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    n = len(numbers)
    n_a, n_b = (np.bincount(of, weights=c, minlength=n).astype(np.int64) for c in (count_a, count_b))
    last = np.concatenate(([0], end_a[np.cumsum(n_a) - 1])) if len(a) else np.zeros(1, np.int64)
    bounds = np.union1d(last, np.arange(0, last[-1], LANE_BYTES))
    i, j = merged(end_a, end_b, bounds)
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[i], last_b[j] = 1, 1
    code = np.empty(len(a) + len(b), np.int64)
    code[np.arange(len(a)) + np.concatenate(([0], j + 1))[np.cumsum(last_a) - last_a]] = 2 * a + last_a
    code[np.arange(len(b)) + i[np.cumsum(last_b) - last_b] + 1] = 2 * (b + len(tools.bytes_a)) + last_b
    ends = np.cumsum(n_a + n_b)
    words = _words(tools)
    groups = [b"".join(map(words.__getitem__, code[e - m : e].tolist())) for e, m in zip(ends, n_a + n_b)]
    text = np.searchsorted(np.cumsum(n_a), i, side="right")
    return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(text, minlength=n), "groups": groups, "pairs": (text, a[i], b[j])}


def _words(tools: Tokenizers) -> list[bytes]:
    if not hasattr(tools, "words"):
        a, b = ((b"%d" % i for i in range(len(x))) for x in (tools.bytes_a, tools.bytes_b))
        tools.words = [x + e for x in a for e in (b",", b"|")] + [x + e for x in b for e in (b",", b";")]
    return tools.words


def _segments(text: bytes) -> list[bytes]:
    """A long text cut before blanks that follow printable ASCII, where there are any."""
    out = []
    while len(text) > BATCH_BYTES:
        at = [m.start() + 1 for m in re.finditer(rb"[!-~] [!-~]", text[:BATCH_BYTES])][-1:] or [m.start() + 1 for m in [re.search(rb"[!-~] [!-~]", text)] if m]
        if not at:
            break
        out.append(text[: at[0]])
        text = text[at[0] + 1 :]
    return [*out, text]


def _codes(text: np.ndarray, a: np.ndarray, b: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets of each text, distinct codes, how often) of its id pairs; a code is A id * 2^31 + B id."""
    code = (a << 31) | b
    most = int(code.max(initial=0)) + 1
    if texts * most < 1 << 63:
        text, code = np.divmod(np.sort(text * most + code), most)
    else:
        order = np.lexsort((code, text))
        text, code = text[order], code[order]
    first = np.flatnonzero(np.concatenate(([True], (code[1:] != code[:-1]) | (text[1:] != text[:-1])))) if len(code) else np.empty(0, np.int64)
    return np.searchsorted(text[first], np.arange(texts + 1)), code[first], np.diff(np.append(first, len(code)))


def _align(paths: tuple[str, str]):
    """Of a batch: a row for every text, and rows of partial pair counts."""

    def one(text: bytes, tools: Tokenizers) -> tuple:
        """A long text by its segments."""
        digest, sums, parts, held = hashlib.sha256(), np.zeros(3, np.int64), [], b""
        for segment in _segments(text):
            numbers = tools.numbers([segment])
            if not tools.fine[numbers[0]].all():
                return 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64)
            found = aligned(numbers, tools)
            sums += [found["n_a"][0], found["n_b"][0], found["n_groups"][0]]
            digest.update(held)
            held = found["groups"][0]
            parts.append(_codes(*found["pairs"], 1)[1:])
        digest.update(held[:-1])
        codes, times = _added(parts)
        return *sums.tolist(), digest.hexdigest(), codes, times

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if paths not in _loaded:
            _loaded[paths] = Tokenizers(*paths)
        tools = _loaded[paths]
        place, held = TaskContext.get().partitionId() << 40, []
        for batch in byte_batches(batches, 1, BATCH_BYTES):
            texts = text_bytes(batch.column(1))
            if len(texts) == 1 and len(texts[0]) > BATCH_BYTES:
                *sums, digest, codes, times = one(texts[0], tools)
                n_a, n_b, n_groups = (np.array([x]) for x in sums)
                digests, offsets = [digest], np.array([0, len(codes)])
            else:
                numbers = tools.numbers(texts)
                fine = np.array([bool(t) and bool(tools.fine[x].all()) for t, x in zip(texts, numbers)], bool)
                found = aligned([x if f else x[:0] for x, f in zip(numbers, fine)], tools)
                n_a, n_b, n_groups = found["n_a"], found["n_b"], found["n_groups"]
                digests = [hashlib.sha256(g[:-1]).hexdigest() if g else "" for g in found["groups"]]
                offsets, codes, times = _codes(*found["pairs"], len(texts))
            rows = batch.num_rows
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, k)) for x, k in ((codes, pa.int64()), (times, pa.int32()))]
            keys = pa.array(np.arange(place, place + rows), pa.int64())
            place += rows
            yield pa.RecordBatch.from_arrays([keys, batch.column(0), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)], pa.array(digests, pa.string()), *lists], names=NAMES)
            held.append((codes, times))
            if sum(len(x) for x, _ in held) > HELD_PAIRS:
                held = [_added(held)]
                if len(held[0][0]) > HELD_PAIRS // 2:
                    yield _counts(*held.pop(), batch.column(0).type)
        if held:
            yield _counts(*_added(held), batch.column(0).type)

    return run


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(place, weights=np.concatenate([p[1] for p in parts]), minlength=len(codes)).astype(np.int64)


NAMES = ["key", "id", "n_a", "n_b", "n_groups", "groups_sha256", "codes", "times"]


def _counts(codes: np.ndarray, times: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    """A row without a key whose lists are partial counts of pairs."""
    lists = [pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), pa.array(x, k)) for x, k in ((codes, pa.int64()), (times, pa.int32()))]
    return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, kind), *[pa.nulls(1, pa.int64())] * 3, pa.nulls(1, pa.string()), *lists], names=NAMES)


def _looked_up(shared):
    """Of each text, the sums over pairs whose counts are broadcast, and its other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = shared.value
        for batch in batches:
            codes, times = (batch.column(k).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2))
            offsets = np.concatenate(([0], np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False))))
            text = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
            hit = known[at] == codes if len(known) else np.zeros(len(codes), bool)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            for out, value in zip(sums, (best, counts)):
                np.add.at(out, text[hit], times[hit] * value[at[hit]])
            rest = ~hit
            cuts = pa.array(np.concatenate(([0], np.cumsum(np.bincount(text[rest], minlength=batch.num_rows)))), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x[rest], pa.int64())) for x in (codes, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.int64()) for x in sums], *lists], names=["key", "n_best", "count_sum", "codes", "times"])

    return run


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", common: int = COMMON_PAIRS) -> tuple[DataFrame, DataFrame]:
    """(texts, pairs). ``texts``: one row per input row: id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256. ``pairs``: (a, b, n, best) of every linked id pair, how many links hold it in all texts and whether
    no pair of its B id has more.

    A text, with a blank before it, is encoded by the tokenizers of both files without special tokens. Null and empty
    texts, and texts that either tokenizer does not give back byte for byte, have no tokens: zeros and an empty digest.
    Any number of rows may share an id. Long texts are aligned whole, segment by segment; a text without a place to
    cut is one segment. Other columns are not read; an empty table gives empty results.
    """
    scratch = Scratch(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    used = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = used.mapInArrow(_align((path_a, path_b)), f"key long, id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, codes array<long>, times array<int>")
    rows = scratch.save(rows, "rows")
    counted = rows.where("key is null").select(F.explode(F.arrays_zip("codes", "times")).alias("x")).groupBy(F.col("x.codes").alias("code")).agg(F.sum("x.times").alias("n"))
    counted = scratch.save(counted.withColumn("b", F.col("code").bitwiseAND((1 << 31) - 1)), "counted")
    top = counted.groupBy("b").agg(F.max("n").alias("most"))
    pairs = scratch.save(counted.join(top, "b").select("code", F.shiftright("code", 31).alias("a"), "b", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    known = heaviest(pairs, "n", common).select("code", "n", "best").toArrow()
    order = np.argsort(known["code"].to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(tuple(known[x].to_numpy().astype(np.int64)[order] for x in ("code", "n", "best")))
    texts = rows.where("key is not null")
    sums = scratch.save(texts.select("key", "codes", "times").mapInArrow(_looked_up(shared), "key long, n_best long, count_sum long, codes array<long>, times array<long>"), "sums")
    shared.destroy()
    rare = sums.where("size(codes) > 0").select("key", F.explode(F.arrays_zip("codes", "times")).alias("x")).select("key", F.col("x.codes").alias("code"), F.col("x.times").alias("k"))
    rare = rare.join(pairs, "code").select("key", F.when(F.col("best"), F.col("k")).otherwise(0).alias("n_best"), (F.col("k") * F.col("n")).alias("count_sum"))
    both = sums.select("key", "n_best", "count_sum").union(rare).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = texts.join(both, "key").select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
    pairs = pairs.select(F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"), "n", "best")
    pairs = Scratch(docs.sparkSession).finish(pairs)
    return scratch.finish(out), pairs
