"""Token counts with a public tokenizer: Arrow batches in, lengths out.

Batches are cut by bytes of text. Where the loaded tokenizer is known to separate pieces (at blanks, and beside
ASCII digits), texts are cut into pieces that are encoded by themselves: a long text is not one call, and pieces
seen before are looked up in a bounded memo. Pieces still to be encoded go to the library in batches of equal
bytes. With any other tokenizer, and within a run that has no safe boundary, a text is encoded as it is.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.textbytes import byte_batches, text_bytes

#: Most pieces a worker remembers, and the longest piece worth remembering (bytes).
MEMO_PIECES = 400_000
MEMO_LENGTH = 64
#: Bytes of text handled, and handed to the tokenizer, at once.
BATCH_BYTES = 1 << 20
#: Longer pieces are cut beside ASCII digits too.
LONG_PIECE = 4096
# Fixed value: the pattern of the pre-tokenizer whose pieces never span blanks, and whose digits stand alone.
SEPARATING = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# NFC joins nothing to a following ASCII letter or digit, so a cut before one is safe when either side is a digit.
DIGIT_EDGE = re.compile(rb"(?<=[0-9])(?=[A-Za-z0-9])|(?<=[A-Za-z])(?=[0-9])")

_loaded: dict = {}


def separates(spec: dict) -> bool:
    """Whether the tokenizer's first step after NFC, blanks and lower case is the split by SEPARATING."""
    norm = spec.get("normalizer") or {}
    steps = norm.get("normalizers", [norm] if norm else [])
    plain = all(s["type"] in ("NFC", "Lowercase") or (s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"} and s["content"] == " ") for s in steps)
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    split = first.get("type") == "Split" and first.get("pattern") == {"Regex": SEPARATING} and first.get("behavior") == "Removed" and first.get("invert") is True
    added = all(re.search(r"[0-9\s]", t["content"]) is None and not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in spec.get("added_tokens", []))
    return plain and split and added and spec.get("post_processor") is None


class _Encoder:
    """Lengths of texts by a tokenizer file: .json by tokenizers, .model by sentencepiece."""

    def __init__(self, path: str):
        self.memo: dict = {b"": 0}
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            self.cuts, self._many = False, lambda texts: list(map(len, model.encode(texts)))
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            self.cuts = separates(json.load(f))
        self._many = lambda texts: list(map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False)))

    def lengths(self, pieces: list[bytes]) -> Iterator[int]:
        """In calls of about BATCH_BYTES."""
        batch, size = [], 0
        for piece in pieces:
            batch.append(piece.decode())
            size += len(piece)
            if size >= BATCH_BYTES:
                yield from self._many(batch)
                batch, size = [], 0
        if batch:
            yield from self._many(batch)

    def count(self, texts: list[bytes]) -> list[int]:
        if not self.cuts:
            return list(self.lengths(texts))
        memo = self.memo
        cut = [safe_pieces(text) for text in texts]
        fresh = set().union(*cut).difference(memo)
        if len(memo) + len(fresh) > MEMO_PIECES:
            memo.clear()
            memo[b""] = 0
            fresh = set().union(*cut).difference(memo)
        fresh = sorted(fresh)
        memo.update(zip(fresh, self.lengths(fresh)))
        counts = [sum(map(memo.__getitem__, pieces)) for pieces in cut]
        for piece in fresh:
            if len(piece) > MEMO_LENGTH:
                del memo[piece]
        return counts


def safe_pieces(text: bytes) -> list[bytes]:
    """Cut at blanks, tabs and line ends only, and long pieces beside ASCII digits; other Unicode spaces stay inside."""
    pieces = text.translate(_TO_BLANK).split(b" ")
    if len(text) > LONG_PIECE and any(len(p) > LONG_PIECE for p in pieces):
        pieces = [x for p in pieces for x in (DIGIT_EDGE.split(p) if len(p) > LONG_PIECE else (p,))]
    return pieces


_TO_BLANK = bytes(32 if c in b"\n\t\r" else c for c in range(256))


def count_texts(texts: list[bytes], path: str) -> list[int]:
    """Token counts of whole texts (UTF-8) as the library gives them."""
    if path not in _loaded:
        _loaded[path] = _Encoder(path)
    return _loaded[path].count(texts)


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit. Any number of rows may share an id.

    Null text counts as empty: 0 bytes, 0 tokens. Null ids pass through. Very long texts are counted whole: they
    are cut where the tokenizer separates pieces, and only a run of letters without any boundary is one call.
    Other columns of the input are not read, so their names cannot clash. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, 1, BATCH_BYTES):
            counts = count_texts(text_bytes(batch.column(1)), tokenizer_path)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    counted = picked.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
