"""Encoding of texts with a public byte-level tokenizer.

The rank file is read once on the driver and broadcast; each Python worker builds the encoder once. Long
texts are cut at places where the tokenizer's own pattern always ends a token, so that the ids are those of
the whole text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession

#: Where the vocabulary files are; a parameter of every operator here.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern of the public byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts above so many characters are encoded in pieces of about that size.
PIECE = 20_000

# Between a character and white space, or between a letter or digit and a mark, the pattern always ends a token.
_SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=[\p{L}\p{N}])(?=[^\s\p{L}\p{N}])")


def safe_pieces(text: str, size: int = PIECE) -> list[str]:
    """The text in pieces of at least ``size`` characters, cut at token ends; joined they are the text.

    A stretch without a token end is never cut.
    """
    if len(text) <= size:
        return [text]
    out, start = [], 0
    while len(text) - start > size:
        m = _SAFE.search(text, start + size)
        if m is None or m.start() >= len(text):
            break
        out.append(text[start : m.start()])
        start = m.start()
    return [*out, text[start:]]


@lru_cache(maxsize=4)
def encoder(rank_file: bytes, pattern: str = PATTERN) -> tiktoken.Encoding:
    """The tokenizer of a rank file's content, without special tokens."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_file.splitlines()) if token}
    return tiktoken.Encoding("factloom", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode(enc: tiktoken.Encoding, text: str | None, size: int = PIECE) -> list[int]:
    """Ids of a text; none for null and for the empty text."""
    if not text:
        return []
    if len(text) <= size:
        return enc.encode_ordinary(text)
    return [i for piece in safe_pieces(text, size) for i in enc.encode_ordinary(piece)]


def decode(enc: tiktoken.Encoding, ids: list[int]) -> str:
    """The text of ids, by their raw bytes."""
    return b"".join(enc.decode_tokens_bytes(ids)).decode("utf-8")


def slices(texts: list[str | None], most: int = 300_000) -> Iterator[tuple[int, int, list[str | None]]]:
    """(start, end, texts) of runs of about ``most`` characters, so that a batch needs little memory at a time."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= most:
            yield start, i + 1, texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts), texts[start:]


def _rank_file(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_texts(df: DataFrame, key: str, text: str, path: str = TOKENIZER) -> DataFrame:
    """(key, ids) of every row: the ids of its text, the empty list for a null or empty text.

    A blank text is encoded as it is. Nothing is shuffled; rows keep their number, repeated ones too.
    """
    ranks = _rank_file(df.sparkSession, path)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks.value)
        for b in it:
            for a, e, texts in slices(b.column(1).to_pylist()):
                ids = [encode(enc, t) for t in texts]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, e - a), _lists(ids)], names=[key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(batches, f"`{key}` {kind}, ids array<int>")


def _lists(ids: list[list[int]]) -> pa.ListArray:
    offsets = np.zeros(len(ids) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    flat = np.empty(int(offsets[-1]), dtype=np.int32)
    for x, a, b in zip(ids, offsets, offsets[1:], strict=False):
        flat[a:b] = x
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def count_tokens(df: DataFrame, key: str, text: str, path: str = TOKENIZER) -> DataFrame:
    """(key, n_tokens) of every row; 0 for a null or empty text."""
    ranks = _rank_file(df.sparkSession, path)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks.value)
        for b in it:
            n = np.fromiter((len(encode(enc, t)) for t in b.column(1).to_pylist()), np.int32, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n)], names=[key, "n_tokens"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(batches, f"`{key}` {kind}, n_tokens int")


def decode_texts(df: DataFrame, key: str, ids: str = "ids", path: str = TOKENIZER) -> DataFrame:
    """(key, text) from ids, by raw bytes; the empty list gives the empty text, null gives null."""
    ranks = _rank_file(df.sparkSession, path)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks.value)
        for b in it:
            texts = [None if x is None else decode(enc, x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, ids).mapInArrow(batches, f"`{key}` {kind}, text string")
