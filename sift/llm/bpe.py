"""Byte-level BPE through a sentencepiece model made from a rank file.

The model is written down from the vocabulary, never trained: every token's
bytes become a piece of printable characters, its score is its negative rank,
and the normaliser leaves the text alone. Merging the best-scored pair first
is then the same as merging the lowest rank first.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sift.llm.common import bound_batches, slices

# Pre-tokens whose ids a task remembers at most; then it starts anew.
MEMORY = 200_000


def byte_characters() -> list[str]:
    """A printable, non-blank character for each byte: itself where it is one
    in Latin-1, else the next one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars, free = {b: chr(b) for b in own}, 0x100
    for byte in range(256):
        if byte not in chars:
            chars[byte], free = chr(free), free + 1
    return [chars[b] for b in range(256)]


def read_ranks(lines: list[str]) -> list[bytes]:
    """Tokens by rank, from lines of base64 and rank."""
    ranks = {}
    for line in filter(None, lines):
        token, rank = line.split()
        ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("the ranks are not 0, 1, 2, ...")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose ids are the ranks; one more id is unknown."""
    chars = byte_characters()
    pieces = [
        _bytes(1, "".join(chars[b] for b in token).encode()) + _float(2, -rank)
        for rank, token in enumerate(tokens)
    ]
    pieces.append(_bytes(1, b"<unk>") + _float(2, 0.0) + _number(3, 2))
    # fields of the public model format: type BPE, size, ids of special pieces
    trainer = _number(3, 2) + _number(4, len(pieces)) + _number(40, len(tokens))
    trainer += _number(41, -1) + _number(42, -1) + _number(43, -1)
    # identity; no dummy prefix, no blanks removed, none escaped
    normaliser = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(_bytes(1, p) for p in pieces) + _bytes(2, trainer) + _bytes(3, normaliser)


class Encoder:
    """Encodes texts pre-token by pre-token with a serialised model."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.table = dict(enumerate(byte_characters()))
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of 32-bit numbers."""
        words = [self.split(text) for text in texts]
        if len(self.known) > MEMORY:
            self.known.clear()
        new = list(set().union(*words).difference(self.known))
        if new:
            mapped = [w.encode().decode("latin-1").translate(self.table) for w in new]
            ids = self.pieces.encode(mapped, out_type=int, num_threads=1)
            self.known.update(zip(new, (array("i", i).tobytes() for i in ids), strict=True))
        return [b"".join(map(self.known.__getitem__, w)) for w in words]


@lru_cache(maxsize=2)
def _encoder(model: bytes, pattern: str) -> Encoder:
    return Encoder(model, pattern)


def joined(lists: pa.ListArray, tokens: pa.LargeBinaryArray) -> list[bytes]:
    """For each list of ids the bytes of its tokens, put together."""
    found = tokens.take(lists.flatten())
    ends = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1]
    whole = memoryview(found.buffers()[2]) if len(found) else b""
    at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    cuts = ends[at].tolist()
    return [bytes(whole[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class ByteBpe:
    """Encode and decode columns with the vocabulary of one rank file.

    The rank file is read once, through Spark, and travels to the tasks as a
    model of its own size; it is bounded by the vocabulary.
    """

    def __init__(self, spark: SparkSession, tokens: list[bytes], pattern: str):
        self.pattern = pattern
        self.model = spark.sparkContext.broadcast(serialise(tokens))
        self.tokens = spark.sparkContext.broadcast(tokens)

    @classmethod
    def from_file(cls, spark: SparkSession, path: str, pattern: str) -> ByteBpe:
        """`path` is a file of the driver's machine; executors don't read it."""
        with open(path, encoding="ascii") as lines:
            return cls(spark, read_ranks(lines.read().splitlines()), pattern)

    def encode(
        self,
        df: DataFrame,
        text_col: str = "text",
        ids_col: str = "ids",
        bytes_col: str | None = None,
    ) -> DataFrame:
        """All columns of `df` and the token ids of each text.

        With `bytes_col` the ids are decoded as well, in the same pass. A null
        text counts as empty and has no ids. No special tokens are known; their
        strings are ordinary text.
        """
        added = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
        if bytes_col:
            added.append(T.StructField(bytes_col, T.BinaryType()))
        if taken := sorted({f.name for f in added} & set(df.columns)):
            raise ValueError(f"the table has columns {taken} already; name others")
        bound_batches(df.sparkSession)
        model, tokens, pattern = self.model, self.tokens, self.pattern
        schema = T.StructType([*df.schema, *added])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = _encoder(model.value, pattern)
            known = pa.array(tokens.value, pa.large_binary()) if bytes_col else None
            for batch in batches:
                for piece in slices(batch, text_col):
                    texts = piece.column(piece.schema.get_field_index(text_col)).to_pylist()
                    ids = encoder([t or "" for t in texts])
                    ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
                    flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
                    columns = [*piece.columns, pa.ListArray.from_arrays(pa.array(ends), flat)]
                    if bytes_col:
                        columns.append(pa.array(joined(columns[-1], known), pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        return df.mapInArrow(run, schema)

    def decode(self, df: DataFrame, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
        """All columns of `df` and the bytes that each list of ids stands for."""
        if bytes_col in df.columns:
            raise ValueError(f"the table has a column {bytes_col!r}; name another for the bytes")
        bound_batches(df.sparkSession)
        tokens = self.tokens
        schema = T.StructType([*df.schema, T.StructField(bytes_col, T.BinaryType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = pa.array(tokens.value, pa.large_binary())
            for batch in batches:
                for piece in slices(batch, ids_col):
                    lists = piece.column(piece.schema.get_field_index(ids_col)).fill_null([])
                    column = pa.array(joined(lists, known), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [*piece.columns, column], names=[*piece.schema.names, bytes_col]
                    )

        return df.mapInArrow(run, schema)


def digest_of_ids(ids_col: str = "ids") -> Column:
    return F.sha2(F.array_join(F.col(ids_col).cast("array<string>"), ","), 256)
