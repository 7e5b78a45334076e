"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Merging a pre-token keeps its tokens as a linked list of byte positions and
its candidate pairs in buckets, one a merge rank. Which buckets hold anything
is noted in a bitmap of blocks and, below it, one bitmap a block, so the next
rank is two find-first-set operations away. Within a rank the leftmost
position goes first. Entries whose pair has changed are skipped when they
come up. So a pre-token of n bytes costs about n log n, however long it is.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import arrow_type, batches_of, kept_in_process, rows_of, small_batches
from caseloom.session import table

RANKS = "byte_bpe_multi_50k.tiktoken"
_BLOCK = 8  # bits of a rank within its block
_LOW = (1 << _BLOCK) - 1
_BITS = [1 << i for i in range(1 << _BLOCK)]
#: Characters from which on a text's pre-tokens are not held at once.
LONG_TEXT = 1 << 20


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token.

    The queue is written out in place, for it is the hot loop: ``top`` has a
    bit for each block of 256 ranks that is not empty, ``blocks`` has each
    block's bits, and ``buckets`` a rank's positions (one number, or a heap
    once there are more).
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, get = len(piece), ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pair: list[int | None] = [get(piece[i : i + 2]) for i in range(n - 1)]
    pair.append(None)
    top, blocks, buckets = 0, {}, {}
    fresh = [i for i, r in enumerate(pair) if r is not None]
    while True:
        for i in fresh:  # push
            rank = pair[i]
            held = buckets.get(rank)
            if held is None:
                buckets[rank] = i
                block = rank >> _BLOCK
                top |= 1 << block
                blocks[block] = blocks.get(block, 0) | _BITS[rank & _LOW]
            elif type(held) is int:
                buckets[rank] = [held, i] if held < i else [i, held]
            else:
                heappush(held, i)
        fresh = ()
        if not top:
            break
        low = top & -top  # find the first block, then its first rank
        block = low.bit_length() - 1
        bits = blocks[block]
        first = bits & -bits
        rank = (block << _BLOCK) + first.bit_length() - 1
        held = buckets[rank]
        if type(held) is int:
            i, held = held, None
        else:
            i = heappop(held)
        if not held:
            del buckets[rank]
            bits ^= first
            blocks[block] = bits
            if not bits:
                top ^= low
        if pair[i] != rank:
            continue  # stale: the pair at i is another by now
        j = after[i]
        k = after[j]
        after[i], pair[j] = k, None
        pair[i] = None
        if k < n:
            before[k] = i
            pair[i] = get(piece[i : after[k]])
        p = before[i]
        if p >= 0:
            pair[p] = get(piece[p:k])
            if pair[p] is not None:
                fresh = (p,) if pair[i] is None else (p, i)
                continue
        if pair[i] is not None:
            fresh = (i,)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class _Cache(dict):
    """Ids of pre-tokens as bytes; two generations of at most ``size``, so that common ones survive."""

    def __init__(self, ranks: dict[bytes, int], size: int):
        self.ranks, self.size, self.old = ranks, size, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(merge(piece.encode(), self.ranks), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= self.size:  # the full generation becomes the old one
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Bpe:
    """Encoder and decoder for one rank file; ``pattern`` cuts text into pre-tokens."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, cached: int = 400_000):
        self.ranks = load_ranks(path)
        self.cut = regex.compile(pattern)
        self.cache = _Cache(self.ranks, cached)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            self.tokens[i] = token

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        The pre-tokens of a long text are walked one by one, not listed first.
        """
        if len(text) <= LONG_TEXT:
            pieces = self.cut.findall(text)
        else:
            pieces = (m[0] for m in self.cut.finditer(text))
        return b"".join(map(self.cache.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _coded(docs: DataFrame, id_col: str, text_col: str, path: str, pattern: str, back: bool) -> DataFrame:
    """(id, ids) of every row and, if ``back``, decoded; one pass in one worker with one cache."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("row_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))

    names = ["row_id", "ids", "decoded"][: 2 + back]
    types = [arrow_type(rows, "row_id"), pa.binary(), pa.binary()][: 2 + back]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        bpe = kept_in_process(("bpe", path, pattern), lambda: Bpe(path, pattern))
        for key, text in rows_of(batches):
            ids = bpe.encode(text)
            yield (key, ids, bpe.decode(ids)) if back else (key, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here is cyclic; scanning the caches again and again is slow
        try:
            yield from batches_of(encoded(batches), names, types, 1)
        finally:
            gc.enable()

    kind = rows.schema["row_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row_id {kind}, ids binary" + ", decoded binary" * back).withColumnRenamed("row_id", id_col)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(id, ids) of every row, as little-endian unsigned 32-bit integers.

    A null text is empty and has no ids. Rows are coded one by one, so
    repeated rows agree and null ids are ordinary; an empty table gives no
    rows. Long texts and long pre-tokens are coded whole: memory holds one
    text, its ids and caches of bounded size. Only the two columns are read.
    """
    return _coded(docs, id_col, text_col, path or public_tokenizers.path(RANKS), pattern, False)


def encode_and_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(id, ids, decoded): ``encode`` and ``decode`` in one pass over the texts."""
    return _coded(docs, id_col, text_col, path or public_tokenizers.path(RANKS), pattern, True)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(id, ids, decoded): the bytes that the ids stand for; null ids are none.

    Repeated rows are decoded alike; an empty table gives no rows.
    """
    path = path or public_tokenizers.path(RANKS)
    rows = encoded.select(F.col(id_col).alias("row_id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))

    types = [arrow_type(rows, "row_id"), pa.binary(), pa.binary()]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        bpe = kept_in_process(("bpe", path, public_tokenizers.PATTERN), lambda: Bpe(path))
        for key, ids in rows_of(batches):
            yield key, ids, bpe.decode(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(decoded(batches), ["row_id", "ids", "decoded"], types, 1)

    kind = rows.schema["row_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row_id {kind}, ids binary, decoded binary").withColumnRenamed("row_id", id_col)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_and_decode(table(spark, sf_dir, "documents"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op4_byte_bpe": op4_byte_bpe}
ORACLE_SQL: dict[str, str] = {}
