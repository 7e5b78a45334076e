"""Packing token sequences by dot-product vector bin packing.

A bin (training sequence) has three capacities: tokens, segments and
loss-bearing tokens. An open bin takes, of all waiting examples that fit in
every dimension, the one whose normalised demand has the largest dot product
with the bin's normalised free capacity; so it prefers what is large where
there is room. When nothing fits whole and more than a sliver is free, the
example with the largest product is cut to fill it.

Examples stream through one pool a task, so memory holds the pool and nothing
of the table, no shuffle is needed, and a lost task is repeated alone. What
is left at the end of a task closes its last bin.
"""

from __future__ import annotations

import gc
import json
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, compress, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import arrow_type, batches_of, kept_in_process, rows_of, small_batches
from caseloom.session import table

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Words in one generation of the encoder's cache: about 80 MB; fewer cost time.
MAX_WORDS = 500_000


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence; a gap under ``sliver`` tokens is padded, not filled."""

    tokens: int = 2048
    segments: int = 128
    loss: int = 2048
    sliver: int = 8


class Encoder:
    """Token ids of whole texts by the ``tokenizers`` library, with a word cache.

    The tokenizer never lets a token span white space, and its normaliser acts
    within words, so a text's ids are those of its words (split at the six
    ASCII white-space bytes) in a row. Words go to the library when they are
    new. The cache has two generations of about ``max_words``, so that words
    in use survive and memory stays bounded.
    """

    _TAIL = b",.;:!?"

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.by_word = _splits_at_space(path)
        vocab = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocab.values()) + 1, bool)
        self.is_end[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.max_words = max_words

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, each one token run with one word-ending token.

        A thousand go to the library in one call, as a text with a space
        between them. Should a run not be one word after all, the number of
        endings differs and those words are encoded one by one.
        """
        out: list[bytes] = []
        for i in range(0, len(words), 1000):
            some = words[i : i + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(some) and (not len(ids) or ends[-1] == len(ids)):
                raw, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
                out += [raw[x:y] for x, y in zip(bounds, bounds[1:])]
            else:
                out += self._ids(some)
        return out

    def _learn(self, missing: set[bytes]) -> None:
        """Cache ids of words; a tail of ASCII punctuation is a token run of its own."""
        words = self.words
        plain, texts, rest, _ = _letters(list(missing))
        cores = list(map(bytes.rstrip, rest, repeat(self._TAIL)))
        _, _, _, fine = _letters(cores)
        tailed = [(w, c) for w, c, ok in zip(rest, cores, fine, strict=True) if ok]
        new, new_texts, _, _ = _letters(list({c for _, c in tailed}.difference(words, plain)))
        others = [w for w, ok in zip(rest, fine, strict=True) if not ok]
        others += {w[len(c) :] for w, c in tailed}.difference(words)
        words |= zip(others, self._ids([w.decode() for w in others]), strict=True)
        words |= zip(chain(plain, new), self._word_ids(texts + new_texts), strict=True)
        for w, c in tailed:
            words[w] = words[c] + words[w[len(c) :]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            return self._ids(texts)
        gc.disable()  # nothing here is cyclic, and lists of all words are long to scan
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > self.max_words:
            self.words, self.old = {}, self.words
        raw = [t.encode() for t in texts]
        split = [(b.lower() if b.isascii() else b).split() for b in raw]
        missing = set().union(*split).difference(self.words)
        if self.old:
            known = missing.intersection(self.old)
            self.words |= zip(known, map(self.old.__getitem__, known))
            missing -= known
        if missing:
            self._learn(missing)
        get = self.words.__getitem__
        return [b"".join(map(get, words)) for words in split]


def _letters(words: list[bytes]) -> tuple[list[bytes], list[str], list[bytes], list[bool]]:
    """Words of letters only, the same as text, the other words, and which is which."""
    texts = b" ".join(words).decode().split(" ") if words else []
    fine = list(map(str.isalpha, texts))
    return list(compress(words, fine)), list(compress(texts, fine)), [w for w, ok in zip(words, fine, strict=True) if not ok], fine


def _splits_at_space(path: str) -> bool:
    """Whether the tokenizer drops white space and lower-cases, as ``Encoder`` needs."""
    spec = json.load(open(path, encoding="utf-8"))
    steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    pre = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return steps == ["NFC", "Replace", "Lowercase"] and pre.get("behavior") == "Removed" and pre.get("invert") is True and r"[^\s\p{L}\p{N}]+" in pre.get("pattern", {}).get("Regex", "")


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int, max_words: int) -> Iterator[tuple]:
    """(id, ids) of (row_id, body) rows, encoded a few megabytes at a time."""
    encoder = kept_in_process(("word-encoder", path, max_words), lambda: Encoder(path, max_words))
    end = np.array([end_id], "<u4").tobytes()
    keys, texts, held = [], [], 0

    def encoded() -> Iterator[tuple]:
        for key, ids in zip(keys, encoder.encode(texts), strict=True):
            yield key, ids + end

    for key, text in rows_of(batches):
        keys.append(key)
        texts.append(text)
        held += len(text)
        if held > 16 * max_words:  # a batch of text in proportion to the cache
            yield from encoded()
            keys, texts, held = [], [], 0
    yield from encoded()


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("row_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = END_ID, max_words: int = MAX_WORDS) -> DataFrame:
    """(id, ids): a text's ids and ``end_id``, little-endian uint32 bytes. Null is empty."""
    path = path or public_tokenizers.path(TOKENIZER)
    rows = _texts(docs, id_col, text_col)
    types = [arrow_type(rows, "row_id"), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(_encoded(batches, path, end_id, max_words), ["row_id", "ids"], types, 1)

    kind = rows.schema["row_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row_id {kind}, ids binary").withColumnRenamed("row_id", id_col)


class Packer:
    """Streams examples of one task into sequences.

    ``add`` and ``finish`` yield pieces: (example, start, length, sequence,
    offset), with examples numbered as added and sequences from 0.
    """

    def __init__(self, limits: Limits, pool: int = 512):
        self.limits, self.size = limits, pool
        self.cap = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.wait = np.zeros((pool, 3))  # demand of each waiting rest
        self.free = list(range(pool))[::-1]
        self.rest: list = [None] * pool  # (example, start, end, loss_start)
        self.examples = self.sequences = 0

    def _loss(self, start: int, end: int, loss_start: int) -> int:
        return max(0, end - max(start, loss_start))

    def add(self, n: int, loss_start: int = 0) -> Iterator[tuple[int, int, int, int, int]]:
        """An example of n tokens whose tokens from ``loss_start`` on bear loss."""
        t, s = self.limits, 0
        k, self.examples = self.examples, self.examples + 1
        while n - s >= t.tokens or self._loss(s, n, loss_start) > t.loss:
            e = min(n, s + t.tokens, max(s, loss_start) + t.loss)
            if e - s < t.tokens:  # the loss limit cuts here: a rest that others can join
                yield from self._put(k, s, e, loss_start)
            else:
                yield k, s, e - s, self.sequences, 0
                self.sequences += 1
            s = e
        if s < n:
            yield from self._put(k, s, n, loss_start)

    def _put(self, k: int, s: int, e: int, loss_start: int):
        if not self.free:
            while len(self.free) < self.size // 2:
                yield from self._fill()
        slot = self.free.pop()
        self.rest[slot] = (k, s, e, loss_start)
        self.wait[slot] = (e - s, 1, self._loss(s, e, loss_start))

    def _fill(self):
        """Fill one sequence from the pool."""
        left, at, seq = self.cap.copy(), 0, self.sequences
        self.sequences += 1
        live = self.wait[:, 1] > 0
        while left[1] >= 1 and left[0] >= 1 and live.any():
            score = self.wait @ (left / self.cap / self.cap)
            fits = live & (self.wait[:, 0] <= left[0]) & (self.wait[:, 2] <= left[2])
            if fits.any():
                slot = int(np.argmax(np.where(fits, score, -1)))
                k, s, e, loss_start = self.rest[slot]
                n = e - s
                self.wait[slot], live[slot], self.rest[slot] = 0, False, None
                self.free.append(slot)
            else:
                if left[0] < self.limits.sliver:
                    break
                slot = int(np.argmax(np.where(live, score, -1)))
                k, s, e, loss_start = self.rest[slot]
                n = int(min(left[0], e - s, max(s, loss_start) + left[2] - s))
                if n <= 0:
                    break
                self.rest[slot] = (k, s + n, e, loss_start)
                self.wait[slot] = (e - s - n, 1, self._loss(s + n, e, loss_start))
                live[slot] = False  # its rest opens another sequence
            yield k, s, n, seq, at
            left -= (n, 1, self._loss(s, s + n, loss_start))
            at += n

    def finish(self):
        while len(self.free) < self.size:
            yield from self._fill()


_PIECES = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_COLUMNS = ["row_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def _pieces(examples: Iterable[tuple], limits: Limits, pool: int) -> Iterator[tuple]:
    """(id, ids, loss_start) in a task's order to rows of pieces."""
    packer, base = Packer(limits, pool), TaskContext.get().partitionId() << 32
    held: dict[int, list] = {}  # examples with tokens not placed yet

    def rows_of(pieces: Iterable[tuple]) -> Iterator[tuple]:
        for k, s, n, seq, at in pieces:
            key, ids, left = held[k]
            yield key, s, n, ids[4 * s : 4 * (s + n)], len(ids) // 4, base + seq, at
            if left == n:
                del held[k]
            else:
                held[k][2] = left - n

    for key, ids, loss_start in examples:
        if ids:
            held[packer.examples] = [key, ids, len(ids) // 4]
            yield from rows_of(packer.add(len(ids) // 4, int(loss_start)))
    yield from rows_of(packer.finish())


def pack(examples: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", loss_col: str | None = None, limits: Limits = Limits(), pool: int = 512) -> DataFrame:
    """Pieces: id, start, length, ids (of the piece), doc_tokens, sequence_id, offset.

    ``ids_col`` has little-endian uint32 bytes; ``loss_col``, if named, the
    index from which an example's tokens bear loss (null or none: from 0).
    Null or empty ids give no piece. Repeated rows are packed one by one. The
    sequence number holds the task's number, so it is unique in the result.
    """
    rows = examples.select(F.col(id_col).alias("row_id"), F.col(ids_col).alias("ids"), (F.coalesce(F.col(loss_col), F.lit(0)) if loss_col else F.lit(0)).cast("long").alias("loss_start"))

    types = [arrow_type(rows, "row_id"), *_TYPES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(_pieces(rows_of(batches), limits, pool), _COLUMNS, types, 3)

    kind = rows.schema["row_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row_id {kind}, {_PIECES}").withColumnRenamed("row_id", id_col)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits(), path: str | None = None, end_id: int = END_ID, pool: int = 512, max_words: int = MAX_WORDS) -> DataFrame:
    """``tokenize`` and ``pack`` in one pass over the texts: all tokens bear loss.

    Null and empty texts are one piece, the end id alone. Repeated rows and
    rows with a null id are packed one by one, so their pieces share an id.
    A text of any length is cut into pieces; memory holds the pool and the
    texts whose tokens wait. An empty table gives no pieces; only the two
    columns are read, so extra columns cannot clash.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    rows = _texts(docs, id_col, text_col)
    types = [arrow_type(rows, "row_id"), *_TYPES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = ((key, ids, 0) for key, ids in _encoded(batches, path, end_id, max_words))
        yield from batches_of(_pieces(examples, limits, pool), _COLUMNS, types, 3)

    kind = rows.schema["row_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row_id {kind}, {_PIECES}").withColumnRenamed("row_id", id_col)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {"op7_packing": op7_packing}
ORACLE_SQL: dict[str, str] = {}
