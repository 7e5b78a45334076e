"""Line dedup over range-partitioned line hashes.

Each line long enough to count becomes (128-bit hash of its key, document,
position). Rows are range-partitioned by (hash, document descending) and
sorted, so a task streams each hash's documents from the largest down: the
first is the one that keeps its lines, the others' lines fall once enough
documents are seen. Because the document is part of the range key, a line
that a third of the corpus holds spreads over many tasks; the one run at
either end of a partition may go on next door, so it is left pending with a
summary row, and the summaries (two a partition) settle it.

The result is one compressed keep bitmap a document, not text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.exact_dedup import fold_ascii
from caseloom.llm.common import arrow_type, batches_of, rows_of
from caseloom.session import settle, table

MIN_CHARS = 20
MIN_DOCS = 3
_STRIP = " \t\n\x0b\x0c\r"
_DROP, _PENDING, _SUMMARY = 0, 1, 2


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return fold_ascii(F.btrim(line, F.lit(_STRIP)))


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    lines = docs.select(docs[id_col].alias("doc"), F.xxhash64(text).alias("tag"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    keyed = lines.select("doc", "tag", "pos", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(11), "key").alias("h2"), "doc", "tag", "pos")


def scan_runs(rows: Iterator[tuple], min_docs: int) -> Iterator[tuple]:
    """Stream one partition's (h1, h2, doc, tag, pos), sorted by hash and falling doc.

    Yields (what, h1, h2, doc, tag, pos, n_docs). The first and the last run
    come out as pending lines and one summary (largest doc, number of docs).
    """
    key, first_run = None, True
    n_docs, top, last = 0, None, None
    held: list[tuple] = []  # lines below the top document, while too few documents are seen
    for h1, h2, doc, tag, pos in rows:
        if key != (h1, h2):
            if key is not None:
                if first_run:
                    yield (_SUMMARY, *key, top, None, None, n_docs)
                first_run = False
            key, n_docs, top, last, held = (h1, h2), 1, doc, doc, []
        elif doc != last:
            n_docs, last = n_docs + 1, doc
        if first_run:
            yield (_PENDING, h1, h2, doc, tag, pos, None)
        elif n_docs > 1:  # the top document keeps its lines
            held.append((doc, tag, pos))
            if n_docs >= min_docs:
                yield from ((_DROP, h1, h2, d, t, p, None) for d, t, p in held)
                held = []
    if key is not None:
        # A last run that began here has the largest document of all partitions
        # on top, for larger ones come earlier; next door only adds documents.
        yield from ((_PENDING, *key, d, t, p, None) for d, t, p in held)
        yield (_SUMMARY, *key, top, None, None, n_docs)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Documents that lose lines: doc, tag, n_dropped, bitmap.

    A line's key (see ``line_key``) of at least ``min_chars`` code points in
    at least ``min_docs`` documents stays only in the largest id that holds
    it, there in all its places. Bit k of the bitmap (zlib, numpy order) says
    whether line k stays; lines after its end stay. ``tag`` is xxhash64 of
    the text: rows that repeat an id count as one document, and each of their
    texts gets its own bitmap. A null text is one empty line, a null id is
    the smallest. Only the two named columns are read.
    """
    lines = _lines(docs, id_col, text_col, min_chars)
    kind = lines.schema["doc"].dataType.simpleString()
    dealt = lines.repartitionByRange("h1", "h2", F.desc("doc")).sortWithinPartitions("h1", "h2", F.desc("doc"), "tag", "pos")
    schema = f"what int, h1 long, h2 long, doc {kind}, tag long, pos int, n_docs long"
    columns = ["what", "h1", "h2", "doc", "tag", "pos", "n_docs"]

    types = [pa.int32(), pa.int64(), pa.int64(), arrow_type(lines, "doc"), pa.int64(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(scan_runs(rows_of(batches, 4096), min_docs), columns, types, most=20_000)

    found = settle(dealt.mapInArrow(run, schema), "line-runs")
    # At most two summaries a partition, so this side is bounded by their number.
    edges = found.filter(F.col("what") == _SUMMARY).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n"), F.max("doc").alias("top")).filter(F.col("n") >= min_docs)
    pending = found.filter(F.col("what") == _PENDING).select("h1", "h2", "doc", "tag", "pos").join(F.broadcast(edges), ["h1", "h2"]).filter(~F.col("doc").eqNullSafe(F.col("top")))
    drops = found.filter(F.col("what") == _DROP).select("doc", "tag", "pos").unionByName(pending.select("doc", "tag", "pos"))

    kept_types = [arrow_type(lines, "doc"), pa.int64(), pa.int64(), pa.binary()]

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = ((doc, tag, len(set(lost)), pack_keep(lost)) for doc, tag, lost in rows_of(batches))
        yield from batches_of(packed, ["doc", "tag", "n_dropped", "bitmap"], kept_types, 3)

    lost = drops.groupBy("doc", "tag").agg(F.collect_list("pos").alias("lost"))  # bounded by one document's lines
    return lost.mapInArrow(bits, f"doc {kind}, tag long, n_dropped long, bitmap binary")


def pack_keep(lost) -> bytes:
    """Compressed keep bits for the given dropped positions."""
    keep = np.ones(-(-(max(lost) + 1) // 8) * 8, bool)  # whole bytes, padded with kept
    keep[np.asarray(lost, int)] = False
    return zlib.compress(np.packbits(keep).tobytes())


def apply_keep(text: str | None, bitmap: bytes | None) -> tuple[str, int, int]:
    """(kept text, lines before, lines dropped)."""
    lines = (text or "").split("\n")
    if bitmap is None:
        return "\n".join(lines), len(lines), 0
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), "u1")).astype(bool)[: len(lines)]
    kept = [x for x, k in zip(lines, keep.tolist()) if k] + lines[len(keep) :]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row a document: id, kept text, n_lines before, n_dropped.

    A null or empty text is one empty line. Rows that repeat an id count as
    one document and are judged alike where their texts are equal; a null id
    is the smallest. A text that loses all its lines is empty. An empty table
    gives no rows; only the two columns are read. Texts are handled whole, one
    at a time.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    maps = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs).withColumnRenamed("doc", "m_doc").withColumnRenamed("tag", "m_tag").hint("shuffle_hash")
    joined = rows.join(maps, F.col("doc").eqNullSafe(F.col("m_doc")) & (F.xxhash64("body") == F.col("m_tag")), "left").select("doc", "body", "bitmap")

    types = [arrow_type(rows, "doc"), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = ((doc, *apply_keep(text, bitmap)) for doc, text, bitmap in rows_of(batches))
        yield from batches_of(kept, ["doc", "kept_text", "n_lines", "n_dropped"], types, 1)

    kind = rows.schema["doc"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc {kind}, kept_text string, n_lines long, n_dropped long").withColumnRenamed("doc", id_col)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {"op6_line_dedup": op6_line_dedup}
ORACLE_SQL = {
    "op6_line_dedup": """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), hot AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT doc_id, pos, line, top IS NOT NULL AND top <> doc_id AS gone FROM keyed LEFT JOIN hot USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
}
