"""URL filters over a sorted array of 64-bit digests.

A list of rules becomes one file: sorted xxhash64 digests of the rule strings,
their offsets, an allow/block byte each and the strings themselves. Executors
fetch the file (Spark distributes it), map the arrays into memory, and look up
a whole batch of URLs by vectorised binary search. A digest hit counts only if
the stored string is equal, so collisions change nothing.

A rule is ``host`` + ``path``, like ``net/`` or ``example.net/en/``. It fits
its host and all subdomains if the URL's path starts with the rule's path. A
URL's candidates are its host suffixes of the label counts that occur among the
rules times its path prefixes of the lengths that occur, so their number does
not grow with the URL.

Lists are tuples or a DataFrame. Their size is measured before anything is
built; beyond ``MAX_INDEX_BYTES`` they are joined, not sent out.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import arrow_type, join_hot
from caseloom.session import settle, shared_dir, table

_FOLD = {ord("A") + i: ord("a") + i for i in range(26)}
_URL = re.compile(r"://([^/?#]*)([^?#]*)")
_MAGIC = b"SDA2"
#: Above this size (about 500,000 rules) the index isn't built or sent out; the rules are joined instead.
MAX_INDEX_BYTES = 32 << 20
#: Bytes of an entry in the index besides its strings.
_ENTRY_BYTES = 18

#: The rules that the query is given.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: The query's sample of a block list for URLs that no rule fits; real lists come as a parameter.
LISTED_NAMES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED = tuple((f"{name}.example.{tld}", "/", "block") for name in LISTED_NAMES for tld in ("com", "net", "org"))


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path); both empty for null or a URL without ``://``."""
    m = _URL.search(url) if url else None
    return (m[1].translate(_FOLD), m[2]) if m else ("", "")


def digest64(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def build_index(rules: Iterable[tuple[str, str, str]], digest: Callable[[str], int] = digest64) -> bytes:
    """The index file's bytes. Of rules with equal host and path the last holds."""
    verdicts = {(host.translate(_FOLD), path): verdict for host, path, verdict in rules}
    entries = sorted((digest(h + p), h, p, v) for (h, p), v in verdicts.items())
    keys = np.array([e[0] for e in entries], "<u8")
    blobs = [f"{h}\0{p}".encode() for _, h, p, _ in entries]
    offsets = np.zeros(len(entries) + 1, "<i8")
    np.cumsum([len(b) for b in blobs], out=offsets[1:])
    blocks = np.array([v == "block" for *_, v in entries], "u1")
    lengths = np.array(sorted({len(p) for _, _, p, _ in entries}), "<i4")
    labels = np.array(sorted({h.count(".") + 1 for _, h, _, _ in entries}), "<i4")
    head = _MAGIC + struct.pack("<qqq", len(entries), len(lengths), len(labels))
    return b"".join([head, keys.tobytes(), offsets.tobytes(), lengths.tobytes(), labels.tobytes(), blocks.tobytes(), *blobs])


class DigestIndex:
    """Read side of ``build_index``; ``source`` is a path (mapped) or bytes."""

    def __init__(self, source: str | bytes, digest: Callable[[str], int] = digest64):
        raw = np.frombuffer(source, "u1") if isinstance(source, bytes) else np.memmap(source, "u1", "r")
        n, m, k = struct.unpack("<qqq", raw[4:28].tobytes())
        at, parts = 28, []
        for kind, size in (("<u8", n), ("<i8", n + 1), ("<i4", m), ("<i4", k), ("u1", n)):
            width = np.dtype(kind).itemsize * size
            parts.append(raw[at : at + width].view(kind))
            at += width
        self.keys, self.offsets, lengths, labels, self.blocks = parts
        self.lengths, self.labels, self.strings, self.digest = lengths.tolist(), labels.tolist(), raw[at:], digest

    def find(self, texts: list[tuple[str, str]]) -> list[int]:
        """Entry number of each (host, path), or -1."""
        if not texts or not len(self.keys):
            return [-1] * len(texts)
        probes = np.fromiter((self.digest(h + p) for h, p in texts), "<u8", len(texts))
        at = np.searchsorted(self.keys, probes)
        hit = self.keys[np.minimum(at, len(self.keys) - 1)] == probes
        out = np.full(len(texts), -1)
        for i in np.flatnonzero(hit).tolist():
            want, k = "\0".join(texts[i]).encode("utf-8", "surrogatepass"), int(at[i])
            while k < len(self.keys) and self.keys[k] == probes[i]:  # digests may collide
                if self.strings[self.offsets[k] : self.offsets[k + 1]].tobytes() == want:
                    out[i] = k
                    break
                k += 1
        return out.tolist()

    def judge(self, urls: list[tuple[str, str]]) -> list[tuple[str, str] | None]:
        """(rule string, verdict) of the longest rule that fits, or None."""
        spans, texts = [], []
        for host, path in urls:
            found = list(candidates(host, path, self.lengths, self.labels))
            spans.append((len(texts), len(texts) + len(found)))
            texts += found
        hits = self.find(texts)
        out: list[tuple[str, str] | None] = []
        for lo, hi in spans:
            best = max((i for i in range(lo, hi) if hits[i] >= 0), key=lambda i: (len(texts[i][0]) + len(texts[i][1]), len(texts[i][0])), default=None)
            out.append(None if best is None else ("".join(texts[best]), "block" if self.blocks[hits[best]] else "allow"))
        return out


def candidates(host: str, path: str, lengths: Iterable[int], labels: Iterable[int]) -> Iterator[tuple[str, str]]:
    """Every (host suffix, path prefix) that a rule of these path lengths and label counts could be.

    ``labels`` rises; the host is walked once from its end.
    """
    if not host:
        return
    prefixes = [path[:n] for n in lengths if n <= len(path)]
    at, have = len(host), 0
    for n in labels:
        while have < n and at >= 0:
            at, have = host.rfind(".", 0, at), have + 1
        if have < n:
            return
        for p in prefixes:
            yield host[at + 1 :], p


def publish(spark: SparkSession, data: bytes) -> str:
    """Put bytes into the shared folder and have Spark hand them to executors."""
    name = f"urls-{uuid.uuid4().hex}.idx"
    jvm, where = spark.sparkContext._jvm, f"{shared_dir(spark)}/{name}"
    path = jvm.org.apache.hadoop.fs.Path(where)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    for i in range(0, len(data), 1 << 20):
        out.write(bytearray(data[i : i + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(where)
    return name


def _as_table(spark: SparkSession, rules) -> DataFrame:
    """Rules as (r_host, r_path, r_verdict) with hosts folded, one row a host and path.

    Of a DataFrame's rules with equal host and path the block holds, of
    tuples' the last.
    """
    upper = "".join(map(chr, _FOLD))
    if isinstance(rules, DataFrame):
        host, path, verdict = (F.col(c) for c in rules.columns[:3])
        named = rules.select(F.translate(host, upper, upper.lower()).alias("r_host"), F.coalesce(path, F.lit("")).alias("r_path"), verdict.alias("r_verdict"))
        return named.filter(F.col("r_host").isNotNull()).groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
    entries = {(h.translate(_FOLD), p): v for h, p, v in rules}
    return spark.createDataFrame([(*key, v) for key, v in entries.items()], "r_host string, r_path string, r_verdict string")


def _index_bytes(rules) -> int:
    """Size that the rules' index would have, at most."""
    if isinstance(rules, DataFrame):
        host, path, _ = (F.col(c) for c in rules.columns[:3])
        n, chars = rules.agg(F.count(F.lit(1)), F.sum(F.octet_length(host) + F.coalesce(F.octet_length(path), F.lit(0)))).first()
        return n * _ENTRY_BYTES + (chars or 0)
    return sum(_ENTRY_BYTES + 4 * len(h + p) for h, p, _ in rules)


def judge_urls(pages: DataFrame, rules=RULES, listed=LISTED, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row a page: id, host, path, rule, verdict, listed.

    ``rules`` and ``listed`` are (host, path, verdict) tuples or a DataFrame
    with these three columns first. ``rule`` is the longest of ``rules`` that
    fits, with its verdict; without one it is null and the verdict is that of
    ``listed`` (column listed has the entry), else ``default``. Null URLs and
    URLs without ``://`` have empty host and path, fit nothing and get
    ``default``. Hosts and paths of any length cost time in proportion.
    Repeated rows are judged alike; an empty table gives no rows, an empty
    list fits nothing; only the two named columns are read.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("row_id"), F.col(url_col).alias("url"))
    if _index_bytes(rules) + _index_bytes(listed) > MAX_INDEX_BYTES:
        return _judge_by_join(rows, rules, listed, default).withColumnRenamed("row_id", id_col)
    lists = [[tuple(r) for r in _as_table(spark, some).collect()] if isinstance(some, DataFrame) else some for some in (rules, listed)]
    names = [publish(spark, build_index(some)) for some in lists]

    columns = ["row_id", "host", "path", "rule", "verdict", "listed"]
    types = [arrow_type(rows, "row_id"), *[pa.string()] * 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = (DigestIndex(SparkFiles.get(n)) for n in names)
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            ruled, found = first.judge(parts), second.judge(parts)
            verdicts = [(r or s or ("", default))[1] for r, s in zip(ruled, found, strict=True)]
            values = [[h for h, _ in parts], [p for _, p in parts], [r and r[0] for r in ruled], verdicts, [s and s[0] for s in found]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, t) for v, t in zip(values, types[1:], strict=True))], names=columns)

    kind = rows.schema["row_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"row_id {kind}, host string, path string, rule string, verdict string, listed string")
    return out.withColumnRenamed("row_id", id_col)


def _judge_by_join(rows: DataFrame, rules, listed, default: str) -> DataFrame:
    """The same for rule lists too large to send out: an equi-join on candidates.

    A rule that many pages could meet (``net/``) is a hot key: ``join_hot``
    broadcasts those few rules, so the pages of a hot host stay spread.
    """
    spark = rows.sparkSession
    keys = settle(_as_table(spark, rules).withColumn("which", F.lit(0)).unionByName(_as_table(spark, listed).withColumn("which", F.lit(1))), "url-rules")
    n_labels = F.size(F.split("r_host", r"\."))
    lengths, labels = keys.agg(F.array_sort(F.collect_set(F.length("r_path"))), F.array_sort(F.collect_set(n_labels))).first()
    upper = "".join(map(chr, _FOLD))
    numbered = rows.withColumn("__n", F.monotonically_increasing_id())
    parts = settle(numbered.select("row_id", "__n", F.coalesce(F.translate(F.regexp_extract("url", _URL.pattern, 1), upper, upper.lower()), F.lit("")).alias("host"), F.coalesce(F.regexp_extract("url", _URL.pattern, 2), F.lit("")).alias("path")), "url-parts")
    host_labels = F.split("host", r"\.")
    counts = F.filter(F.array(*map(F.lit, labels)).cast("array<int>"), lambda n: n <= F.size(host_labels))
    prefixes = F.transform(F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path")), lambda n: F.substring("path", F.lit(1), n))
    probes = parts.filter("host <> ''").select("__n", F.explode(F.transform(counts, lambda n: F.array_join(F.slice(host_labels, F.size(host_labels) - n + 1, n), "."))).alias("r_host"), prefixes.alias("p")).select("__n", "r_host", F.explode("p").alias("r_path"))
    probes = settle(probes.withColumn("key", F.concat_ws("\0", "r_host", "r_path")), "url-probes")
    held = keys.groupBy(F.concat_ws("\0", "r_host", "r_path").alias("key")).agg(F.collect_list(F.struct("which", "r_verdict")).alias("rules"))  # one or two
    wanted = probes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(held, "key")
    hits = join_hot(probes, wanted, "key", probes.count(), "url-wanted").select("__n", "r_host", "r_path", F.explode("rules").alias("r")).select("__n", "r_host", "r_path", "r.*")
    rank = F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"))
    best = hits.groupBy("__n").pivot("which", [0, 1]).agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("s"), F.col("r_verdict").alias("v")), rank))
    out = parts.join(best, "__n", "left")
    return out.select("row_id", "host", "path", F.col("0.s").alias("rule"), F.coalesce(F.col("0.v"), F.col("1.v"), F.lit(default)).alias("verdict"), F.col("1.s").alias("listed"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


QUERIES = {"op10_url_filter": op10_url_filter}
_VALUES = ", ".join(f"({k}, '{h}', '{p}', '{v}')" for k, some in enumerate((RULES, LISTED)) for h, p, v in some)
ORACLE_SQL = {
    "op10_url_filter": f"""
WITH rules(which, r_host, r_path, r_verdict) AS (VALUES {_VALUES}),
parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), hits AS (
  SELECT DISTINCT page_id, host, path, which, r_host || r_path AS rule, r_verdict,
         row_number() OVER (PARTITION BY page_id, which ORDER BY length(r_host) + length(r_path) DESC, length(r_host) DESC) AS k
  FROM parts JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
)
SELECT page_id, host, path, a.rule AS rule, coalesce(a.r_verdict, b.r_verdict, 'allow') AS verdict, b.rule AS listed
FROM parts
LEFT JOIN (SELECT page_id, rule, r_verdict FROM hits WHERE k = 1 AND which = 0) a USING (page_id)
LEFT JOIN (SELECT page_id, rule, r_verdict FROM hits WHERE k = 1 AND which = 1) b USING (page_id)
"""
}
