"""Exact dedup by skew-safe combining.

Copies are combined three times, each time comparing whole texts, because the
text itself is part of every grouping key:

1. locally, by the map-side half of the first aggregate: the salt is fixed for
   a task, so a task sends one row for each text it holds, however many copies
   it read;
2. by (digest, salt, text): the rows of a hot text that many tasks hold are
   spread over ``salts`` reducers;
3. by (digest, text): at most ``salts`` rows of a text meet, and the largest
   id wins globally.

Membership is joined back by digest. A digest that stands for two different
texts (tests force this with a weak digest) is joined by digest and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.session import settle, table

SALTS = 16
#: Rows of (id, digest) that may be broadcast: about 100 bytes each, 20 MB.
BROADCAST_ROWS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty.

    Pure ASCII texts take ``lower``, which is the same there and much faster.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def sha256_of(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text's UTF-8 bytes."""
    return F.sha2(text, 256)


def winners(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row a text: digest, text, keep_id (largest id) and group_size.

    ``rows`` has row_id, digest and body. Null ids lose to any other; a group
    of null ids only has a null keep_id.
    """
    rows = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = rows.groupBy("digest", "salt", "body").agg(F.max("row_id").alias("best"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("digest", "body").agg(F.max("best").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest=sha256_of, exact_digest: bool = True) -> DataFrame:
    """Class of every row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null is empty.
    Empty tables give no rows. Of rows that repeat one id and text, exactly
    one is kept. Only the two named columns are read, so extra columns cannot
    clash. ``exact_digest=False`` is for digests that may collide: there
    membership is decided by comparing texts.
    """
    rows = docs.select(F.col(id_col).alias("row_id"), fold_ascii(F.col(text_col)).alias("body")).select("row_id", digest(F.col("body")).alias("digest"), "body")
    best = winners(rows, salts)
    key = ["digest"] if exact_digest else ["digest", "body"]
    if exact_digest:
        rows, best = rows.drop("body"), best.drop("body")
        sha = F.col("digest")
    else:
        sha = sha256_of(F.col("body"))
    flagged = rows.join(best, key).select("row_id", "keep_id", "group_size", F.col("row_id").eqNullSafe(F.col("keep_id")).alias("top"), sha.alias("text_sha256"))
    if _repeats(docs, id_col):
        flagged = _one_top(flagged)
    return flagged.select(F.col("row_id").alias(id_col), "keep_id", "group_size", F.col("top").alias("kept"), "text_sha256")


def _repeats(docs: DataFrame, id_col: str) -> bool:
    """Whether an id occurs twice (then ties between equal rows are broken)."""
    return not docs.groupBy(F.col(id_col).alias("row_id")).count().filter("count > 1").limit(1).isEmpty()


def _one_top(flagged: DataFrame) -> DataFrame:
    """Keep one of several top rows; ranked in spread parts, then over their firsts."""
    part = flagged.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(64)))
    first = F.row_number().over(Window.partitionBy("text_sha256", "row_id", "part").orderBy(F.lit(0)))
    part = part.withColumn("first", first == 1)
    again = F.row_number().over(Window.partitionBy("text_sha256", "row_id", "first", F.when(F.col("first"), F.lit(0)).otherwise(F.col("part"))).orderBy(F.lit(0)))
    return part.withColumn("top", F.col("top") & F.col("first") & (again == 1)).drop("part", "first")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """``docs`` without the rows that lose, all columns as they were.

    Null and empty texts are one text, of which one row stays; a null id loses
    to any other; of rows that repeat id and text one stays; texts of any
    length are compared whole; an empty table stays empty; extra columns pass
    through, whatever their names. The losers' (id, digest) list is written to the shared folder; up to
    ``BROADCAST_ROWS`` of them are broadcast, more are joined by a shuffle.
    """
    flags = exact_dedup(docs, id_col, text_col, salts)
    lost = settle(flags.filter(~F.col("kept")).select(F.col(id_col).alias("__lost_id"), F.col("text_sha256").alias("__lost_sha"), F.col(id_col).eqNullSafe(F.col("keep_id")).alias("__tied")), "exact-lost")
    n_lost, n_tied = lost.agg(F.count(F.lit(1)), F.count(F.when(F.col("__tied"), 1))).first()
    if not n_lost:
        return docs
    sha = sha256_of(fold_ascii(docs[text_col]))
    same = docs[id_col].eqNullSafe(F.col("__lost_id")) & (sha == F.col("__lost_sha"))
    gone = lost.filter(~F.col("__tied"))
    out = docs.join(F.broadcast(gone) if n_lost <= BROADCAST_ROWS else gone, same, "left_anti")
    if n_tied:  # rows that repeat id and text: one of them stays
        tied = lost.filter("__tied").select("__lost_id", "__lost_sha").distinct()
        once = out.join(tied, same, "left_semi")
        once = once.withColumn("__sha", sha256_of(fold_ascii(F.col(text_col)))).dropDuplicates([id_col, "__sha"]).drop("__sha")
        out = out.join(tied, same, "left_anti").unionByName(once)
    return out


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


QUERIES = {"op3_exact_dedup": op3_exact_dedup}
ORACLE_SQL = {
    "op3_exact_dedup": f"""
WITH folded AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS text_sha256 FROM documents
), best AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM folded GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM folded JOIN best USING (text_sha256)
"""
}
