"""Lexical (BM25) and vector retrieval, single queries and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.text import tokens
from caseloom.session import settle

K1, B = 1.5, 0.75


def postings(docs: DataFrame, id_col: str, text: Column) -> DataFrame:
    """(doc_id, token, tf): combined map-side before the shuffle."""
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(tokens(text)).alias("token")).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("tf"))


#: Query tokens up to which their weights are broadcast; beyond that the join shuffles.
BROADCAST_ROWS = 1_000_000

#: Rows of (query, document, token) that one task makes, counted before the hits are dealt.
TASK_ROWS = 2_000_000


def bm25(docs: DataFrame, id_col: str, text: Column, queries: DataFrame, keep: Column | None = None, k1: float = K1, b: float = B) -> DataFrame:
    """(query_id, doc_id, score) for ``queries`` (query_id, query).

    The corpus is tokenised once: what is written is a row a document and one
    for each of its tokens that some query has. Length, document frequencies
    and scores come from that table. Scoring deals its rows by document, and
    a document's (query, document) rows are summed where they arise, so pairs
    are not shuffled; the number of tasks follows from the number of these rows; ``top_k`` by query then sends k rows a task and query.
    Statistics cover the whole corpus; ``keep`` only decides which documents
    are returned. Query tokens count once.
    """
    asked = settle(queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("token")), "bm25-asked")
    bounded = asked.count() <= BROADCAST_ROWS
    small = F.broadcast if bounded else lambda df: df
    vocabulary = asked.select("token", F.col("token").alias("known")).distinct()
    sized = docs.select(F.col(id_col).alias("doc_id"), (keep if keep is not None else F.lit(True)).alias("keep"), tokens(text).alias("toks"))
    each = sized.select("doc_id", "keep", F.size("toks").alias("dl"), F.explode(F.concat("toks", F.array(F.lit(None).cast("string")))).alias("token"))
    hits = each.join(small(vocabulary), "token", "left").groupBy("doc_id", "keep", "dl", F.col("known").alias("token")).agg(F.count(F.lit(1)).alias("tf"))
    hits = settle(hits, "bm25-postings")
    stats = hits.filter("token IS NULL").agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"))
    tf = hits.filter("token IS NOT NULL")
    df = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = asked.join(df, "token").crossJoin(F.broadcast(stats)).select("query_id", "token", "avgdl", idf.alias("idf"))  # stats are one row
    part = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    made = tf.filter("keep").groupBy("token").agg(F.count(F.lit(1)).alias("n")).join(asked.groupBy("token").agg(F.count(F.lit(1)).alias("q")), "token").agg(F.sum(F.col("n") * F.col("q"))).first()[0] or 0
    rows = tf.filter("keep").repartition(max(1, -(-made // TASK_ROWS)), "doc_id").join(small(weights), "token")
    return rows.groupBy("query_id", "doc_id").agg(F.round(F.sum(part), 6).alias("score"))


def top_k(scored: DataFrame, k: int, *by: str) -> DataFrame:
    """Best k: a limit over all rows, or k for each value of ``by``; ties by doc_id."""
    order = [F.desc("score"), F.asc("doc_id")]
    if not by:
        return scored.orderBy(*order).limit(k)
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def dot(a: Column, b: Column) -> Column:
    """Dot product in doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    """Euclidean length, 1 for a zero vector."""
    n = F.sqrt(dot(a, a))
    return F.when(n == 0, 1.0).otherwise(n)


def cosine(vectors: DataFrame, id_col: str, vec_col: str, query: list[float], keep: Column | None = None) -> DataFrame:
    """(doc_id, score) against one query vector, filtered before any cut."""
    q = F.array(*map(F.lit, map(float, query)))
    rows = vectors.filter(keep) if keep is not None else vectors
    score = dot(F.col(vec_col), q) / (norm(F.col(vec_col)) * norm(q))
    return rows.select(F.col(id_col).alias("doc_id"), F.round(score, 6).alias("score"), *(c for c in rows.columns if c not in (id_col, vec_col)))
