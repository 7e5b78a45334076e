"""A store of embedding vectors with the columns shown beside results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.retrieval import dot, norm
from caseloom.sources.records import publish

SIDECAR = ("doc_id", "display_text", "embedding_text", "case_content_clean", "metadata")


def embed(docs: DataFrame, encode, text: Column, out: str = "vector") -> DataFrame:
    """``docs`` with vectors; ``encode(frame)`` is a DataFrame function that turns column _text into ``vector``.

    A model runs behind ``mapInPandas`` there, one load a worker; tests use a
    deterministic column expression.
    """
    return encode(docs.withColumn("_text", text)).drop("_text").withColumnRenamed("vector", out)


def write_vectors(rows: DataFrame, path: str, vector: str = "vector") -> None:
    """Publish vectors as floats with their norm and the sidecar columns that ``rows`` has."""
    kept = [c for c in SIDECAR if c in rows.columns]
    v = F.col(vector).cast("array<float>")
    publish(rows.sparkSession, path, rows.select(*kept, v.alias("vector"), norm(v).alias("norm")).write.parquet)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    """A written store; an error if vectors are missing or differ in length."""
    rows = spark.read.parquet(path)
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count("vector").alias("have"), F.min(F.size("vector")).alias("low"), F.max(F.size("vector")).alias("high")).first()
    if sizes.n != sizes.have or sizes.low != sizes.high:
        raise ValueError("vector_index_mismatch")
    return rows


def search(rows: DataFrame, query: list[float], k: int) -> DataFrame:
    """The ``k`` rows of largest cosine, by stored norms; ties by doc_id."""
    q = F.array(*map(F.lit, map(float, query)))
    score = F.round(dot(F.col("vector"), q) / (F.col("norm") * norm(q)), 6)
    return rows.withColumn("score", score).orderBy(F.desc("score"), "doc_id").limit(k).drop("vector", "norm")
