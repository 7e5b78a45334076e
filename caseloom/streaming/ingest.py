"""Streaming front ends: record ingestion and diagnostics, on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions import text as tx
from caseloom.session import shared_dir


def redacted_stream(spark: SparkSession, path: str, schema: T.StructType, text_col: str, files_per_batch: int = 8) -> DataFrame:
    """JSON-lines files as they arrive, with ``text_col`` redacted and an identity hash."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)
    rows = tx.redact(rows, text_col)
    return rows.withColumn("content_hash", F.concat(F.lit("sha256:"), F.sha2(F.coalesce(text_col, F.lit("")), 256)))


def append_new(stream: DataFrame, keys: list[str], out: str, name: str):
    """Append rows whose identity the output lacks; safe to replay.

    Each micro-batch is de-duplicated, anti-joined with what is stored and
    written under its batch number, so a repeated batch overwrites itself.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates(keys)
        stored = _stored(spark, out, number, keys)
        if stored is not None:
            fresh = fresh.join(stored, keys, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{shared_dir(spark)}/{name}").trigger(availableNow=True).start()


def _stored(spark: SparkSession, out: str, number: int, keys: list[str]) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    rows = spark.read.parquet(out)
    return rows.filter(F.col("batch") != number).select(*keys)


def windowed_counts(events: DataFrame, time_col: str, key: str, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums in tumbling windows; state is dropped behind the watermark."""
    return events.withWatermark(time_col, late).groupBy(F.window(time_col, width), key).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
