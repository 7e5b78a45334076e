"""Session helpers shared by every subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables, read by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only where nothing is
    set in a local session (tests) is a temporary one chosen, once a session;
    elsewhere that is an error, for executors would each write to a disk of
    their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder (master {master})")
        named = "file://" + tempfile.mkdtemp(prefix="caseloom-shared-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir() or named
    return named.rstrip("/")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts lineage: what follows reads the written files, which outlive any
    executor, and Spark knows their true size when it plans joins.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def values(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """A configuration-sized table from literals, without a Python source."""
    if not rows:
        raise ValueError("no rows")
    structs = [F.struct(*(F.lit(v).alias(n) for v, n in zip(row, names, strict=True))) for row in rows]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("v")).select(*(F.col(f"v.{n}").alias(n) for n in names))


def numbered(df: DataFrame, name: str, *order: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with its rows numbered from 1 in a total order (for each value of ``by``), without a sort in one task.

    Rows are range-partitioned and sorted; a row's number is its place among
    the rows of its value in its partition plus their number in the partitions
    before. There are at most as many such counts as partitions and values, a
    side that may be broadcast.
    """
    spread = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    placed = settle(spread.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", 33)
    keys = [F.col(c).alias(f"__by{i}") for i, c in enumerate(by)]
    sizes = placed.groupBy(part.alias("__size_part"), *keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    same = [f"__by{i}" for i in range(len(by))]
    before = F.sum("__n").over(Window.partitionBy(*same).orderBy("__size_part")) - F.col("__n")
    starts = sizes.select("__size_part", *same, (before - F.col("__first")).alias("__shift"))
    match = part == F.col("__size_part")
    for c, b in zip(by, same):
        match = match & placed[c].eqNullSafe(F.col(b))
    return placed.join(F.broadcast(starts), match).select(*df.columns, (F.col("__at") + F.col("__shift") + 1).alias(name))
