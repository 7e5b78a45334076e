"""What several operators share inside Python workers."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from caseloom.session import settle

#: A key of fewer rows than this is never hot.
HOT_ROWS = 256
#: A key is hot above total / HOT_KEYS rows, so there are at most HOT_KEYS hot ones.
HOT_KEYS = 100_000
#: Up to so many rows in total the small side is broadcast as a whole.
FEW_ROWS = 10_000


def kept_in_process(key: Hashable, make: Callable[[], object]):
    """``make()`` once in this Python process, so that a worker's next task finds it warm.

    Functions travel by value and their module's variables with them, hence a
    place outside. What is kept must bound its own size.
    """
    store = vars(sys).setdefault("_caseloom_kept", {})
    if key not in store:
        store[key] = make()
    return store[key]


def join_hot(rows: DataFrame, small: DataFrame, key: str, total: int, label: str | None = None) -> DataFrame:
    """``rows`` joined to ``small``, which has one row a key of theirs and in column n the key's rows.

    Rows of hot keys stay where they are: the hot part of ``small`` has at most
    ``HOT_KEYS`` rows whatever the data, for each stands for more than
    ``total / HOT_KEYS`` of the ``total`` rows, and is broadcast. The rest is
    dealt by key. Of ``FEW_ROWS`` in total ``small`` is broadcast as a whole.
    Beyond, both are read several times: ``rows`` should be a written
    table, ``small`` is written if ``label`` is given.
    """
    if total <= FEW_ROWS:
        return rows.join(F.broadcast(small.drop("n")), key)
    small = settle(small, label) if label else small
    limit = max(HOT_ROWS, total // HOT_KEYS)
    hot, cold = small.filter(F.col("n") > limit).drop("n"), small.filter(F.col("n") <= limit).drop("n")
    if hot.isEmpty():
        return rows.join(cold, key)
    apart = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return rows.join(F.broadcast(hot), key).unionByName(apart)


def with_long_ids(rows: DataFrame, label: str) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` with column id as a long that is never null and in the order of the ids, nulls first.

    Whole numbers without nulls stay as they are. Other ids (strings, nulls)
    are numbered in their order: distinct values are range-partitioned and
    sorted, so that partition and position make the number; no task holds them
    all. The second value is then the table (number, value), else None.
    """
    if isinstance(rows.schema["id"].dataType, T.IntegralType) and not rows.filter(F.col("id").isNull()).count():
        return rows.withColumn("id", F.col("id").cast("long")), None
    order = F.col("value").asc_nulls_first()
    names = rows.select(F.col("id").alias("value")).distinct().repartitionByRange(order).sortWithinPartitions(order)
    names = settle(names.select(F.monotonically_increasing_id().alias("number"), "value"), label)
    out = rows.join(names, rows["id"].eqNullSafe(names["value"])).withColumn("id", F.col("number")).drop("number", "value")
    return out, names


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lower the session's rows in an Arrow batch, unless it is lower: texts can be long.

    Spark reads this setting when a plan runs, long after it was made, so it
    stays lowered for the session; it changes batch sizes, never results.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def rows_of(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples; only ``step`` rows are Python objects at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            yield from zip(*(c.to_pylist() for c in batch.slice(lo, step).columns), strict=True)


def batches_of(rows: Iterable[tuple], names: list[str], types: list[pa.DataType], heavy: int | None = None, limit: int = 4 << 20, most: int = 5000) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of bounded size; ``heavy`` is the position of the large value, if any."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += len(row[heavy]) if heavy is not None else 0
        if size > limit or len(out) >= most:
            yield _batch(out, names, types)
            out, size = [], 0
    if out:
        yield _batch(out, names, types)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(df.schema[column].dataType)
