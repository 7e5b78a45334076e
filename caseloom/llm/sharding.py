"""Sharding by a k-d tree over document metadata, in DataFrame operations only.

A group of equal texts is one point; its coordinates are metadata (log-scaled
numbers, hashed categories) in 0..1023 and its weight is its bytes. The tree
splits the leaves' range in two, level by level, at the exact distributed
weighted median along the dimension in which the node is widest. Medians come
from three small histograms a level (coordinate, then two digits of a 24-bit
tie-break hash), summed map-side; the driver sees bins, never points.

Skew: groups above 1/32 of a leaf are few by arithmetic (at most 32 a leaf).
They are placed first, largest first, on the emptiest leaf, and the medians
then aim at what room each leaf has left. A group above a whole leaf is cut
into parts by id, so no group has to fit in one shard.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.session import settle, table

LAW = "bytes"
N_SHARDS = 16
DIMS = ("lang", "source", "n_chars")
#: A leaf's target over this is what makes a group heavy.
HEAVY = 32
#: Rows numbered in one task when slots are dealt.
RUN_ROWS = 1024
_BINS, _DIGIT = 1024, 4096
_TIE = _DIGIT * _DIGIT


def _coordinate(docs: DataFrame, name: str) -> Column:
    """A column as a whole number in 0..1023; null is 0."""
    kind = docs.schema[name].dataType
    if isinstance(kind, T.NumericType):
        value = F.least(F.lit(float(_BINS - 1)), F.floor(F.log2(F.greatest(F.lit(0.0), docs[name].cast("double")) + 1) * 32))
        return F.coalesce(value, F.lit(0)).cast("int")
    return F.when(docs[name].isNull(), 0).otherwise(F.pmod(F.xxhash64(docs[name].cast("string")), F.lit(_BINS))).cast("int")


def _place_heavy(items: list[tuple], n: int) -> tuple[list[float], dict]:
    """Largest first onto the emptiest of n leaves: loads, item key -> leaf."""
    heap = [(0, leaf) for leaf in range(n)]
    loads, at = [0.0] * n, {}
    for size, key in sorted(items, reverse=True):
        _, leaf = heapq.heappop(heap)
        at[key], loads[leaf] = leaf, loads[leaf] + size
        heapq.heappush(heap, (loads[leaf], leaf))
    return loads, at


def _crossing(bins: dict[int, int], want: float) -> tuple[int, float]:
    """First bin at which the running weight reaches ``want``, and the weight before it."""
    before = 0.0
    for b in sorted(bins):
        if before + bins[b] >= want:
            return b, before
        before += bins[b]
    return (max(bins) + 1 if bins else 0), before


def _descend(n_dims: int, wide: dict[int, int], cut: dict[int, int], levels: int) -> Column:
    """Node that a point reaches from the root; node k has children 2k+1 and 2k+2.

    One fold over the levels with the tree in literal arrays, so that the
    expression stays small whatever the number of shards.
    """
    if not levels:
        return F.lit(0)
    size = max(cut) + 1
    dim_of = F.array(*(F.lit(wide.get(k, 0)) for k in range(size)))
    cut_of = F.array(*(F.lit(cut.get(k)).cast("long") for k in range(size)))
    at = F.array(*(F.col(f"d{i}").cast("long") for i in range(n_dims)))

    def step(node: Column, _: Column) -> Column:
        left = F.get(at, F.get(dim_of, node)) * _TIE + F.col("tie") < F.get(cut_of, node)
        return F.when(F.get(cut_of, node).isNull(), node).otherwise(node * 2 + F.when(left, 1).otherwise(2))

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(0), step)


def _tree(points: DataFrame, n_dims: int, rooms: list[float]) -> DataFrame:
    """``points`` (d0.., tie, weight) with column shard; leaf i gets a share as ``rooms[i]``."""
    nodes, leaf_of, levels = {0: (0, len(rooms))}, {}, 0  # node -> range of leaves
    all_wide: dict[int, int] = {}
    all_cuts: dict[int, int] = {}
    while True:
        leaf_of |= {k: lo for k, (lo, hi) in nodes.items() if hi - lo == 1}
        nodes = {k: (lo, hi) for k, (lo, hi) in nodes.items() if hi - lo > 1}
        here = points.withColumn("node", _descend(n_dims, all_wide, all_cuts, levels))
        if not nodes:
            break
        hist: dict = {k: [{} for _ in range(n_dims)] for k in nodes}
        dims = F.explode(F.array(*(F.struct(F.lit(i).alias("dim"), F.col(f"d{i}").alias("bin")) for i in range(n_dims))))
        for r in here.select("node", "weight", dims.alias("x")).groupBy("node", "x.dim", "x.bin").agg(F.sum("weight").alias("w")).collect():
            if r.node in hist:
                hist[r.node][r.dim][r.bin] = int(r.w)
        want, tie, bin_of = {}, dict.fromkeys(nodes, 0), {}
        for k, (lo, hi) in nodes.items():
            wide = all_wide[k] = max(range(n_dims), key=lambda i: (max(hist[k][i]) - min(hist[k][i]) if hist[k][i] else -1, -i))
            mid = (lo + hi) // 2
            room, left = sum(rooms[lo:hi]), sum(rooms[lo:mid])
            goal = sum(hist[k][wide].values()) * (left / room if room else (mid - lo) / (hi - lo))
            bin_of[k], before = _crossing(hist[k][wide], goal)
            want[k] = goal - before
        size = max(nodes) + 1
        dim_of, edge_of = (F.array(*(F.lit(x.get(k, -1)) for k in range(size))) for x in (all_wide, bin_of))
        at = F.array(*(F.col(f"d{i}") for i in range(n_dims)))
        edge = here.select("node", "tie", "weight", F.get(at, F.get(dim_of, F.col("node"))).alias("bin"), F.get(edge_of, F.col("node")).alias("edge")).filter(F.col("bin") == F.col("edge"))
        for last in (False, True):
            digit = F.pmod(F.col("tie"), F.lit(_DIGIT)) if last else F.floor(F.col("tie") / _DIGIT)
            bins: dict = {k: {} for k in nodes}
            for r in edge.groupBy("node", digit.cast("int").alias("bin")).agg(F.sum("weight").alias("w")).collect():
                bins[r.node][r.bin] = int(r.w)
            for k in nodes:
                b, before = _crossing(bins[k], want[k])
                tie[k], want[k] = tie[k] * _DIGIT + b, want[k] - before
            high = F.array(*(F.lit(tie.get(k, -1)) for k in range(size)))
            edge = edge.filter(F.floor(F.col("tie") / _DIGIT) == F.get(high, F.col("node")))
        children = {}
        for k, (lo, hi) in nodes.items():
            all_cuts[k] = bin_of[k] * _TIE + tie[k]
            children |= {2 * k + 1: (lo, (lo + hi) // 2), 2 * k + 2: ((lo + hi) // 2, hi)}
        nodes, levels = children, levels + 1
    leaf = F.array(*(F.lit(leaf_of.get(k, 0)) for k in range(max(leaf_of) + 1)))
    return here.withColumn("shard", F.get(leaf, F.col("node")).cast("int"))


def _placed(docs: DataFrame, n_shards: int | None, id_col: str, text_col: str, dims: tuple[str, ...], target_bytes: int | None) -> tuple[DataFrame, int, int]:
    """(row_id, size, crc, group, shard) of every row, the number of rows and that of shards.

    ``group`` is the text's SHA-256; rows with equal id and text have one shard.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    dims = tuple(d for d in dims if d in docs.columns)
    meta = docs.select(
        docs[id_col].alias("row_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.unhex(F.sha2(text, 256)).alias("group"),
        *(_coordinate(docs, d).alias(f"d{i}") for i, d in enumerate(dims)),
        *([F.lit(0).alias("d0")] if not dims else []),
    )
    n_dims = max(1, len(dims))
    meta = settle(meta, "shard-meta")
    points = meta.groupBy("group").agg(F.sum("size").alias("weight"), *(F.min(f"d{i}").alias(f"d{i}") for i in range(n_dims))).withColumn("tie", F.pmod(F.xxhash64("group"), F.lit(_TIE)))
    points = settle(points, "shard-points")
    total = points.agg(F.sum("weight")).first()[0] or 0
    n_shards = n_shards or max(1, math.ceil(total / target_bytes))
    target = total / n_shards

    # At most HEAVY * n_shards groups can be above target / HEAVY.
    heavy = {bytes(r.group): r.weight for r in points.filter(F.col("weight") > target / HEAVY).collect()}
    parts = {g: math.ceil(w / (target / HEAVY)) if w > target else 1 for g, w in heavy.items()}
    spark = docs.sparkSession
    part_of = F.pmod(F.xxhash64("row_id", F.lit(7)), F.col("parts")).cast("int")
    items = [(w, (g, 0)) for g, w in heavy.items() if parts[g] == 1]
    cut = [(bytearray(g), p) for g, p in parts.items() if p > 1]
    if cut:
        cut_df = F.broadcast(spark.createDataFrame(cut, "group binary, parts int"))
        items += [(r.w, (bytes(r.group), r.part)) for r in meta.join(cut_df, "group").groupBy("group", part_of.alias("part")).agg(F.sum("size").alias("w")).collect()]
    loads, at = _place_heavy(items, n_shards)
    light = _tree(points.filter(F.col("weight") <= target / HEAVY), n_dims, [max(0.0, target - x) for x in loads]).select("group", "shard")
    rows = meta.select("row_id", "size", "crc", "group")
    if heavy:
        where = [(bytearray(g), p, [at.get((g, i), 0) for i in range(p)]) for g, p in parts.items()]
        where_df = F.broadcast(spark.createDataFrame(where, "group binary, parts int, leaves array<int>"))
        placed = rows.join(where_df, "group").select("row_id", "size", "crc", "group", F.element_at("leaves", part_of + 1).alias("shard"))
        rest = rows.join(where_df.select("group"), "group", "left_anti").join(light, "group").select("row_id", "size", "crc", "group", "shard")
        placed = placed.unionByName(rest)
    else:
        placed = rows.join(light, "group").select("row_id", "size", "crc", "group", "shard")
    return placed, _count(meta), n_shards


def kd_shards(docs: DataFrame, n_shards: int | None = N_SHARDS, id_col: str = "doc_id", text_col: str = "text", dims: tuple[str, ...] = DIMS, target_bytes: int | None = None) -> DataFrame:
    """Shard and slot of every row: id, size, text_crc32, shard, slot.

    The tree has ``n_shards`` leaves, or with None as many as bring a leaf to
    ``target_bytes`` or less on average. Size is the text's UTF-8 bytes plus 1;
    a null text counts as empty. Equal texts share a shard unless their group
    is larger than a shard. Repeated rows all get a slot of their own; null
    ids and metadata are ordinary values; metadata columns that are missing
    are left out; an empty table gives no rows; one very long text may fill a
    shard alone. Only the named columns are read.
    """
    placed, n_rows, n_shards = _placed(docs, n_shards, id_col, text_col, dims, target_bytes)
    runs = max(1, math.ceil(n_rows / (n_shards * RUN_ROWS)))
    placed = settle(placed.drop("group").withColumn("run", F.pmod(F.xxhash64("row_id", "crc", F.monotonically_increasing_id()), F.lit(runs))), "shard-placed")
    starts = placed.groupBy("shard", "run").count()
    starts = starts.select("shard", "run", (F.sum("count").over(Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("count")).alias("start"))
    numbered = placed.withColumn("nth", F.row_number().over(Window.partitionBy("shard", "run").orderBy("row_id", "crc")))
    out = numbered.join(starts, ["shard", "run"])
    return out.select(F.col("row_id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("start") + F.col("nth") - 1).cast("long").alias("slot"))


def _count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def write_shards(docs: DataFrame, path: str, n_shards: int | None = N_SHARDS, id_col: str = "doc_id", text_col: str = "text", dims: tuple[str, ...] = DIMS, target_bytes: int | None = None) -> None:
    """Write every row of ``docs`` under ``path/shard=<k>/``, each row once.

    Rows find their shard by id and SHA-256 of the text, so null ids, repeated
    rows and equal check sums change nothing. ``docs`` must have no column
    shard; other extra columns are written along. An empty table writes no
    files of rows.
    """
    placed, _, _ = _placed(docs, n_shards, id_col, text_col, dims, target_bytes)
    placed = settle(placed.select(F.col("row_id").alias("__id"), F.col("group").alias("__group"), "shard").distinct(), "shard-rows")
    group = F.unhex(F.sha2(F.coalesce(docs[text_col], F.lit("")), 256))
    docs.join(placed, docs[id_col].eqNullSafe(placed["__id"]) & (group == placed["__group"])).drop("__id", "__group").write.partitionBy("shard").parquet(path)


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kd_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op5_kd_shards": op5_kd_shards}
ORACLE_SQL: dict[str, str] = {}
