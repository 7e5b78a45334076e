"""Profiles, duplicate payloads, samples and other statistics of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import numbered, settle

# --- fixed values: length buckets (name, largest length) ---
LENGTH_BUCKETS = (("000-099", 99), ("100-199", 199), ("200-399", 399), ("400-599", 599), ("600-1399", 1399), ("1400+", None))
_P = (0.5, 0.75, 0.9, 0.95, 0.99)


def length_bucket(n: Column) -> Column:
    out = F.lit(LENGTH_BUCKETS[-1][0])
    for name, most in reversed(LENGTH_BUCKETS[:-1]):
        out = F.when(n <= most, name).otherwise(out)
    return out


def length_summary(df: DataFrame, n: Column, *by: str) -> DataFrame:
    """min, exact interpolated p50..p99, max, mean (one digit) and the share present."""
    p = F.percentile(n, F.array(*map(F.lit, _P)))
    grouped = df.groupBy(*by) if by else df
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.when(n > 0, 1.0).otherwise(0.0)), 6).alias("present"), F.min(n).cast("long").alias("lo"), *(F.round(F.get(p, i), 1).alias(f"p{int(q * 100)}") for i, q in enumerate(_P)), F.max(n).cast("long").alias("hi"), F.round(F.avg(n), 1).alias("mean"))


def exact_quantiles(df: DataFrame, by: str, value: str, shares: tuple[float, ...]) -> DataFrame:
    """(by, q1, q2, ...): exact interpolated quantiles of a continuous value, nulls left out.

    Rows are numbered in the order (by, value) by a range partitioning, and
    only the one or two neighbours of each quantile are picked, so no task
    holds a group, however many distinct values it has.
    """
    rows = df.select(by, value).filter(F.col(value).isNotNull())
    placed = settle(numbered(rows, "nth", F.col(by), F.col(value)), "quantiles")
    spans = placed.groupBy(by).agg(F.min("nth").alias("start"), F.count(F.lit(1)).alias("n"))
    at = F.array(*(F.struct(F.lit(i).alias("i"), ((F.col("n") - 1) * share).alias("at")) for i, share in enumerate(shares)))
    targets = spans.select(by, "start", F.explode(at).alias("t")).select(by, "start", "t.*")
    sides = targets.select(by, "i", "at", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("k"), "start")
    found = sides.withColumn("nth", F.col("start") + F.col("k")).join(placed, [by, "nth"])
    whole = F.min(value) + (F.max(value) - F.min(value)) * (F.max("at") - F.floor(F.max("at")))
    each = found.groupBy(by, "i").agg(whole.alias("q"))
    return each.groupBy(by).agg(*(F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"q{i + 1}") for i in range(len(shares))))


def nearest_rank(n: Column, share: float) -> Column:
    """Value at the half-even rounded rank of a sorted group (for small groups)."""
    values = F.sort_array(F.collect_list(n))
    return F.get(values, F.bround((F.size(values) - 1) * F.lit(share)).cast("int"))


def metadata_shape(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: cardinality, empty rate, share of the top 1, 5 and 20 values, values seen once."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns)))
    counts = df.select(pairs.alias("x")).select("x.*").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy("field").agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("value") == "", F.col("n")).otherwise(0)).alias("empty"), F.count(F.when(F.col("value") != "", 1)).alias("cardinality"), F.count(F.when((F.col("value") != "") & (F.col("n") == 1), 1)).alias("singletons"))
    rank = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "value"))
    best = counts.filter("value <> ''").withColumn("r", rank).filter("r <= 20")  # a ranked limit: only the head is kept
    top = best.groupBy("field").agg(*(F.sum(F.when(F.col("r") <= k, F.col("n")).otherwise(0)).alias(f"t{k}") for k in (1, 5, 20)))
    full = total.join(top, "field", "left")
    return full.select("field", F.col("rows").cast("long").alias("rows"), "cardinality", "singletons", F.round(F.col("empty") / F.col("rows"), 6).alias("empty_rate"), *(F.round(F.coalesce(f"t{k}", F.lit(0)) / F.col("rows"), 6).alias(f"top{k}") for k in (1, 5, 20)))


def payload_reuse(df: DataFrame, payload: Column) -> DataFrame:
    """Rows, distinct payloads, rows beyond the first of each, their rate, groups, largest group."""
    groups = df.groupBy(F.sha2(payload, 256).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.sum("n").cast("long").alias("rows"), F.count(F.lit(1)).alias("distinct_payloads"), (F.sum("n") - F.count(F.lit(1))).cast("long").alias("beyond_first"), F.round((F.sum("n") - F.count(F.lit(1))) / F.sum("n"), 6).alias("rate"), F.count(F.when(F.col("n") > 1, 1)).alias("dup_groups"), F.max("n").cast("long").alias("largest"))


def head_drift(df: DataFrame, order: str, head: int, category: Column) -> DataFrame:
    """(category, head_n, all_n): the first ``head`` rows in input order against all."""
    first = df.orderBy(order).limit(head).select(F.lit(1).alias("h"), category.alias("category"))
    rows = df.select(F.lit(0).alias("h"), category.alias("category")).unionByName(first)
    return rows.groupBy("category").agg(F.sum("h").cast("long").alias("head_n"), F.sum(1 - F.col("h")).cast("long").alias("all_n"))


def hash_rank(seed: str, *ids: Column) -> Column:
    """A reproducible shuffle key."""
    return F.sha2(F.concat_ws("␟", F.lit(seed), *(c.cast("string") for c in ids)), 256)


def stratified(df: DataFrame, strata: list[str], size: int, rank: Column, ident: str) -> DataFrame:
    """``size`` rows by largest-remainder quotas over strata, hash-ranked inside each.

    Quotas come from the strata's counts (a small table); what is left after
    flooring goes to the largest fractions, then counts, then names.
    """
    counts = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    shares = counts.crossJoin(F.broadcast(total)).withColumn("exact", F.col("n") * size / F.col("total")).withColumn("quota", F.floor("exact"))
    left = shares.agg((F.lit(size) - F.sum("quota")).alias("left"))
    order = Window.orderBy(F.desc(F.round(F.col("exact") - F.col("quota"), 9)), F.desc("n"), *(F.desc(s) for s in strata))
    quotas = shares.withColumn("r", F.row_number().over(order)).crossJoin(F.broadcast(left)).select(*strata, (F.col("quota") + F.when(F.col("r") <= F.col("left"), 1).otherwise(0)).alias("quota"))
    ranked = df.withColumn("__rank", rank).withColumn("nth", F.row_number().over(Window.partitionBy(*strata).orderBy("__rank", ident))).filter(F.col("nth") <= size)  # a quota never exceeds the size
    return ranked.join(quotas, strata).filter(F.col("nth") <= F.col("quota")).drop("__rank")


def round_robin(df: DataFrame, ident: str, flags: Column, rank: Column, size: int) -> DataFrame:
    """Up to ``size`` rows, taking in turn the next unused row of each flag.

    A flag can skip at most ``size - 1`` rows that others took, so its first
    ``size`` rows suffice: that bounded head is finished on the driver.
    """
    rows = df.select(F.col(ident).alias("id"), F.explode(flags).alias("flag"), rank.alias("rk"))
    head = rows.withColumn("nth", F.row_number().over(Window.partitionBy("flag").orderBy("rk", "id"))).filter(F.col("nth") <= size)
    queues: dict[str, list] = {}
    for r in head.orderBy("flag", "nth").select("flag", "id").collect():
        queues.setdefault(r.flag, []).append(r.id)
    taken: dict = {}
    while len(taken) < size and any(queues.values()):
        for flag in sorted(queues):
            while queues[flag] and queues[flag][0] in taken:
                queues[flag].pop(0)
            if queues[flag] and len(taken) < size:
                taken[queues[flag].pop(0)] = flag
    kind = df.schema[ident].dataType.simpleString()
    return df.sparkSession.createDataFrame([(i, f, n) for n, (i, f) in enumerate(taken.items())], f"{ident} {kind}, flag string, nth int")


def latest(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """Last row of each key, by two partial maxima instead of a sort of every group."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(sequence)).alias("__r")).select(*keys, *(F.col("__r")[c].alias(c) for c in rest))


def top_per_group(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    return df.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("nth") <= k)


def content_window(text: Column, markers: tuple[str, ...], budget: int) -> Column:
    """Head (30 %), current part (40 %) and tail (30 %) of a text within ``budget`` characters.

    The current part lies around the last of the markers, a third of it before
    the marker, and wins where it meets the head or the tail. Short texts stay
    whole; without a marker the tail has the current part's budget too.
    """
    from caseloom.functions.text import rfind

    n_head, n_now = budget * 3 // 10, budget * 4 // 10
    n_tail = budget - n_head - n_now

    def windows(x: Column) -> Column:
        n = F.length(x)
        places = F.array(*(F.struct(rfind(x, m).alias("at"), F.lit(-k).alias("k"), F.lit(len(m)).alias("size")) for k, m in enumerate(markers)))
        part = lambda a, b: F.substring(x, a + 1, F.greatest(b - a, F.lit(0)))

        def around(mark: Column) -> Column:
            begin = F.greatest(F.lit(0), mark["at"] - n_now // 3)
            end = F.least(n, begin + n_now)
            end = F.when((mark["size"] <= n_now) & (mark["at"] + mark["size"] > end), F.least(n, mark["at"] + mark["size"])).otherwise(end)
            begin = F.greatest(F.lit(0), F.least(begin, end - n_now))
            whole = F.concat(part(F.lit(0), F.least(F.lit(n_head), begin)), part(begin, end), part(F.greatest(n - n_tail, end), n))
            edges = F.concat(F.substring(x, 1, n_head), part(n - (budget - n_head), n))
            return F.when(mark["at"] < 0, edges).otherwise(F.substring(whole, 1, budget))

        return F.when(n <= budget, x).otherwise(F.transform(F.array(F.array_max(places)), around)[0])

    return F.transform(F.array(text), windows)[0]
