"""Set-based and ranked evaluation: precision/recall, agreement, ledgers, IR metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import numbered, settle, values


#: Rows of members that one task deals with.
TASK_ROWS = 300_000


def tasks_for(*sides: DataFrame) -> int:
    """As many tasks as the rows of all sides ask for, which are counted."""
    return max(sides[0].sparkSession.sparkContext.defaultParallelism, sum(rows.count() for rows in sides) // TASK_ROWS + 1)


def ratio(a: Column, b: Column) -> Column:
    """a / b to four digits, 0 where b is 0."""
    return F.when(b > 0, F.round(a / b, 4)).otherwise(0.0)


def prf(gold: DataFrame, predicted: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """tp, fp, fn, precision, recall, f1 of two sets of ``keys``, for each value of ``by``."""
    a = gold.select(*by, *keys).distinct().withColumn("g", F.lit(1))
    b = predicted.select(*by, *keys).distinct().withColumn("p", F.lit(1))
    both = a.join(b, [*by, *keys], "full_outer")
    count = lambda cond: F.count(F.when(cond, 1))
    rows = both.groupBy(*by).agg(count(F.col("g").isNotNull() & F.col("p").isNotNull()).alias("tp"), count(F.col("g").isNull()).alias("fp"), count(F.col("p").isNull()).alias("fn"))
    return with_prf(rows)


def with_prf(rows: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return rows.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)})


def pairs_within(members: DataFrame, group: str, member: str) -> DataFrame:
    """Unordered pairs of distinct members of one hyperedge; groups are small by contract (an issue, an order)."""
    sets = members.groupBy(group).agg(F.array_sort(F.collect_set(member)).alias("m"))
    index = F.posexplode("m").alias("i", "lo")
    rows = sets.select(group, "m", index)
    return rows.select(group, "lo", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("hi"))


def pair_prf(gold: DataFrame, predicted: DataFrame, group: str, member: str) -> DataFrame:
    """One row of tp, fp, fn and scores of the pairs that ``pairs_within`` would make of both sides, without making them.

    Pairs of a group are all pairs of its members, so their numbers follow from
    the numbers of members of each side and of both. Both sides are dealt by
    group once, to as many tasks as their rows ask for; a null member or group
    is in no pair.
    """
    side = lambda rows, mine: rows.select(F.col(group).alias("__g"), F.col(member).alias("m"), F.lit(mine).alias("g"), F.lit(not mine).alias("p"))
    rows = side(gold, True).unionByName(side(predicted, False)).filter("__g IS NOT NULL AND m IS NOT NULL").repartition(tasks_for(gold, predicted), "__g")
    sets = rows.groupBy("__g", "m").agg(F.max("g").alias("g"), F.max("p").alias("p"))
    n = lambda cond: F.count(F.when(cond, 1))
    sizes = sets.groupBy("__g").agg(n(F.col("g")).alias("g"), n(F.col("p")).alias("p"), n(F.col("g") & F.col("p")).alias("b"))
    pairs = lambda c: F.floor(F.col(c) * (F.col(c) - 1) / 2)
    return sizes.select(pairs("g").alias("g"), pairs("p").alias("p"), pairs("b").alias("tp")).agg(F.sum("tp").alias("tp"), F.sum(F.col("p") - F.col("tp")).alias("fp"), F.sum(F.col("g") - F.col("tp")).alias("fn")).filter("tp + fp + fn > 0").transform(with_prf)


def dice(a: Column, b: Column) -> Column:
    """Dice coefficient of two arrays as sets, 1 for two empty ones."""
    a, b = F.array_distinct(a), F.array_distinct(b)
    n = F.size(a) + F.size(b)
    return F.when(n == 0, 1.0).otherwise(F.round(F.size(F.array_intersect(a, b)) * 2 / n, 4))


def transitions(raw: Column, final: Column, gold: Column) -> dict[str, Column]:
    """kept/removed/added times correct/incorrect, as set sizes."""
    kept, gone, new = F.array_intersect(raw, final), F.array_except(raw, final), F.array_except(final, raw)
    out = {}
    for name, part in (("kept", kept), ("removed", gone), ("added", new)):
        out[f"{name}_correct"] = F.size(F.array_intersect(part, gold)).cast("long")
        out[f"{name}_incorrect"] = F.size(F.array_except(part, gold)).cast("long")
    return out


def ir_metrics(ranked: DataFrame, qrels: DataFrame, k: int) -> DataFrame:
    """P@K (over K), R@K, nDCG@K (2^grade - 1), reciprocal rank for each query.

    ``ranked`` has query_id, doc_id, rank; ``qrels`` query_id, doc_id, grade.
    Queries with relevant documents all appear; recall is null without any.
    """
    gain = lambda g: F.pow(F.lit(2.0), g) - 1
    got = ranked.filter(F.col("rank") <= k).join(qrels, ["query_id", "doc_id"])
    found = got.groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"), F.sum(gain(F.col("grade")) / F.log2(F.col("rank") + 1.0)).alias("dcg"), F.min("rank").alias("first"))
    best = qrels.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("grade"), "doc_id"))).filter(F.col("r") <= k)
    top = best.groupBy("query_id").agg(F.sum(gain(F.col("grade")) / F.log2(F.col("r") + 1.0)).alias("idcg"))
    ideal = qrels.groupBy("query_id").agg(F.count(F.lit(1)).alias("relevant")).join(top, "query_id")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    rows = ideal.join(found, "query_id", "left")
    return rows.select("query_id", F.round(zero("hits") / k, 4).alias("p_at_k"), F.round(zero("hits") / F.col("relevant"), 4).alias("r_at_k"), F.round(F.when(F.col("idcg") > 0, zero("dcg") / F.col("idcg")), 4).alias("ndcg"), F.round(F.coalesce(1.0 / F.col("first"), F.lit(0.0)), 4).alias("mrr"))


def weak_metrics(ranked: DataFrame, gold: DataFrame, k: int) -> DataFrame:
    """One row: P@K over the rows returned and R@K over the weak gold."""
    head = ranked.filter(F.col("rank") <= k).select("doc_id")
    hit = head.join(gold.select("doc_id").distinct().withColumn("g", F.lit(1)), "doc_id", "left").agg(F.count(F.lit(1)).alias("returned"), F.count("g").alias("hits"))
    total = gold.select("doc_id").distinct().agg(F.count(F.lit(1)).alias("gold"))
    return hit.crossJoin(F.broadcast(total)).select("returned", "hits", "gold", F.round(F.when(F.col("returned") > 0, F.col("hits") / F.col("returned")).otherwise(0.0), 6).alias("p_at_k"), F.round(F.when(F.col("gold") > 0, F.col("hits") / F.col("gold")).otherwise(0.0), 6).alias("r_at_k"))


SEED, HOP = "seed_entity", "one_hop_expansion"


#: Groups that one column of bits can hold.
BITS = 62
#: Queries that one pass scores; each has columns of its own.
PASS_QUERIES = 8
#: Wanted entities up to which they are broadcast; beyond that the join shuffles.
WANTED_ROWS = 200_000
#: Expanded documents a query up to which each task sends only its best.
BEST_ROWS = 1000


def oracle_documents(members: DataFrame, specs: DataFrame, queries: DataFrame, named: bool = True) -> DataFrame:
    """The rows of ``oracle_query`` without their ranks, and unless ``named`` without ``matched_entities``; ``specs`` and ``queries`` are configuration-sized."""
    asked = queries.select("query_id", F.when(F.upper("operator") == "OR", F.lit(1)).otherwise(F.col("n_groups")).alias("need"), "frontier").collect()
    tasks = tasks_for(members)
    out = None
    for i in range(0, max(1, len(asked)), PASS_QUERIES):
        part = _oracle_pass(members, specs, asked[i : i + PASS_QUERIES], queries.schema["query_id"].dataType, tasks, named)
        out = part if out is None else out.unionByName(part)
    return out


def _oracle_pass(members: DataFrame, specs: DataFrame, asked: list, id_type, tasks: int, named: bool) -> DataFrame:
    """Documents of a few queries.

    An event belongs to one document, so members are dealt by document, once to
    find the entities at the frontier and once to score. What a member means to
    each query is known before it is dealt: seed groups as bits, and for the
    seed and the hop one bit a query. Each query has its own columns, so no row
    is repeated for it until documents are made, and members that no query
    wants are not dealt. Only if ``named`` are lists made.
    """
    entity, where = ["entity_type", "value"], ["doc_id", "event_id"]
    number = {r["query_id"]: i for i, r in enumerate(asked)}
    hops = [i for i, r in enumerate(asked) if r["frontier"]]
    nth = F.dense_rank().over(Window.partitionBy("query_id").orderBy("group")) - 1
    specs = specs.filter(F.col("query_id").isin(*number)) if number else specs.limit(0)
    marked = specs.filter("group IS NOT NULL").withColumn("nth", nth).unionByName(specs.filter("group IS NULL").withColumn("nth", F.lit(None).cast("int")))
    most = marked.agg(F.max("nth")).first()[0] or 0
    words, zero = range(most // BITS + 1), F.lit(0).cast("long")
    bit = lambda w: F.when(F.floor(F.col("nth") / BITS) == w, F.expr(f"shiftleft(1L, nth % {BITS})")).otherwise(zero)
    mine = lambda q: F.col("query_id") == F.lit(q)
    flag = lambda i: F.lit(1 << i).cast("long")
    has = lambda c, i: F.col(c).bitwiseAND(flag(i)) != 0
    group = lambda i, w: f"g{i}_{w}"
    groups = [F.bit_or(F.when(mine(q), bit(w)).otherwise(zero)).alias(group(i, w)) for q, i in number.items() for w in words]
    hit = sum((F.bit_or(F.when(mine(q), flag(i)).otherwise(zero)) for q, i in number.items()), zero)
    seeded = marked.groupBy(*entity).agg(hit.alias("hit"), *groups)
    got = lambda i, bits: sum((F.bit_count(bits(group(i, w))) for w in words), F.lit(0))

    near = None
    if hops:
        kinds: dict[str, int] = {}
        for i in hops:
            for kind in asked[i]["frontier"]:
                kinds[kind] = kinds.get(kind, 0) | 1 << i
        types = values(members.sparkSession, list(kinds.items()), "entity_type", "near").withColumn("near", F.col("near").cast("long"))
        rows = members.join(F.broadcast(seeded), entity, "left").join(F.broadcast(types), "entity_type", "left").filter("hit IS NOT NULL OR near IS NOT NULL")
        some = ["hit", "near", *(group(i, w) for i in hops for w in words)]
        rows = rows.select(*where, *entity, *(F.coalesce(c, zero).alias(c) for c in some)).repartition(tasks, "doc_id")
        event = Window.partitionBy(*where)
        bits = rows.select(*entity, "near", F.bit_or("hit").over(event).alias("__hit"), *(F.bit_or(group(i, w)).over(event).alias(group(i, w)) for i in hops for w in words))
        seen = sum((F.when(has("__hit", i) & has("near", i) & (got(i, F.col) >= asked[i]["need"]), flag(i)).otherwise(zero) for i in hops), zero)
        near = bits.select(*entity, seen.alias("near")).filter("near <> 0").groupBy(*entity).agg(F.bit_or("near").alias("near"))
    wanted = seeded.join(near, entity, "full_outer") if hops else seeded.withColumn("near", zero)
    masks = ["hit", "near", *(group(i, w) for i in number.values() for w in words)]
    wanted = wanted.select(*entity, *(F.coalesce(c, zero).alias(c) for c in masks))
    if hops:
        wanted = settle(wanted, "oracle-wanted")
    small = F.broadcast if not hops or wanted.count() <= WANTED_ROWS else lambda df: df
    rows = members.join(small(wanted), entity).select(*where, *entity, *masks).repartition(tasks, "doc_id").distinct()

    count = lambda cond, out: F.count(F.when(cond, 1)).alias(out)
    sums = [x for i in number.values() for x in (*(F.bit_or(group(i, w)).alias(group(i, w)) for w in words), count(has("hit", i), f"s{i}"), *([count(has("near", i), f"n{i}")] if i in hops else []))]
    lists = [F.collect_list(F.struct(F.concat_ws(":", *entity).alias("name"), "hit", "near")).alias("names")] if named else []
    events = rows.groupBy(*where).agg(*sums, *lists)
    seed = lambda i: (F.col(f"s{i}") > 0) & (got(i, F.col) >= asked[i]["need"])
    events = events.select("doc_id", *(["names"] if named else []), *(F.col(f"n{i}") for i in hops), *(F.col(f"s{i}") for i in number.values()), *(seed(i).alias(f"seed{i}") for i in number.values()))

    def of_query(i: int) -> list[Column]:
        is_seed, near_ = F.col(f"seed{i}"), F.col(f"n{i}") if i in hops else zero
        is_hop = ~is_seed & (near_ > 0)
        out = [count(is_seed, f"seeds{i}"), count(is_hop, f"hops{i}"), F.max(F.when(is_seed, F.col(f"s{i}") * 10.0).when(is_hop, near_ * 3.0 - 5.0)).alias(f"score{i}")]
        if not named:
            return out
        names = F.filter("names", lambda x: F.when(is_seed, x["hit"].bitwiseAND(flag(i)) != 0).otherwise(x["near"].bitwiseAND(flag(i)) != 0))
        return [*out, F.collect_list(F.when(is_seed | is_hop, F.transform(names, lambda x: x["name"]))).alias(f"names{i}")]

    docs = events.groupBy("doc_id").agg(*(c for i in number.values() for c in of_query(i)))
    rows = [
        F.when(F.col(f"seeds{i}") + F.col(f"hops{i}") > 0, F.struct(F.lit(q).cast(id_type).alias("query_id"), F.when(F.col(f"seeds{i}") > 0, SEED).otherwise(HOP).alias("match_stage"), F.col(f"score{i}").alias("score"), F.col(f"seeds{i}").alias("seed_events"), F.col(f"hops{i}").alias("expanded_events"), *([F.col(f"names{i}").alias("names")] if named else [])))
        for q, i in number.items()
    ]
    docs = docs.select("doc_id", F.explode(F.array(*rows)).alias("q")).filter("q IS NOT NULL")
    return docs.select("q.query_id", "doc_id", "q.match_stage", "q.score", "q.seed_events", "q.expanded_events", *([F.array_sort(F.array_distinct(F.flatten("q.names"))).alias("matched_entities")] if named else []))


def best_expanded(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """Seeds, and of each query's expanded documents the best ``max_expanded`` by score, then id."""
    seeds, hops = docs.filter(F.col("match_stage") == SEED), docs.filter(F.col("match_stage") == HOP)
    order = [F.desc("score"), F.asc("doc_id")]
    most = queries.agg(F.max("max_expanded")).first()[0] or 0
    if most <= BEST_ROWS:
        nth = hops.withColumn("nth", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("nth") <= most)
    else:
        nth = numbered(hops, "nth", *order, by=("query_id",))
    kept = nth.join(F.broadcast(queries.select("query_id", "max_expanded")), "query_id").filter(F.col("nth") <= F.col("max_expanded"))
    return seeds.unionByName(kept.select(*docs.columns))


def oracle_kept(members: DataFrame, specs: DataFrame, queries: DataFrame, *columns: str) -> DataFrame:
    """The documents that ``oracle_query`` ranks, with these columns (none: all), written once."""
    docs = oracle_documents(members, specs, queries, not columns or "matched_entities" in columns)
    need = dict.fromkeys(("query_id", "doc_id", "match_stage", "score", *columns)) if columns else docs.columns
    return best_expanded(settle(docs.select(*need), "oracle-documents"), queries)


def oracle_query(members: DataFrame, specs: DataFrame, queries: DataFrame, *columns: str) -> DataFrame:
    """Ranked documents of many queries at once, from same-event seeds and one hop.

    ``members`` has event_id, doc_id, entity_type, value; ``specs`` query_id,
    group, entity_type, value; ``queries`` query_id, n_groups, operator,
    frontier (array of types, null or empty: no hop) and max_expanded. An event
    belongs to one document. It is a seed if it hits every group (AND) or any
    (OR) and scores 10 a matched entity; other events that share frontier
    entities of a query's seeds score 3 each less 5. A document has its best
    event's score, is a seed if any of its events is, and unites what matched.
    Expanded documents are cut to the best ``max_expanded`` of a query; then
    all are ranked by score, seeds first on ties, then id. ``columns`` names
    what is wanted besides the rank (none: all).
    """
    kept = oracle_kept(members, specs, queries, *columns)
    return numbered(kept, "rank", F.desc("score"), F.desc("match_stage"), F.asc("doc_id"), by=("query_id",))


def oracle_metrics(ranked: DataFrame, qrels: DataFrame, cutoffs: tuple[int, ...] = (5, 10)) -> DataFrame:
    """One row a query of ``qrels``: precision, recall and nDCG at each cutoff, MRR, and how seeds and hops did.

    ``ranked`` comes from ``oracle_query``; ``qrels`` has query_id, doc_id and
    grade (1 and more). Four digits; the hop's rates are null without a hop.
    """
    gain, rank, relevant = F.pow(F.lit(2.0), F.col("grade")) - 1, F.col("rank"), F.col("grade").isNotNull()
    count = lambda cond: F.count(F.when(cond, 1))
    seed, hop = F.col("match_stage") == SEED, F.col("match_stage") == HOP
    judged = ranked.join(qrels, ["query_id", "doc_id"], "left")
    sums = [x for k in cutoffs for x in (count(relevant & (rank <= k)).alias(f"hits_{k}"), F.sum(F.when(rank <= k, gain / F.log2(rank + 1.0))).alias(f"dcg_{k}"))]
    got = judged.groupBy("query_id").agg(*sums, F.min(F.when(relevant, rank)).alias("first"), F.count(F.lit(1)).alias("retrieved"), count(seed).alias("seeds"), count(hop).alias("hops"), count(seed & relevant).alias("good_seeds"), count(hop & relevant).alias("good_hops"))
    best = qrels.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("grade"), "doc_id"))).filter(rank <= max(cutoffs))  # a task sends its best only
    top = best.groupBy("query_id").agg(*(F.sum(F.when(rank <= k, gain / F.log2(rank + 1.0))).alias(f"idcg_{k}") for k in cutoffs))
    ideal = qrels.groupBy("query_id").agg(F.count(F.lit(1)).alias("relevant")).join(top, "query_id")
    rows = ideal.join(got, "query_id", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    at = [x for k in cutoffs for x in (F.round(n(f"hits_{k}") / k, 4).alias(f"precision_{k}"), F.round(n(f"hits_{k}") / F.col("relevant"), 4).alias(f"recall_{k}"), F.round(F.when(F.col(f"idcg_{k}") > 0, n(f"dcg_{k}") / F.col(f"idcg_{k}")).otherwise(0.0), 4).alias(f"ndcg_{k}"))]
    hop_rate = lambda part: F.round(F.when(n("hops") > 0, part / n("hops")), 4)
    return rows.select(
        "query_id", *at, F.round(F.coalesce(1.0 / F.col("first"), F.lit(0.0)), 4).alias("mrr"), "relevant", n("retrieved").alias("retrieved"), n("seeds").alias("seeds"), n("hops").alias("hops"),
        F.round(n("good_seeds") / F.col("relevant"), 4).alias("seed_recall"), ratio(n("seeds") - n("good_seeds"), n("seeds")).alias("false_seed_rate"),
        hop_rate(n("good_hops")).alias("one_hop_precision"), hop_rate(n("hops") - n("good_hops")).alias("erroneous_expansion_rate"),
    )


COUNTED = ("query_id", "relevant", "retrieved", "seeds", "hops")


def macro_deltas(one: DataFrame, other: DataFrame, names: tuple[str, str] = ("flat", "issue_aware")) -> DataFrame:
    """(metric, first, second, delta): averages over queries, nulls skipped, and second less first."""
    metrics = [c for c in one.columns if c not in COUNTED]

    def means(df: DataFrame, name: str) -> DataFrame:
        row = df.agg(*(F.round(F.avg(c), 4).alias(c) for c in metrics))
        return row.select(F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).alias(name)) for c in metrics))).alias("x")).select("x.*")

    first, second = names
    return means(one, first).join(means(other, second), "metric").withColumn("delta", F.round(F.col(second) - F.col(first), 4))


def paired_effects(one: DataFrame, other: DataFrame, qrels: DataFrame) -> DataFrame:
    """One row of twelve counters: what the second ranking drops, promotes and adds against the first."""
    stage = lambda df, name: df.select("query_id", "doc_id", F.col("match_stage").alias(name))
    both = stage(one, "a").join(stage(other, "b"), ["query_id", "doc_id"], "full_outer").join(qrels.select("query_id", "doc_id", F.lit(True).alias("good")), ["query_id", "doc_id"], "left")
    a, b, good = F.col("a"), F.col("b"), F.coalesce("good", F.lit(False))
    seeds_only = (a == SEED) & ~F.coalesce(b == SEED, F.lit(False))
    groups = {
        "flat_seed_docs": seeds_only, "flat_expansion_docs": (a == HOP) & b.isNull(), "issue_expansion_docs": (b == HOP) & a.isNull(),
        "flat_result_docs": a.isNotNull() & b.isNull(), "issue_result_docs": b.isNotNull() & a.isNull(),
    }
    count = lambda cond, name: F.count(F.when(cond, 1)).alias(name)
    out = [count(seeds_only, "flat_only_seed_docs"), count((a == HOP) & (b == SEED), "flat_expansion_promoted_to_issue_seed")]
    for name, cond in groups.items():
        bad_word, good_word = ("removed_irrelevant", "lost_relevant") if name.startswith("flat") else ("new_irrelevant", "new_relevant")
        out += [count(cond & ~good, f"{bad_word}_{name}"), count(cond & good, f"{good_word}_{name}")]
    return both.agg(*out)


def oracle_rollup(members: DataFrame, specs: DataFrame) -> DataFrame:
    """Seeds alone, every group asked for: (query_id, doc_id, score, n_events)."""
    queries = specs.groupBy("query_id").agg(F.count_distinct("group").alias("n_groups")).withColumns({"operator": F.lit("AND"), "frontier": F.lit(None).cast("array<string>"), "max_expanded": F.lit(0)})
    return oracle_documents(members, specs, queries, False).select("query_id", "doc_id", "score", F.col("seed_events").alias("n_events"))


def set_counts(sides: dict[str, DataFrame], keys: list[str], by: list[str]) -> DataFrame:
    """Members of several sets with one boolean column a set; one shuffle, whatever their number."""
    tagged = None
    for name, rows in sides.items():
        part = rows.select(*by, *keys, *((F.lit(True) if n == name else F.lit(False)).alias(n) for n in sides))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(*by, *keys).agg(*(F.max(n).alias(n) for n in sides))


def ledger_audit(raw: DataFrame, final: DataFrame, gold: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Twelve counts for each value of ``by``: hits and errors before and after validation, and what validation kept, removed and added."""
    r, f, g = F.col("in_raw"), F.col("in_final"), F.col("in_gold")
    count = lambda cond, name: F.count(F.when(cond, 1)).alias(name)
    stages = [x for name, s in (("raw", r), ("final", f)) for x in (count(s & g, f"{name}_tp"), count(s & ~g, f"{name}_fp"), count(~s & g, f"{name}_fn"))]
    moves = [
        count(r & f & g, "correctly_kept"), count(r & f & ~g, "incorrectly_kept"), count(r & ~f & ~g, "correctly_removed"),
        count(r & ~f & g, "wrongly_removed"), count(~r & f & g, "correct_additions"), count(~r & f & ~g, "incorrect_additions"),
    ]
    return set_counts({"in_raw": raw, "in_final": final, "in_gold": gold}, keys, by).groupBy(*by).agg(*stages, *moves)


def status_transitions(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(before, after, n) of the ``status`` columns; ``missing`` where one side lacks the record."""
    both = before.select(*keys, F.col("status").alias("before")).join(after.select(*keys, F.col("status").alias("after")), keys, "full_outer")
    shown = [F.coalesce(c, F.lit("missing")).alias(c) for c in ("before", "after")]
    return both.select(*shown).groupBy("before", "after").agg(F.count(F.lit(1)).alias("n"))


def comembership(gold: DataFrame, predicted: DataFrame, group: str) -> DataFrame:
    """Scores of the pairs of members (role, v) of one issue: all, object with behaviour, and location with either.

    ``gold`` and ``predicted`` hold members. ``false_rate`` is the share of
    predicted pairs that gold lacks. Pairs are counted, not made: a kind's
    pairs in an issue are products of the numbers of its members by role.
    """
    place, thing = ("road", "intersection", "poi"), ("problem_object", "problem_behavior")
    side = lambda rows, mine: rows.select(F.col(group).alias("__g"), "role", "v", F.lit(mine).alias("g"), F.lit(not mine).alias("p"))
    rows = side(gold, True).unionByName(side(predicted, False)).filter("__g IS NOT NULL").repartition(tasks_for(gold, predicted), "__g")
    sets = rows.groupBy("__g", "role", "v").agg(F.max("g").alias("g"), F.max("p").alias("p"))
    sides = {"g": F.col("g"), "p": F.col("p"), "b": F.col("g") & F.col("p") & F.col("v").isNotNull()}  # nulls equal nothing
    roles = {"all": F.lit(True), "place": F.col("role").isin(*place), **{t: F.col("role") == t for t in thing}}
    sizes = sets.groupBy("__g").agg(*(F.count(F.when(c & r, 1)).alias(f"{s}_{name}") for s, c in sides.items() for name, r in roles.items()))

    def numbers(s: str) -> dict[str, Column]:
        of = lambda name: F.col(f"{s}_{name}")
        return {
            "issue_co_membership": F.floor(of("all") * (of("all") - 1) / 2), "object_behavior_attachment": of(thing[0]) * of(thing[1]),
            "location_attachment": of("place") * (of(thing[0]) + of(thing[1])),
        }

    g, p, tp = (numbers(s) for s in ("g", "p", "b"))
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), tp[k].alias("tp"), (p[k] - tp[k]).alias("fp"), (g[k] - tp[k]).alias("fn")) for k in g))
    counts = sizes.select(F.explode(kinds).alias("k")).select("k.*").groupBy("kind").agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn")))
    scored = with_prf(counts.filter("tp + fp + fn > 0"))
    return scored.withColumn("false_rate", ratio(F.col("fp"), F.col("tp") + F.col("fp")))


def discourse_scores(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """(measure, tp, fp, fn, precision, recall, f1) over gold's records: labels and grounded labels of intents and emotions, and exact accuracies.

    Both have doc_id, ``intents`` and ``emotions`` (arrays of label, evidence
    and intensity), ``satisfaction`` (label, target, evidence) and ``urgency``
    (level, evidence). A missing statement is ``unknown`` or ``normal``. The
    accuracies count gold's records as tp and fn; precision and recall agree.
    """
    text = lambda c: F.coalesce(c, F.lit(""))

    def entries(rows: DataFrame) -> DataFrame:
        entry = lambda measure, *parts: F.struct(F.lit(measure).alias("measure"), F.array(*parts).alias("said"))
        named = lambda c: F.filter(F.coalesce(F.col(c), F.lit(None)), lambda x: text(x["label"]) != "")
        parts = [
            F.transform(named("intents"), lambda x: entry("intent_labels", x["label"])), F.transform(named("intents"), lambda x: entry("intent_grounded", x["label"], text(x["evidence"]))),
            F.transform(named("emotions"), lambda x: entry("emotion_labels", x["label"])),
            F.transform(named("emotions"), lambda x: entry("emotion_grounded", x["label"], F.coalesce(x["intensity"], F.lit(0)).cast("string"), text(x["evidence"]))),
        ]
        mood = entry("satisfaction_exact", F.coalesce(F.nullif("satisfaction.label", F.lit("")), F.lit("unknown")), text(F.col("satisfaction.target")), text(F.col("satisfaction.evidence")))
        haste = entry("urgency_exact", F.coalesce(F.nullif("urgency.level", F.lit("")), F.lit("normal")), text(F.col("urgency.evidence")))
        none = F.array().cast("array<struct<measure:string,said:array<string>>>")
        return rows.select("doc_id", F.explode(F.concat(*(F.coalesce(p, none) for p in parts), F.array(mood, haste))).alias("e")).select("doc_id", "e.*")

    judged = predicted.join(gold.select("doc_id"), "doc_id", "left_semi")
    scores = prf(entries(gold), entries(judged), ["doc_id", "said"], ["measure"])
    exact = F.col("measure").endswith("_exact")
    share = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return scores.withColumns({"fp": F.when(exact, 0).otherwise(F.col("fp")), **{c: F.when(exact, share).otherwise(F.col(c)) for c in ("precision", "recall", "f1")}})
