"""Event-entity graph: seed selection, one-hop expansion, scores and reports.

``links`` has event_id, doc_id, entity_id, entity_type, entity_value,
normalized_value and confidence; ``events`` has event_id, doc_id and
event_month. A query is one lazy plan: seeds by a count of distinct groups,
the frontier by a semi-join, expansion by an equi-join on the entity with a
map-side pre-aggregation. The seed specification is configuration-sized and
is broadcast; nothing that grows with the data is.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import clean, short_hash, squeeze
from caseloom.session import numbered, settle, values

# --- fixed values: entity types that may carry an expansion ---
FRONTIER_TYPES = ("problem_object", "problem_behavior", "area", "street", "road", "intersection", "poi", "case_type", "time_month", "department", "lnglat")
SEED_POINTS, SPACE_POINTS, EXPANSION_COST = 10.0, 3.0, 5.0
#: Groups that one column of bits can hold.
BITS = 62


@dataclass(frozen=True)
class GraphQuery:
    """Seed groups of (type, values), how they combine, filters and expansion."""

    groups: tuple[tuple[str, tuple[str, ...]], ...]
    operator: str = "AND"
    month_from: str | None = None
    month_to: str | None = None
    satisfaction: str | None = None
    urgency: tuple[str, ...] = ()
    intent: str | None = None
    frontier: tuple[str, ...] = ()
    max_expanded: int = 2000
    allowed_frontier: tuple[str, ...] = field(default=FRONTIER_TYPES)

    def __post_init__(self):
        bad = sorted(set(self.frontier) - set(self.allowed_frontier))
        if bad:
            raise ValueError("invalid_frontier_entity_types:" + ",".join(bad))
        if self.operator.upper() not in ("AND", "OR"):
            raise ValueError("operator must be AND or OR")


def entity_id(kind: Column, normalized: Column) -> Column:
    return F.concat(F.lit("entity_"), short_hash(F.concat_ws(":", kind, normalized)))


def event_filter(events: DataFrame, q: GraphQuery, discourse: DataFrame | None = None) -> DataFrame:
    """Events in the month range; discourse filters also drop events without discourse."""
    if q.month_from:
        events = events.filter(F.col("event_month") >= q.month_from)
    if q.month_to:
        events = events.filter(F.col("event_month") <= q.month_to)
    if q.satisfaction or q.urgency or q.intent:
        d = discourse
        if q.satisfaction:
            d = d.filter(F.col("satisfaction") == q.satisfaction)
        if q.urgency:
            d = d.filter(F.col("urgency").isin(*q.urgency))
        if q.intent:
            d = d.filter(F.array_contains(F.from_json(F.coalesce("inferred_intents_json", F.lit("")), "array<string>"), q.intent))
        events = events.join(d.select("event_id"), "event_id", "left_semi")
    return events


def seed_hits(links: DataFrame, q: GraphQuery) -> DataFrame:
    """Link rows that hit a seed group, with its number."""
    groups = [(k, kind, "".join(v.split())) for k, (kind, values) in enumerate(q.groups) for v in values if "".join(v.split())]
    if not groups:
        return links.limit(0).withColumn("group", F.lit(0))
    spec = values(links.sparkSession, groups, "group", "entity_type", "want")
    links = links.filter(F.col("entity_type").isin(*{kind for _, kind, _ in groups}) & squeeze(F.col("normalized_value")).isin(*{v for _, _, v in groups}))  # goes down to the scans
    return links.join(F.broadcast(spec), (links["entity_type"] == spec["entity_type"]) & (squeeze(links["normalized_value"]) == spec["want"])).drop(spec["entity_type"]).drop("want")


def wanted_links(links: DataFrame, events: DataFrame, q: GraphQuery, discourse: DataFrame | None = None) -> DataFrame:
    """Links of the events that the filters leave; all where there is no filter."""
    kept = event_filter(events, q, discourse)
    return links if kept is events else links.join(kept.select("event_id"), "event_id", "left_semi")


def seeds(links: DataFrame, events: DataFrame, q: GraphQuery, discourse: DataFrame | None = None) -> DataFrame:
    """(event_id, doc_id, matched, confidence_sum) of seed events.

    AND asks for every group, also for one without values, which no event
    hits. Matches and confidence count over the link rows of all groups. Links
    of events that the filters drop are left out before they are counted, and
    groups are counted as bits, for distinct counts would repeat every row.
    """
    need = len(q.groups) if q.operator.upper() == "AND" else 1
    kept = event_filter(events, q, discourse).select("event_id").hint("shuffle_hash")  # hits stay unsorted
    hit = seed_hits(links, q).join(kept, "event_id", "left_semi")
    words = range(len(q.groups) // BITS + 1)
    bit = lambda w: F.when(F.floor(F.col("group") / BITS) == w, F.expr(f"shiftleft(1L, group % {BITS})")).otherwise(F.lit(0).cast("long"))
    by_entity = hit.groupBy("event_id", "doc_id", "entity_type", "entity_value").agg(*(F.bit_or(bit(w)).alias(f"g{w}") for w in words), F.sum("confidence").alias("confidence_sum"))
    by_event = by_entity.groupBy("event_id", "doc_id").agg(*(F.bit_or(f"g{w}").alias(f"g{w}") for w in words), F.count("entity_value").alias("matched"), F.sum("confidence_sum").alias("confidence_sum"))
    n_groups = sum((F.bit_count(f"g{w}") for w in words), F.lit(0))
    return by_event.filter((n_groups >= need) & F.lit(bool(q.groups))).select("event_id", "doc_id", "matched", "confidence_sum")


def frontier(links: DataFrame, seed: DataFrame, q: GraphQuery) -> DataFrame:
    """Distinct entities of the seed events, of the frontier's types; the smallest value names an entity."""
    near = links.filter(F.col("entity_type").isin(*q.frontier)) if q.frontier else links.limit(0)
    return near.join(seed.select("event_id"), "event_id", "left_semi").groupBy("entity_id", "entity_type").agg(F.min("entity_value").alias("entity_value"))


def at_frontier(links: DataFrame, seed: DataFrame, q: GraphQuery) -> DataFrame:
    """Links to the frontier's entities; an id is made of its type, so links of other types are left out before the join."""
    near = links.filter(F.col("entity_type").isin(*q.frontier)) if q.frontier else links.limit(0)
    return near.join(frontier(links, seed, q).select("entity_id"), "entity_id", "left_semi")


def expansion(links: DataFrame, events: DataFrame, seed: DataFrame, q: GraphQuery, discourse: DataFrame | None = None) -> DataFrame:
    """(event_id, doc_id, shared, confidence_sum): other events at the frontier, the best ``max_expanded``."""
    near = links.filter(F.col("entity_type").isin(*q.frontier)) if q.frontier else links.limit(0)
    at = wanted_links(near, events, q, discourse).join(frontier(links, seed, q).select("entity_id"), "entity_id", "left_semi")
    found = at.groupBy("event_id").agg(F.count(F.lit(1)).alias("shared"), F.sum("confidence").alias("confidence_sum"))
    found = found.join(seed.select("event_id"), "event_id", "left_anti").join(event_filter(events, q, discourse).select("event_id", "doc_id"), "event_id")
    return found.orderBy(F.desc("shared"), "event_id").limit(q.max_expanded).select("event_id", "doc_id", "shared", "confidence_sum")


def structural_score(stage: Column, matched: Column, shared: Column, confidence: Column) -> Column:
    cost = F.when(stage == "one_hop_expansion", EXPANSION_COST).otherwise(0.0)
    return F.round(matched * SEED_POINTS + shared * SPACE_POINTS + confidence - cost, 6)


def query_graph(links: DataFrame, events: DataFrame, q: GraphQuery, discourse: DataFrame | None = None) -> DataFrame:
    """Ranked seeds and expansions: score falling, stage, doc_id."""
    seed = settle(seeds(links, events, q, discourse), "seeds")  # read three times
    none = F.lit(0).cast("long")
    rows = seed.select("event_id", "doc_id", F.lit("seed_entity").alias("match_stage"), F.col("matched"), none.alias("shared"), "confidence_sum")
    if q.frontier:
        more = expansion(links, events, seed, q, discourse)
        rows = rows.unionByName(more.select("event_id", "doc_id", F.lit("one_hop_expansion").alias("match_stage"), none.alias("matched"), "shared", "confidence_sum"))
    rows = rows.withColumn("score", structural_score(F.col("match_stage"), F.col("matched"), F.col("shared"), F.col("confidence_sum")))
    return numbered(rows, "rank", F.desc("score"), F.asc("match_stage"), F.asc("doc_id"), F.asc("event_id"))


def explained(links: DataFrame, ranked: DataFrame, q: GraphQuery) -> DataFrame:
    """``ranked`` with ``matched_entities``: sorted distinct "type:value" that made each row's score.

    For a seed these are its entities in the seed groups, for an expansion
    those at the frontier; both are read for the ranked events only, so a list
    is bounded by one event's links.
    """
    seed = ranked.filter("match_stage = 'seed_entity'")
    name = F.concat_ws(":", "entity_type", "entity_value").alias("name")
    hit = seed_hits(links, q).join(seed.select("event_id"), "event_id", "left_semi").select("event_id", F.lit("seed_entity").alias("match_stage"), name)
    others = ranked.filter("match_stage <> 'seed_entity'").select("event_id")
    near = at_frontier(links, seed, q).join(others, "event_id", "left_semi")
    names = hit.unionByName(near.select("event_id", F.lit("one_hop_expansion").alias("match_stage"), name))
    lists = names.groupBy("event_id", "match_stage").agg(F.array_sort(F.collect_set("name")).alias("matched_entities"))
    return ranked.join(lists, ["event_id", "match_stage"], "left")


# --- the stored graph ---
def store_graph(events: DataFrame, links: DataFrame, label: str) -> dict[str, DataFrame]:
    """Write the graph's tables once and give them back: events, links, entities.

    Each task sorts its own links by entity, so that a query for entities reads
    few row groups of a file; links are not shuffled for it, for a frequent
    entity would gather in one task.
    """
    clustered = links.sortWithinPartitions("entity_type", "normalized_value", "event_id")
    stored = settle(clustered, f"{label}-links")
    return {"events": settle(events, f"{label}-events"), "links": stored, "entities": settle(entity_dictionary(stored), f"{label}-entities")}


def load_counts(graph: dict[str, DataFrame]) -> DataFrame:
    """(name, n): rows of each stored table."""
    counts = [df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")) for name, df in sorted(graph.items())]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def report(links: DataFrame, ranked: DataFrame, rows: DataFrame, facets: dict[str, Column], entity_types: tuple[str, ...], coverage: tuple[str, ...]) -> DataFrame:
    """The query's report as (section, key, value, n): stages, facets, entity facets, coverage by channel.

    ``rows`` has the matched documents' metadata by doc_id. ``ranked`` is
    written once, for every section reads it.
    """
    ranked = settle(ranked, "graph-report")
    cells = lambda df, section, key, value: df.select(F.lit(section).alias("section"), key.alias("key"), value.cast("string").alias("value"), F.col("n").cast("long").alias("n"))
    stages = ranked.groupBy("match_stage").agg(F.count(F.lit(1)).alias("n"))
    matched = rows.join(ranked.select("doc_id").distinct(), "doc_id", "left_semi")
    out = cells(stages, "stage", F.lit("match_stage"), F.col("match_stage"))
    out = out.unionByName(cells(facet_counts(matched, facets), "facet", F.col("facet"), F.col("value")))
    out = out.unionByName(cells(entity_facets(links, ranked, entity_types), "entity", F.col("facet"), F.col("value")))
    covered = entity_coverage(links, ranked, coverage).withColumnRenamed("docs", "n")
    out = out.unionByName(cells(covered, "coverage", F.lit("documents"), F.col("entity_type")))
    return out.unionByName(cells(entity_channels(links, ranked), "channel", F.col("source_channel"), F.col("entity_type")))


def entity_channels(links: DataFrame, matched: DataFrame) -> DataFrame:
    """(entity_type, source_channel, n): matched documents with a link of the type from the channel."""
    return links.join(matched.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("entity_type", "source_channel").agg(F.count_distinct("doc_id").alias("n"))


def representatives(ranked: DataFrame, rows: DataFrame, limit: int) -> DataFrame:
    """The best ``limit`` ranked rows with their documents' columns (none where the document is missing)."""
    return ranked.orderBy("rank").limit(limit).join(rows, "doc_id", "left")


# --- reports over matched documents ---
def facet_counts(df: DataFrame, facets: dict[str, Column]) -> DataFrame:
    """(facet, value, n) of non-empty values, all facets in one pass."""
    pairs = F.explode(F.array(*(F.struct(F.lit(name).alias("facet"), c.cast("string").alias("value")) for name, c in facets.items())))
    return df.select(pairs.alias("x")).select("x.facet", "x.value").filter("value <> ''").groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def entity_facets(links: DataFrame, matched: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """(facet, value, n): link rows of matched documents by entity value."""
    rows = links.filter(F.col("entity_type").isin(*types)).join(matched.select("doc_id").distinct(), "doc_id", "left_semi")
    return rows.groupBy(F.col("entity_type").alias("facet"), F.col("entity_value").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def entity_coverage(links: DataFrame, matched: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """(entity_type, docs, share): matched documents with a link of each type, zeros kept."""
    docs = matched.select("doc_id").distinct()
    total = docs.agg(F.count(F.lit(1)).alias("total"))
    have = links.join(docs, "doc_id", "left_semi").groupBy("entity_type").agg(F.count_distinct("doc_id").alias("docs"))
    kinds = values(links.sparkSession, [(t,) for t in types], "entity_type")
    return kinds.join(have, "entity_type", "left").crossJoin(F.broadcast(total)).select("entity_type", F.coalesce("docs", F.lit(0)).cast("long").alias("docs"), F.when(F.col("total") > 0, F.coalesce("docs", F.lit(0)) / F.col("total")).otherwise(0.0).alias("share"))


def metadata_recovery(rows: DataFrame, field_name: str, recovered: dict[str, Column]) -> DataFrame:
    """One row: rows whose metadata lack a field, and how many get it from each source or any."""
    missing = clean(F.col(field_name)) == ""
    any_of = F.lit(False)
    for c in recovered.values():
        any_of = any_of | c
    count = lambda cond: F.count(F.when(cond, 1))
    return rows.agg(count(missing).alias("missing"), *(count(missing & c).alias(f"from_{n}") for n, c in recovered.items()), count(missing & any_of).alias("recovered"))


def conflicts(rows: DataFrame, key: str, declared: str, found: str) -> DataFrame:
    """(key, declared, others): keys whose found values go beyond the declared one."""
    sets = rows.filter((F.col(declared) != "") & (F.col(found) != "")).groupBy(key, declared).agg(F.array_sort(F.collect_set(found)).alias("all"))
    return sets.select(key, declared, F.array_except("all", F.array(declared)).alias("others")).filter(F.size("others") > 0)


def entity_dictionary(links: DataFrame) -> DataFrame:
    """One row an entity; the value seen first (by ordinal, then the smallest) names it.

    Links are counted by value in a hash map with numbers only; the choice of a
    name, which would sort every link, is left to the few counts.
    """
    keys = ["entity_type", "normalized_value"]
    counted = links.groupBy(*keys, "entity_value").agg(F.min("ordinal").alias("ordinal"), F.count(F.lit(1)).alias("n"))
    first = F.min_by("entity_value", F.struct(F.col("ordinal").isNull(), "ordinal", "entity_value")).alias("entity_value")
    return counted.groupBy(*keys).agg(first, F.sum("n").alias("n_links")).select(entity_id(F.col("entity_type"), F.col("normalized_value")).alias("entity_id"), "entity_type", "entity_value", "normalized_value", "n_links")


def degree_summary(df: DataFrame, column: str) -> list[Column]:
    """count, min, p50, p95, max, mean of a number, interpolated, four digits."""
    c = F.col(column)
    return [F.count(c).alias("n"), F.min(c).cast("double").alias("lo"), F.round(F.percentile(c, F.lit(0.5)), 4).alias("p50"), F.round(F.percentile(c, F.lit(0.95)), 4).alias("p95"), F.max(c).cast("double").alias("hi"), F.round(F.avg(c), 4).alias("mean")]


def generic_noise(links: DataFrame, stop: tuple[str, ...]) -> DataFrame:
    """(entity_type, entity_value, n): links to entities too general to mean anything."""
    return links.filter(F.col("entity_value").isin(*stop)).groupBy("entity_type", "entity_value").agg(F.count(F.lit(1)).alias("n"))
