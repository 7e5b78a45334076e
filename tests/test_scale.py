"""Plans of the queries that grow with the order tables, on rows small enough to count by hand."""

from pyspark.sql import functions as F

from caseloom.operators import evaluation as ev
from caseloom.session import numbered, values


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbers_restart_for_each_value(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("q"), F.col("id"))
    got = numbered(rows, "n", F.desc("id"), by=("q",)).collect()
    assert {(r["q"], r["id"]): r["n"] for r in got} == {(i % 3, i): 1 + sum(1 for j in range(i + 1, 100) if j % 3 == i % 3) for i in range(100)}


def test_oracle_ranks_without_a_task_for_each_query(spark):
    members = values(spark, [("a1", 1, "brand", "x"), ("a1", 1, "flag", "R"), ("a1", 1, "flag", "R"), ("b1", 2, "brand", "x"), ("c1", 3, "brand", "x"), ("d1", 4, "brand", "y"), ("a2", 1, "brand", "x")], "event_id", "doc_id", "entity_type", "value")
    specs = values(spark, [(0, 0, "brand", "x"), (0, 1, "flag", "R")], "query_id", "group", "entity_type", "value")
    queries = values(spark, [(0, 2, "AND", ["brand"], 1)], "query_id", "n_groups", "operator", "frontier", "max_expanded")
    ranked = ev.oracle_query(members, specs, queries)
    assert "Window" not in plan(ranked).replace("WindowGroupLimit", "").split("BroadcastExchange")[0]
    got = [(r["doc_id"], r["match_stage"], r["score"], r["seed_events"], r["expanded_events"], r["matched_entities"], r["rank"]) for r in ranked.orderBy("rank").collect()]
    assert got == [(1, ev.SEED, 20.0, 1, 1, ["brand:x", "flag:R"], 1), (2, ev.HOP, -2.0, 0, 1, ["brand:x"], 2)]


def test_more_seed_groups_than_one_word_of_bits(spark):
    n = 130
    members = spark.range(n).select(F.lit("e").alias("event_id"), F.lit(1).alias("doc_id"), F.lit("t").alias("entity_type"), F.col("id").cast("string").alias("value"))
    specs = spark.range(n).select(F.lit(0).alias("query_id"), F.col("id").alias("group"), F.lit("t").alias("entity_type"), F.col("id").cast("string").alias("value"))
    for least, found in ((n, 1), (n + 1, 0)):
        queries = values(spark, [(0, least, "AND", ["t"], 5)], "query_id", "n_groups", "operator", "frontier", "max_expanded")
        assert ev.oracle_documents(members, specs, queries).filter(F.col("match_stage") == ev.SEED).count() == found


def test_entity_names_are_chosen_without_sorting_links(spark):
    from caseloom.operators import graph

    links = values(spark, [("poi", "b", "x", 2), ("poi", "a", "x", 1), ("poi", "c", "x", 1), ("poi", "z", "y", 5)], "entity_type", "entity_value", "normalized_value", "ordinal")
    found = graph.entity_dictionary(links)
    assert {(r["normalized_value"], r["entity_value"], r["n_links"]) for r in found.collect()} == {("x", "a", 3), ("y", "z", 1)}
    assert "min(ordinal" in plan(found)


def test_graph_queries_read_only_the_types_they_ask_for(spark, tmp_path):
    from caseloom.plans import graph_plans

    d = "/root/testdata/sf0.001"
    noise = plan(graph_plans.graph_generic_noise(spark, d))
    assert "caseloom-shared" not in noise and "-links-" not in noise
    assert "supplier" not in plan(graph_plans.graph_seed_and(spark, d))


def test_pairs_are_counted_without_being_made(spark):
    gold = [(1, "road", 1), (1, "problem_object", 2), (1, "problem_behavior", 3), (1, "road", 1), (2, "road", 5), (None, "road", 1), (None, "road", 2)]
    guess = [(1, "road", 1), (1, "problem_object", 2), (1, "problem_object", 4), (3, "road", 5), (3, "poi", 6)]
    one, two = (spark.createDataFrame(rows, "k long, role string, v long") for rows in (gold, guess))
    plain = ev.prf(*(ev.pairs_within(rows.filter("k IS NOT NULL"), "k", "v").withColumn("role", F.lit("all")) for rows in (one, two)), ["k", "lo", "hi"], ["role"]).drop("role")
    assert ev.pair_prf(one, two, "k", "v").collect() == plain.collect()
    assert "explode" not in plan(ev.pair_prf(one, two, "k", "v"))
    got = {r["kind"]: (r["tp"], r["fp"], r["fn"]) for r in ev.comembership(one, two, "k").collect()}
    assert got == {"issue_co_membership": (1, 3, 2), "object_behavior_attachment": (0, 0, 1), "location_attachment": (1, 1, 1)}


def test_bm25_deals_hits_by_the_rows_they_make(spark, monkeypatch):
    from caseloom.operators import retrieval as rt

    monkeypatch.setattr(rt, "TASK_ROWS", 10, raising=False)
    docs = spark.range(50).select("id", F.lit("a b").alias("text"))
    queries = spark.range(3).select(F.col("id").alias("query_id"), F.lit("a").alias("query"))
    assert "hashpartitioning(doc_id" in (p := plan(rt.bm25(docs, "id", F.col("text"), queries))) and ", 15), REPARTITION_BY_NUM" in p


def test_oracle_tasks_grow_with_members_and_queries_take_several_passes(spark, monkeypatch):
    members = spark.range(60).select(F.col("id").cast("string").alias("event_id"), F.col("id").alias("doc_id"), F.lit("t").alias("entity_type"), (F.col("id") % 20).cast("string").alias("value"))
    specs = spark.range(20).select(F.col("id").cast("int").alias("query_id"), F.lit(0).alias("group"), F.lit("t").alias("entity_type"), F.col("id").cast("string").alias("value"))
    queries = values(spark, [(q, 1, "AND", ["t"] if q % 2 else [], 5) for q in range(20)], "query_id", "n_groups", "operator", "frontier", "max_expanded")
    monkeypatch.setattr(ev, "TASK_ROWS", 6)
    docs = ev.oracle_documents(members, specs, queries, False)
    assert "collect_list" not in plan(docs) and "hashpartitioning(doc_id" in plan(docs) and ", 11), REPARTITION_BY_NUM" in plan(docs)
    assert {(r["query_id"], r["doc_id"], r["score"]) for r in docs.collect()} == {(i % 20, i, 10.0) for i in range(60)}


def test_pairs_are_dealt_to_as_many_tasks_as_rows_ask_for(spark, monkeypatch):
    monkeypatch.setattr(ev, "TASK_ROWS", 10)
    rows = spark.range(50).select((F.col("id") % 5).alias("k"), F.lit("road").alias("role"), F.col("id").alias("v"))
    for found in (ev.pair_prf(rows, rows, "k", "v"), ev.comembership(rows, rows, "k")):
        assert ", 11), REPARTITION_BY_NUM" in plan(found)
        assert found.first()["tp"] == 5 * 45


def test_links_of_filtered_events_are_left_out_before_they_are_counted(spark):
    from caseloom.operators import graph
    from caseloom.plans import graph_plans

    d = "/root/testdata/sf0.001"
    assert "LeftSemi" in plan(graph_plans.graph_seed_or(spark, d))
    read = plan(graph_plans.graph_frontier(spark, d))
    assert "/seeds-" in read and "orders.parquet" not in read
    rows, when = graph_plans.links(spark, d), graph_plans.events(spark, d)
    assert graph.wanted_links(rows, when, graph.GraphQuery(groups=())) is rows


def test_ranked_graph_queries_write_the_months_lines_once(spark):
    from caseloom.operators import graph
    from caseloom.plans import graph_plans

    d, q = "/root/testdata/sf0.001", graph_plans.FLAGSHIP
    for query in (graph_plans.graph_query_explained, graph_plans.graph_entity_facets):
        read = plan(query(spark, d))
        assert "lineitem.parquet" not in read and "/lines-" in read
    rows, when, orders = graph_plans.in_months(spark, d, q)
    everything = graph_plans.links(spark, d)
    cells = ("event_id", "entity_id", "ordinal", "confidence", "source_channel")
    assert sorted(rows.select(*cells).collect()) == sorted(graph.wanted_links(everything, graph_plans.events(spark, d), q).select(*cells).collect())
    assert when.count() == orders.count() == graph.event_filter(graph_plans.events(spark, d), q).count() > 0


def test_seed_groups_are_counted_without_repeating_rows(spark):
    from caseloom.operators import graph

    n = 70
    found = spark.range(n).select(F.lit("e").alias("event_id"), F.lit("d").alias("doc_id"), F.lit("t").alias("entity_type"), F.col("id").cast("string").alias("entity_value"), F.col("id").cast("string").alias("normalized_value"), F.lit(0.5).alias("confidence"))
    found = found.unionByName(found.filter("normalized_value = '3'")).unionByName(found.filter("normalized_value = '4'").withColumn("entity_value", F.lit(None).cast("string")))
    when = values(spark, [("e", "d", "2024-01"), ("f", "g", "2024-01")], "event_id", "doc_id", "event_month")
    groups = tuple(("t", (str(i),)) for i in range(n))
    out = graph.seeds(found, when, graph.GraphQuery(groups=(*groups, ("t", ("3",)))))
    assert "Expand" not in plan(out) and "LeftSemi" in plan(out)
    assert [tuple(r) for r in out.collect()] == [("e", "d", n, (n + 4) * 0.5)]  # the value of two groups counts once, its rows' confidence for each group
    assert graph.seeds(found, when, graph.GraphQuery(groups=(*groups, ("t", ())))).count() == 0
    assert graph.seeds(found, when, graph.GraphQuery(groups=(*groups, ("t", ("none",))), operator="OR")).count() == 1
    assert graph.seeds(found, when, graph.GraphQuery(groups=groups, month_from="2024-02")).count() == 0
