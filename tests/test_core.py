"""Core engine: text functions, sources, graph, retrieval, evaluation, semantics, streaming."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from caseloom.functions import text as tx
from caseloom.operators import entities, evaluation, graph, profile, retrieval
from caseloom.plans import catalog
from caseloom.semantic import parse as sp
from caseloom.session import values
from caseloom.sources import records
from caseloom.streaming import ingest


def column(spark, items, expr):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string").orderBy("i").select(expr(F.col("x"))).collect()]


def test_clean_and_months(spark):
    assert column(spark, [None, " NULL ", "Null", "　a\t", "\\N", ""], tx.clean) == ["", "", "Null", "a", "", ""]
    assert column(spark, ["2024-03-05", "2024"], tx.month_of) == ["2024-03", ""]
    assert column(spark, ["a　 b"], tx.squeeze) == ["ab"]
    assert column(spark, ["xaxbx", "none"], lambda c: tx.rfind(c, "x")) == [4, -1]


def test_tokens(spark):
    got = column(spark, ["占道经营ABC12x", "路", "１２ ab", None, "aKb", "\U00020000中"], tx.tokens)
    assert got == [["占道", "道经", "经营", "abc", "12", "x"], ["路"], ["ab"], [], ["a", "b"], ["\U00020000中"]]


@pytest.mark.parametrize(
    ("raw", "clean", "kind"),
    [
        ("写信到 a.b@c-d.com.cn 吧", "写信到 [邮箱] 吧", "email"),
        ("联系人：王小明，在家", "联系人：[姓名]，在家", "contact_name"),
        ("联系人王小明13812345678", "联系人[姓名][手机号]", "contact_name"),
        ("座机: 0519-88881234。", "座机: [座机]。", "landline"),
        ("qq：12345678", "qq：[QQ号]", "qq"),
        ("微信号 abc_12345", "微信号 [微信号]", "wechat"),
        ("call 13812345678 now", "call [手机号] now", "phone"),
        ("单号 AB1234567890X", "单号 [业务编号]", "alnum_id"),
        ("证 32040419900101123X", "证 [身份证号]", "id_card"),
        ("长 123456789012345678901", "长 [长数字编号]", "long_number"),
        ("编号 20240305123456", "编号 [数字编号]", "numeric_id"),
        ("姓名：张三丰 来", "姓名：[姓名] 来", "name"),
    ],
)
def test_redaction(spark, raw, clean, kind):
    row = tx.redact(spark.createDataFrame([(raw,)], "t string"), "t", counts="n").first()
    assert row.t == clean and row.n[kind] == 1


def test_canonical_json(spark):
    text = 'q"\\\n\t\x01\x1f路'
    got = column(spark, [text], lambda c: tx.canonical_json({"b": c, "a": {"z": F.lit(""), "y": c}}))[0]
    assert got == json.dumps({"b": text, "a": {"z": "", "y": text}}, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def test_labelled_field(spark):
    text = "标题：t\n诉求内容：line 1\nline 2\n诉求目标：g"
    assert column(spark, [text], lambda c: tx.labelled_field(c, "诉求内容：", ["标题：", "诉求目标："])) == ["line 1\nline 2"]


def test_tsv_to_documents(spark, tmp_path):
    head = ["id", "order_id", "title", "case_content", "case_goal", "area_code_area", "call_time"]
    rows = [["1", "", "", "摊贩 电话 13812345678", "希望处理", "武进区", "2024-03-05 10:00"], ["2", "", "NULL", "", "", "x", ""], ["3", "short"], ["4", "", "t", "has \\t mark", "", "", "2024"], ["5"] + ["x"] * 8]
    (tmp_path / "in.tsv").write_text("\n".join("\t".join(r) for r in [head, *rows]) + "\n", "utf-8")
    report = records.export_documents(spark, str(tmp_path / "in.tsv"), str(tmp_path / "out")).first()
    assert (report.rows, report.bad_field_count, report.exported, report.empty, report.polluted) == (5, 2, 1, 1, 1)
    assert report.redactions.phone == 1
    docs = records.read_json_lines(spark, str(tmp_path / "out"))
    row = docs.first()
    assert row.doc_id.startswith("order_") and row.doc_id[6:].isalpha()
    assert row.case_content_clean == "摊贩 电话 [手机号]" and row.metadata.call_month == "2024-03"
    check = records.check_documents(docs).first()
    assert (check.rows, check.wrong_hashes, check.repeated_ids) == (1, 0, 0)
    assert records.safety_report(docs).first().safe


def test_json_lines_errors(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"doc_id":"d1","text":"x"}\n\n[1]\n{bad\n{"text":"y"}\n', "utf-8")
    rows = records.read_json_lines(spark, str(tmp_path / "a.jsonl")).select("doc_id", "_error", "display_text").collect()
    assert [(r.doc_id, r._error, r.display_text) for r in rows] == [("d1", None, "x"), ("line_3", "record_not_object", ""), ("line_4", "invalid_json", ""), ("line_5", None, "y")]


def test_entities(spark):
    text = "武进区湖塘镇人民路和平安路交叉口有流动摊贩占道经营，靠近金色小区"
    rows = spark.createDataFrame([("d", text, "武进区", "2024-01")], "doc_id string, case_content_clean string, area_code_area string, call_month string")
    got = {(r.entity_type, r.entity_value, r.source_field) for r in entities.extract_links(rows).collect()}
    want = {("time_month", "2024-01", "call_month"), ("area", "武进区", "area_code_area"), ("area", "武进区", "case_content_clean"), ("problem_object", "流动摊贩", "case_content_clean"), ("problem_object", "摊贩", "case_content_clean"), ("problem_behavior", "占道经营", "case_content_clean"), ("intersection", "人民路和平安路交叉口", "case_content_clean"), ("road", "人民路", "case_content_clean"), ("road", "平安路", "case_content_clean"), ("street", "湖塘镇", "case_content_clean")}
    assert want <= got


def test_candidates(spark):
    rows = [("road", "路", "0.9", "路"), ("problem_object", "路边摊", "0.9", "路边摊"), ("car", "x", "1", "x"), ("poi", "金色小区", "many", "金色小区"), ("poi", "金色小区", "0.9", "别处"), ("area", " ", "1", "")]
    df = spark.createDataFrame(rows, "kind string, value string, conf string, evidence string")
    got = [r[0] for r in df.select(entities.candidate_verdict(F.col("kind"), F.col("value"), F.col("conf"), F.col("evidence"), F.lit("路边摊在路上，金色小区")).alias("v")).collect()]
    assert got == ["generic_entity_value", "ok", "unsupported_entity_type", "low_confidence", "missing_evidence_span", "empty_entity_value"]


def graph_tables(spark):
    rows = [("e1", "problem_object", "摊贩"), ("e1", "problem_behavior", "摆摊"), ("e1", "road", "人民路"), ("e2", "road", "人民路"), ("e2", "problem_object", "摊贩"), ("e3", "road", "和平路")]
    links = spark.createDataFrame([(e, e, f"{k}:{v}", k, v, v, 0.5) for e, k, v in rows], "event_id string, doc_id string, entity_id string, entity_type string, entity_value string, normalized_value string, confidence double")
    return links, spark.createDataFrame([("e1", "e1", "2024-01"), ("e2", "e2", "2024-02"), ("e3", "e3", "2024-03")], "event_id string, doc_id string, event_month string")


def test_graph_query(spark):
    links, events = graph_tables(spark)
    q = graph.GraphQuery(groups=(("problem_object", ("摊 贩",)), ("problem_behavior", ("摆摊",))), frontier=("road",))
    rows = graph.query_graph(links, events, q).orderBy("rank").collect()
    assert [(r.event_id, r.match_stage, r.score) for r in rows] == [("e1", "seed_entity", 21.0), ("e2", "one_hop_expansion", -1.5)]
    empty_group = graph.GraphQuery(groups=(("problem_object", ("摊贩",)), ("road", ())))
    assert graph.seeds(links, events, empty_group).count() == 0
    either = graph.GraphQuery(groups=empty_group.groups, operator="OR", month_from="2024-02")
    assert [r.event_id for r in graph.seeds(links, events, either).collect()] == ["e2"]
    with pytest.raises(ValueError, match="invalid_frontier_entity_types:colour"):
        graph.GraphQuery(groups=(), frontier=("colour",))


def test_graph_discourse(spark):
    links, events = graph_tables(spark)
    talk = spark.createDataFrame([("e1", '["投诉"]', "dissatisfied", "high"), ("e2", "", "unknown", "normal")], "event_id string, inferred_intents_json string, satisfaction string, urgency string")
    q = graph.GraphQuery(groups=(("problem_object", ("摊贩",)),), intent="投诉", urgency=("high", "critical"))
    assert [r.event_id for r in graph.seeds(links, events, q, talk).collect()] == ["e1"]


def test_retrieval_plans(spark):
    docs = spark.createDataFrame([(1, "摊贩 占道 摊贩"), (2, "摊贩"), (3, "道路")], "doc_id int, text string")
    scored = retrieval.bm25(docs, "doc_id", F.col("text"), values(spark, [(0, "摊贩占道")], "query_id", "query"))
    best = retrieval.top_k(scored, 2)
    assert [r.doc_id for r in best.collect()] == [1, 2]
    assert "TakeOrderedAndProject" in best._jdf.queryExecution().toString()
    vectors = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [0.0, 0.0], "b"), (3, [1.0, 1.0], "a")], "id int, v array<float>, label string")
    rows = retrieval.top_k(retrieval.cosine(vectors, "id", "v", [1.0, 0.0]), 3).collect()
    assert [(r.doc_id, r.score) for r in rows] == [(1, 1.0), (3, 0.707107), (2, 0.0)]


def test_profile_and_sampling(spark):
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") < 70, "a").when(F.col("id") < 95, "b").otherwise("c").alias("s"))
    take = lambda: profile.stratified(df, ["s"], 10, profile.hash_rank("x", F.col("id")), "id").select("id", "s").collect()
    assert sorted(take()) == sorted(take())
    counts = {s: sum(r.s == s for r in take()) for s in "abc"}
    assert sum(counts.values()) == 10 and counts["a"] == 7
    flags = F.array_compact(F.array(F.when(F.col("id") % 2 == 0, "even"), F.when(F.col("id") % 3 == 0, "three")))
    assert len({r.id for r in profile.round_robin(df, "id", flags, F.lpad(F.col("id").cast("string"), 3, "0"), 7).collect()}) == 7
    text = "h" * 300 + "NOW" + "c" * 300 + "t" * 300
    row = spark.createDataFrame([(text,), ("short",)], "x string").select(profile.content_window(F.col("x"), ("NOW",), 100)).collect()
    assert row[0][0] == "h" * 30 + "h" * 13 + "NOW" + "c" * 24 + "t" * 30 and row[1][0] == "short"
    edge = spark.createDataFrame([("x" * 60 + "NOW" + "y" * 60,), ("z" * 200,)], "x string").select(profile.content_window(F.col("x"), ("NOW",), 100)).collect()
    assert edge[0][0] == "x" * 30 + "x" * 13 + "NOW" + "y" * 24 + "y" * 30 and edge[1][0] == "z" * 100


def test_evaluation(spark):
    gold = values(spark, [(1, "a"), (1, "b"), (2, "a")], "d", "role")
    guess = values(spark, [(1, "a"), (2, "b")], "d", "role")
    rows = {r.role: (r.tp, r.fp, r.fn, r.f1) for r in evaluation.prf(gold, guess, ["d"], ["role"]).collect()}
    assert rows == {"a": (1, 0, 1, 0.6667), "b": (0, 1, 1, 0.0)}
    ranked = values(spark, [(0, "x", 1), (0, "y", 2)], "query_id", "doc_id", "rank")
    qrels = values(spark, [(0, "y", 2), (0, "z", 1), (1, "q", 1)], "query_id", "doc_id", "grade")
    got = {r.query_id: r for r in evaluation.ir_metrics(ranked, qrels, 2).collect()}
    assert (got[0].p_at_k, got[0].r_at_k, got[0].mrr) == (0.5, 0.5, 0.5) and got[1].mrr == 0.0


@pytest.mark.parametrize(
    ("text", "note"),
    [
        ('{"event_summary":"s"}', []),
        ('```json\n{"event_summary":"s",}\n```', ["json_recovered_trailing_comma"]),
        ('{"event_summary":"s\n"}', ["json_recovered_control_character"]),
        ("{'event_summary': 's', 'x': None}", ["json_recovered_python_literal"]),
        ('before {"event_summary":"s"} after {"event_summary":"t"}', []),
    ],
)
def test_json_recovery(text, note):
    found, notes = sp.parse_response(text)
    assert found["event_summary"] == "s" and notes == note


@pytest.mark.parametrize("text", ['{"a": {"event_summary":"s"}', "", None, "[1]", '{"a": NaN}'])
def test_json_refused(text):
    assert sp.parse_response(text)[1] == ["json_parse_failed"]


def test_two_phase_extraction(spark):
    good = '{"event_summary":"s","entities":{"roads":[{"surface":"人民路","canonical":"人民路","source_field":"case_content_clean","evidence":"人民路"}]},"discourse":{"intents":[{"label":"投诉","evidence":"投诉"}]}}'
    orders = spark.createDataFrame([(f"d{i}", f"h{i}", "市民投诉，在人民路", "", "", "") for i in range(4)], "doc_id string, content_hash string, case_content_clean string, title_clean string, case_goal_clean string, address_detail_clean string")

    def fake(frame, phase):
        bad = F.col("doc_id").isin("d1", "d2") if phase == "primary" else F.col("doc_id") == "d2"
        return frame.withColumn("response", F.when(bad, "no json").otherwise(good))

    done = spark.createDataFrame([("d3", "h3")], "doc_id string, content_hash string")
    rows = sp.extract(orders, fake, done)
    assert {r.doc_id: r.status for r in rows.collect()} == {"d0": "accepted", "d1": "accepted", "d2": "rejected"}
    assert sp.project_links(rows).count() == 2
    assert {r.doc_id: r.inferred_intents_json for r in sp.project_discourse(rows).collect()}["d0"] == '["投诉"]'


def test_streaming_append(spark, tmp_path):
    schema = "doc_id string, text string"
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    from pyspark.sql.types import _parse_datatype_string

    for k, lines in enumerate(['{"doc_id":"a","text":"13812345678"}\n{"doc_id":"a","text":"13812345678"}\n', '{"doc_id":"a","text":"13812345678"}\n{"doc_id":"b","text":"x"}\n']):
        (src / f"{k}.json").write_text(lines, "utf-8")
        stream = ingest.redacted_stream(spark, str(src), _parse_datatype_string(schema), "text")
        ingest.append_new(stream, ["doc_id", "content_hash"], str(out), f"ck-{tmp_path.name}").awaitTermination()
    assert sorted((r.doc_id, r.text) for r in spark.read.parquet(str(out)).collect()) == [("a", "[手机号]"), ("b", "x")]


def test_catalogue_is_whole():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert entry.FLAGSHIP in catalog.queries()
    assert set(catalog.queries()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_views(spark):
    from caseloom.functions import view

    meta = "struct<service_object_type:string,area_code_city:string,area_code_area:string,area_code_street:string,type1:string,type2:string,type3:string,call_month:string>"
    row = spark.createDataFrame([("d", 1.0, "a\n 13812345678 " + "b" * 300, ("x", "", "武进区", None, "t1", "", "", "2024-01"))], f"doc_id string, score double, text string, metadata {meta}")
    got = view.safe_payload(row).first()
    assert got.snippet.startswith("a [手机号] bbb") and len(got.snippet) == 220 and got.snippet.endswith("...")
    assert got.metadata == {"service_object_type": "x", "area_code_area": "武进区", "type1": "t1", "call_month": "2024-01"}
    assert row.select(view.metadata_summary()).first()[0] == "武进区 | t1 | 2024-01"
    texts = [(" given ", "x"), (None, "标题：t\n 诉求内容：c\n诉求目标：g"), ("", " all ")]
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "i int, e string, t string").orderBy("i")
    assert [r[0] for r in rows.select(view.embedding_text(F.col("e"), F.col("t"))).collect()] == ["given", "诉求内容：c\n诉求目标：g", "all"]
