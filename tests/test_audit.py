"""Input profiles, run reports, audits, exact quantiles and BM25 against plain versions."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from caseloom.functions import text as tx
from caseloom.operators import evaluation as ev
from caseloom.operators import inputs as ip
from caseloom.operators import profile as pf
from caseloom.operators import retrieval as rt
from caseloom.operators import runs as rn
from caseloom.plans.semantic_cases import SETTLED
from caseloom.plans.semantic_plans import _case_rows

META = "metadata struct<service_object_type:string,area_code_city:string,area_code_area:string,area_code_street:string,type1:string,type2:string,type3:string,call_month:string>"
ORDER = f"doc_id string, content_hash string, title_clean string, case_content_clean string, case_goal_clean string, address_detail_clean string, chunk_text string, {META}"


def _orders(spark, *texts):
    rows = [(f"d{i:02}", "h", None, t, "", "x" if i % 2 else None, t, (None, "", "", "", "噪音", "", f"t{i % 12}", "2024-01")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ORDER)


def _flags(spark, *texts):
    return {r.doc_id: r.challenge_flags for r in ip.descriptors(_orders(spark, *texts)).collect()}


def test_flags_of_texts(spark):
    got = _flags(spark, "人民路与解放街交叉口，请问如何办理？", "人民路12号一；二。三！", "", None, "路路")
    assert got["d00"] == ["consultation_question", "intersection_form", "road_form"]
    assert got["d01"] == ["address_detail_present", "doorplate_form", "multi_sentence_3plus", "road_form"]
    assert got["d02"] == [] and got["d03"] == ["address_detail_present"] and got["d04"] == []


def test_gaps_of_a_model_are_flags(spark):
    rows = _orders(spark, "积水", "积水").withColumn("model", F.struct((F.col("doc_id") == "d00").alias("repaired"), F.array(F.lit("semantic_gap:pois"), F.lit("other")).alias("warnings")))
    got = {r.doc_id: r.challenge_flags for r in ip.descriptors(rows, "model").collect()}
    assert got == {"d00": ["model_repair", "model_semantic_gap_pois"], "d01": ["address_detail_present", "model_semantic_gap_pois"]}


def test_rare_values(spark):
    rows = ip.with_rare(ip.descriptors(_orders(spark, *["a"] * 130)))
    got = {r.type3: "rare_type3" in r.challenge_flags for r in rows.collect()}
    assert got == {f"t{i}": i >= 10 for i in range(12)}  # t0 to t9 have 11 rows, t10 and t11 ten
    assert rows.count() == 130


def test_payload_variants(spark):
    row = _orders(spark, '一"二', "长" * 50 + "再次要求" + "长" * 50).select(*(c.alias(n) for n, c in ip.payloads(50).items())).collect()
    import json

    first = json.loads(row[0].current)
    assert first["case_content_clean"] == '一"二' and first["metadata_context"] == {"type1": "噪音", "type3": "t0", "call_month": "2024-01"}
    assert first["input_window_info"] == {"truncated": False, "original_chars": 3, "kept_chars": 3, "history_markers_present": [], "current_markers_present": []}
    assert "call_month" not in json.loads(row[0].without_time)["metadata_context"] and "metadata_context" not in json.loads(row[0].clean_fields_only)
    info = json.loads(row[1].current)["input_window_info"]
    assert info["truncated"] and info["original_chars"] == 104 and info["kept_chars"] == 50 and info["current_markers_present"] == ["再次要求"]
    assert row[0].current == json.dumps(first, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def test_input_profile_of_no_orders(spark):
    for name, rows in ip.input_profile(_orders(spark, "积水").limit(0)).items():
        got = rows.collect()
        assert all(r.n == 0 and r.rate == 0 for r in got) if name == "counts" else not got


def test_input_profile(spark):
    got = ip.input_profile(_orders(spark, "积水", "积水", "噪音" * 400))
    counts = {(r.section, r.key): (r.n, r.rate) for r in got["counts"].collect()}
    assert counts["field_presence", "case_content_clean"] == (3, 1.0) and counts["field_presence", "address_detail_clean"] == (1, 0.3333) and counts["proxy_counts", "content_over_600"] == (1, 0.3333)
    assert {r.variant: r.rows for r in got["payload_reuse"].collect()} == dict.fromkeys(ip.payloads(), 3)
    assert {r.category: (r.head_n, r.all_n) for r in got["head_drift"].collect()} == {"length:000-099": (2, 2), "length:600-1399": (1, 1)}


def test_order_by_length(spark):
    rows = ip.by_length(_orders(spark, "ccc", "a", None, "bbbbb", "a"), (1, 3))
    assert [(r.doc_id, r.bucket) for r in rows.collect()] == [("d02", 0), ("d01", 0), ("d04", 0), ("d00", 1), ("d03", 2)]


def test_json_keys(spark):
    row = spark.createDataFrame([(r'{"a": {"b" :[{"c":"x\": {\"prompt\":1}"}]},"d\\":"\\","evidence":"t:"}',)], "r string").select(rn.json_keys(F.col("r")).alias("k"), rn.leaked_keys(F.col("r")).alias("l")).first()
    assert row.k == ["a", "b", "c", "d\\\\", "evidence"] and row.l == ["evidence"]


EXPECTED = "records_written long, rejects_written long, report string, manifest_records long, orders_input long, scanned long, ignored_invalid long, manifest_sha256 string"


@pytest.mark.parametrize(
    ("expected", "failures"),
    [
        ((2, 1, "{}", None, None, None, None, None), []),
        ((None, None, "{}", 3, 3, 3, 0, "sha256:" + "a" * 64), []),
        ((3, 2, '{"prompt":1}', None, None, None, None, None), ["report_contains_sensitive_keys", "record_count_mismatch", "reject_count_mismatch"]),
        ((2, 1, "{}", 0, 4, 3, -1, None), ["identity_manifest_count_mismatch", "identity_manifest_scan_counts_invalid", "identity_manifest_hash_invalid", "identity_manifest_output_count_mismatch"]),
    ],
)
def test_run_check(spark, expected, failures):
    records = spark.createDataFrame([("a", "h", "1", "m", True), ("b", "h", "1", "m", False)], "doc_id string, content_hash string, prompt_version string, model string, repaired boolean")
    row = rn.run_check(records, records.limit(1), spark.createDataFrame([expected], EXPECTED)).first()
    assert (row.records, row.rejects, row.repair_attempts, row.failures) == (2, 1, 1, failures)
    twice = rn.run_check(records.union(records), records.limit(1), spark.createDataFrame([(4, 1, "{}", None, None, None, None, None)], EXPECTED)).first()
    assert twice.failures == ["duplicate_semantic_identity"] and twice.repeated_identities == 2


def test_replay_refuses_what_does_not_fit(spark):
    orders = _case_rows(spark, SETTLED[:1])
    stored = orders.select("doc_id", "content_hash", F.lit("primary").alias("phase"), F.lit(1).alias("ledger_sequence"), "response")
    for wrong, message in ((stored.withColumn("phase", F.lit("third")), "invalid_candidate_phase"), (stored.withColumn("ledger_sequence", F.lit(0)), "invalid_ledger_sequence"), (stored.withColumn("doc_id", F.lit("?")), "candidate_order_identity_mismatch")):
        with pytest.raises(ValueError, match=message):
            rn.replay(orders.drop("response"), wrong)
    assert rn.replay(orders.drop("response"), stored.limit(0)).count() == 0


def test_diagnostics_totals(spark):
    rows = spark.createDataFrame([(1, "model_result", True, 3, 4, 1.5), (3, "run_completed", None, 9, 9, 9.0), (2, "model_result", False, None, 1, 2.25)], "line int, event string, repair_requested boolean, input_tokens long, output_tokens long, latency_ms double")
    assert rn.diagnostics_totals(rows).first().asDict() == {"repair_requested": 1, "input_tokens": 3, "output_tokens": 5, "latency_ms": 3.75, "last_event": "run_completed"}
    assert rn.diagnostics_totals(rows.limit(0)).first().asDict() == {"repair_requested": 0, "input_tokens": 0, "output_tokens": 0, "latency_ms": 0.0, "last_event": ""}


def test_extraction_report(spark):
    from caseloom.semantic import parse as sp

    records = sp.read_responses(_case_rows(spark, SETTLED))
    row = rn.extraction_report(records, records.limit(0)).first()
    assert (row.records, row.rejects, row.coverage_roads, row.coverage_pois) == (8, 0, 0.375, 0.125)
    assert row.empty_entities == 0.5


def test_audit_counts(spark):
    sets = [spark.createDataFrame([("r", k) for k in keys], "role string, k int") for keys in ((1, 2, 3, 3), (2, 3, 4, 5), (3, 4, 6))]
    row = ev.ledger_audit(*sets, ["k"], ["role"]).first().asDict()
    raw, final, gold = {1, 2, 3}, {2, 3, 4, 5}, {3, 4, 6}
    want = {"raw_tp": raw & gold, "raw_fp": raw - gold, "raw_fn": gold - raw, "final_tp": final & gold, "final_fp": final - gold, "final_fn": gold - final}
    want |= {"correctly_kept": raw & final & gold, "incorrectly_kept": (raw & final) - gold, "correctly_removed": raw - final - gold, "wrongly_removed": (raw - final) & gold, "correct_additions": (final - raw) & gold, "incorrect_additions": final - raw - gold}
    assert row == {"role": "r"} | {k: len(v) for k, v in want.items()}


def test_exact_quantiles(spark):
    groups = {"a": [1.5, 2.0, 9.0, 4.0], "b": [7.0], "c": [1.0, 1.0, None, 3.0]}
    rows = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double").repartition(3)
    got = {r.g: (r.q1, r.q2) for r in pf.exact_quantiles(rows, "g", "v", (0.5, 0.9)).collect()}

    def plain(values, share):
        xs = sorted(v for v in values if v is not None)
        at = (len(xs) - 1) * share
        lo, hi = xs[math.floor(at)], xs[math.ceil(at)]
        return pytest.approx(lo + (hi - lo) * (at - math.floor(at)))

    assert got == {g: (plain(vs, 0.5), plain(vs, 0.9)) for g, vs in groups.items()}
    assert pf.exact_quantiles(rows.limit(0), "g", "v", (0.5,)).count() == 0


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_bm25_batch_against_a_plain_version(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(rt, "BROADCAST_ROWS", broadcast_rows)
    texts = {1: "a b a", 2: "b c", 3: None, 4: "", 5: "a a a c c", 6: "d"}
    asks = {10: "a c a", 11: "b", 12: "zzz"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = rt.bm25(docs, "doc_id", F.col("text"), spark.createDataFrame(list(asks.items()), "query_id long, query string"), F.col("doc_id") != 2)
    toks = {d: re.findall("[a-z]+", t or "") for d, t in texts.items()}
    mean = sum(map(len, toks.values())) / len(toks)
    want = {}
    for q, ask in asks.items():
        for d, ts in toks.items():
            hit = [t for t in set(ask.split()) if t in ts]
            if hit and d != 2:
                df = {t: sum(t in x for x in toks.values()) for t in hit}
                want[q, d] = pytest.approx(sum(math.log(1 + (len(toks) - df[t] + 0.5) / (df[t] + 0.5)) * ts.count(t) * 2.5 / (ts.count(t) + 1.5 * (0.25 + 0.75 * len(ts) / mean)) for t in hit), abs=1e-6)
    assert {(r.query_id, r.doc_id): r.score for r in rows.collect()} == want


def test_verbatim_json(spark):
    assert spark.range(1).select(tx.canonical_json({"b": tx.Verbatim(F.lit("[1]")), "a": F.lit("x")})).first()[0] == '{"a":"x","b":[1]}'


def test_flags_do_not_change_when_out_of_reach_text_is_left_out(spark):
    assert all(re.search(r"[^|一-鿿]", part) is None for name in ip.PROXIES if not name.endswith("_form") for part in ip.PROXIES[name])
    gap, digits = "lorem ipsum, " * 30, "7" * 60
    parts = ["人民路", "与", "解放街", "/", "ab路", "a" * 16 + "路", "路" + digits + "号", "未", "投", "诉", gap, "x" * 19, "x" * 41, "。", "；", " 　\n", "٣" * 45, "巷٣号"]
    rng = random.Random(5)
    said = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(400)]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "doc_id long, case_content_clean string").withColumns({f: F.lit("") for f in ip.FIELDS if f != "case_content_clean"})
    searched = ip.with_searched(rows)
    plain = {name: F.col("case_content_clean").rlike(p) for name, p in ip.PROXIES.items()}
    plain["multi_sentence_3plus"] = F.size(F.filter(F.split("case_content_clean", r"[。！？!?；;\n]+"), lambda x: x.rlike(r"(?U)\S"))) >= 3
    got = searched.select("case_content_clean", F.length("__searched").alias("n"), *(c.alias(n) for n, c in ip.proxies().items()), *(c.alias(f"p_{n}") for n, c in plain.items())).collect()
    assert [(r["case_content_clean"], n) for r in got for n in plain if r[n] != r[f"p_{n}"]] == []
    assert all(r["n"] < 500 for r in got if r["case_content_clean"] == gap * 2) and any(r["n"] < len(r["case_content_clean"]) for r in got)


def test_counted_redaction_skips_texts_without_a_match(spark):
    said = ["a@b.cn, c@d.org", "电话13812345678", "微信:abcdefg WeChat abcdefg", "nothing", None, "联系人：张三，13812345678", "姓名：李四", "١" * 20]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i int, x string")
    both = tx.redact(tx.redact(rows, "x", "plain"), "x", "counted", "hits")
    assert "> 0) THEN regexp_replace" in tx.redact(rows, "x", counts="hits")._jdf.queryExecution().optimizedPlan().toString()
    got = {r["i"]: r for r in both.collect()}
    assert all(r["plain"] == r["counted"] for r in got.values())
    hits = {i: {k: n for k, n in r["hits"].asDict().items() if n} for i, r in got.items()}
    assert hits == {0: {"email": 2}, 1: {"phone": 1}, 2: {"wechat": 2}, 3: {}, 4: {}, 5: {"contact_name": 1, "phone": 1}, 6: {"name": 1}, 7: {"long_number": 1}}


def test_mentions_lose_the_same_characters_as_by_the_plain_pattern(spark):
    from caseloom.operators import annotation as an

    every = spark.range(1, 0x3100).filter("id < 55296").select(F.concat(F.lit("aZ9街"), F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE")).alias("s"))
    plain = F.lower(F.regexp_replace("s", r"(?U)[\s\p{Punct}，。；：、！？（）《》“”‘’]+", ""))
    assert every.filter(an._said(F.struct(F.col("s").alias("surface"), F.col("s").alias("canonical"))) != plain).count() == 0
    assert "&&" in str(an._said(F.struct(F.lit("x").alias("surface"), F.lit("x").alias("canonical"))))


def _gold_rows(spark, *rows):
    mention = lambda s: [(s, s, "title_clean", s)] if s else []
    made = [(doc, None if doc is None else f"h{doc}", "ann", [("problem", "current", mention(o), mention(p), [], []) for o, p in issues]) for doc, issues in rows]
    from caseloom.operators import annotation as an

    return spark.createDataFrame(made, f"doc_id long, content_hash string, annotator string, issues {an.ISSUES}")


def test_ascii_mentions_are_not_searched_by_unicode_classes(spark):
    from caseloom.operators import annotation as an

    every = spark.range(1, 128).select(F.concat(F.lit("aZ9"), F.char(F.col("id")), F.lit("b")).alias("s"))
    said = an._said(F.struct(F.col("s").alias("surface"), F.col("s").alias("canonical")))
    plain = F.lower(F.regexp_replace("s", r"(?U)[\s\p{Punct}，。；：、！？（）《》“”‘’]+", ""))
    assert every.filter(said != plain).count() == 0
    assert "octet_length" in every.select(said)._jdf.queryExecution().optimizedPlan().toString()


def test_adjudication_deals_each_side_once(spark):
    from caseloom.operators import annotation as an

    rows = [(1, [("A-b", "x"), ("c", "y")]), (2, [("a", "x")]), (3, []), (None, [("n", "")])]
    left = _gold_rows(spark, *rows).groupBy("doc_id").agg(F.max("content_hash").alias("content_hash"), F.max("annotator").alias("annotator"), F.max("issues").alias("issues"))
    other = [(1, [("c", "y"), ("ab", "X")]), (2, [("a", "z")]), (3, []), (None, [("m", "")])]
    right = _gold_rows(spark, *other).groupBy("doc_id").agg(F.max("content_hash").alias("content_hash"), F.lit("bob").alias("annotator"), F.max("issues").alias("issues"))
    differs = an.differing(left, right)
    assert [r["doc_id"] for r in differs.collect()] == [r["doc_id"] for r in an.conflicts(an.compare(left, right)).collect()] == [2]
    fixed = differs.select(*an.IDENTITY, F.col("right").alias("issues"), F.lit("eve").alias("adjudicator"), F.lit("seen").alias("notes"))
    final = an.adjudicate(left, right, fixed, "eve")
    got = {r["doc_id"]: ([(i["objects"][0]["surface"], i["predicates"][0]["surface"] if i["predicates"] else "") for i in r["issues"]], r["notes"]) for r in final.collect()}
    agreed = "exact_double_annotation_agreement"
    assert got == {1: ([("A-b", "x"), ("c", "y")], agreed), 2: ([("a", "z")], "seen"), 3: ([], agreed), None: ([("n", "")], agreed)}
    plan = final._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 4  # each side where it is made, named twice; never again by identity

    for bad, code in (
        (fixed.filter("false"), "conflict_not_resolved"), (fixed.withColumns({"doc_id": F.lit(1), "content_hash": F.lit("h1")}).unionByName(fixed), "conflict_identity_sets_differ"),
        (fixed.withColumn("notes", F.lit(" ")), "conflict_resolution_missing_notes"), (fixed.withColumn("adjudicator", F.lit("bob2")), "conflict_adjudicator_mismatch"), (fixed.unionByName(fixed), "invalid_or_duplicate_identity"),
    ):
        with pytest.raises(Exception, match=code):
            an.adjudicate(left, right, bad, "eve").collect()
    with pytest.raises(Exception, match="annotation_identity_sets_differ"):
        an.adjudicate(left, right.filter("doc_id <> 3"), fixed, "eve").collect()
