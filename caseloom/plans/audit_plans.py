"""Queries that audit inputs, runs and judgements."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.functions import view as vw
from caseloom.operators import evaluation as ev
from caseloom.operators import inputs as ip
from caseloom.operators import runs as rn
from caseloom.plans.base import register
from caseloom.plans.semantic_cases import SETTLED
from caseloom.plans.semantic_plans import _case_rows
from caseloom.plans.text_plans import prf_sql
from caseloom.session import numbered, table, values

#: Sentences put before each document's text by turns, so that every flag is met.
SAID = (
    "", "部门答复已处理，其不认可。", "投诉人民路12号！", "请问如何办理？是否收费？", "希望尽快维修", "人民路与解放街交叉口积水", "万达广场噪音；", "非常气愤，再次要求处理结果",
    "燃气泄漏，人身安全", "仍未解决。一；二；三", "没有路灯",
)
_ORDERS = "orders AS (SELECT doc_id, [" + ", ".join(f"'{s}'" for s in SAID) + f"][1 + doc_id % {len(SAID)}] || coalesce(text, '') AS x, CASE WHEN doc_id % 5 = 0 THEN coalesce(source, '') ELSE '' END AS address, coalesce(lang, '') AS type1, coalesce(source, '') AS type2, '2024-0' || (1 + doc_id % 3) AS month, 'w' || (doc_id % 150) AS type3 FROM documents)"


def _orders(spark, d):
    """Documents as orders; some have an address."""
    docs = table(spark, d, "documents")
    turn = F.pmod(F.col("doc_id"), F.lit(len(SAID))).cast("int")
    said = F.concat(F.element_at(F.array(*map(F.lit, SAID)), turn + 1), F.coalesce("text", F.lit("")))
    metadata = {"type1": F.coalesce("lang", F.lit("")), "type2": F.coalesce("source", F.lit("")), "type3": F.concat(F.lit("w"), (F.col("doc_id") % 150).cast("string")), "call_month": F.concat(F.lit("2024-0"), (F.col("doc_id") % 3 + 1).cast("string"))}
    blank = {m: F.lit("") for m in (*vw.SAFE_FIELDS, "service_object_type") if m not in metadata}
    meta = F.struct(*(c.alias(m) for m, c in (metadata | blank).items())).alias("metadata")
    address = F.when(F.col("doc_id") % 5 == 0, F.coalesce("source", F.lit(""))).otherwise("").alias("address_detail_clean")
    return docs.select("doc_id", F.lit("h").alias("content_hash"), F.lit("").alias("title_clean"), said.alias("case_content_clean"), F.lit("").alias("case_goal_clean"), address, said.alias("chunk_text"), meta)


_JOINED = "concat_ws(chr(10), nullif(x, ''), nullif(address, ''))"
_FLAG_SQL = {name: f"regexp_matches({_JOINED}, '{pattern}')" for name, pattern in ip.PROXIES.items()}
_FLAG_SQL["multi_sentence_3plus"] = r"len(list_filter(regexp_split_to_array(x, '[。！？!?；;\n]+'), lambda p: regexp_matches(p, '[^\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]'))) >= 3"


@register("input_descriptors", f"WITH {_ORDERS} SELECT doc_id, type1, CASE WHEN type2 = '' THEN '<EMPTY>' ELSE type2 END AS type2, array_to_string(list_sort(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in (_FLAG_SQL | {"address_detail_present": "address <> ''", "rare_type3": "count(*) OVER (PARTITION BY type3) <= 10"}).items()) + "], lambda f: f IS NOT NULL)), ',') AS flags FROM orders")
def input_descriptors(spark, d):
    found = ip.with_rare(ip.descriptors(_orders(spark, d)))
    return found.select("doc_id", "type1", "type2", F.array_join("challenge_flags", ",").alias("flags"))


_COUNTED = {("field_presence", "title_clean"): "false", ("field_presence", "case_content_clean"): "x <> ''", ("field_presence", "case_goal_clean"): "false", ("field_presence", "address_detail_clean"): "address <> ''"}
_COUNTED |= {("proxy_counts", n): c for n, c in (_FLAG_SQL | {"content_over_600": "length(x) > 600", "content_over_1400": "length(x) > 1400", "content_over_input_limit": "length(x) > 2200"}).items()}


@register("input_counts", f"WITH {_ORDERS}, " + "c AS (" + " UNION ALL ".join(f"SELECT '{s}' AS section, '{k}' AS key, count(*) FILTER (WHERE {c}) AS n, count(*) AS total FROM orders" for (s, k), c in _COUNTED.items()) + ") SELECT section, key, n, round(n::DOUBLE / total, 4) AS rate FROM c")
def input_counts(spark, d):
    return ip.input_counts(_orders(spark, d))


_BUDGET = 100_000_000


def _present(markers) -> str:
    return "'[' || array_to_string(list_filter([" + ", ".join(f"CASE WHEN contains(x, '{m}') THEN '\"{m}\"' END" for m in markers) + "], lambda m: m IS NOT NULL), ',') || ']'"


def _payload(metadata: str) -> str:
    info = f"""'{{"current_markers_present":' || {_present(vw.CURRENT_MARKERS)} || ',"history_markers_present":' || {_present(ip.HISTORY_MARKERS)} || ',"kept_chars":' || length(x) || ',"original_chars":' || length(x) || ',"truncated":false}}'"""
    return f"""'{{"address_detail_clean":' || to_json(address) || ',"case_content_clean":' || to_json(x) || ',"case_goal_clean":"","input_window_info":' || {info} || {metadata} || ',"title_clean":""}}'"""


def _shown(*names: str) -> str:
    cells = {"call_month": "month", "type1": "type1", "type2": "type2", "type3": "type3"}
    return "',\"metadata_context\":{' || concat_ws(',', " + ", ".join(f"""CASE WHEN {cells[n]} <> '' THEN '"{n}":' || to_json({cells[n]}) END""" for n in names) + ") || '}'"


_VARIANTS = {"current": _shown("call_month", "type1", "type2", "type3"), "without_time": _shown("type1", "type2", "type3"), "semantic_metadata_only": _shown("type1", "type2", "type3"), "clean_fields_only": "''"}


@register("input_payload_reuse", f"WITH {_ORDERS}, p AS (" + " UNION ALL ".join(f"SELECT '{v}' AS variant, {_payload(m)} AS p FROM orders" for v, m in _VARIANTS.items()) + """), g AS (SELECT variant, p, count(*) AS n FROM p GROUP BY 1, 2),
r AS (SELECT variant, sum(n)::BIGINT AS rows, count(*) AS distinct_payloads, count(*) FILTER (WHERE n > 1) AS dup_groups, max(n) AS largest FROM g GROUP BY 1),
l AS (SELECT variant, min(length(p)) AS lo, max(length(p)) AS hi, round(quantile_cont(length(p), 0.5), 1) AS p50, round(avg(length(p)), 1) AS mean FROM p GROUP BY 1)
SELECT variant, rows, distinct_payloads, rows - distinct_payloads AS beyond_first, round((rows - distinct_payloads)::DOUBLE / rows, 4) AS rate, dup_groups, largest, lo, hi, p50, mean FROM r JOIN l USING (variant)""")
def input_payload_reuse(spark, d):
    """The budget is beyond any text here; ``content_window`` has its own query."""
    rows = ip.payload_report(_orders(spark, d), _BUDGET)
    return rows.select("variant", "rows", "distinct_payloads", "beyond_first", "rate", "dup_groups", "largest", "lo", "hi", "p50", "mean")


@register("length_bucket_order", f"WITH {_ORDERS} SELECT doc_id, CASE WHEN length(x) <= 200 THEN 0 WHEN length(x) <= 800 THEN 1 ELSE 2 END AS bucket, row_number() OVER (ORDER BY length(x), doc_id) AS nth FROM orders")
def length_bucket_order(spark, d):
    """Buckets of rising lengths; the place in the whole order is counted from the ranged partitions."""
    rows = ip.by_length(_orders(spark, d).select("doc_id", "chunk_text"), (200, 800)).select("doc_id", "bucket", "chars")
    return numbered(rows, "nth", F.col("bucket"), F.col("chars"), F.col("doc_id")).select("doc_id", "bucket", "nth")


def _line_links(spark, d):
    value = F.concat_ws("-", "l_partkey", "l_linenumber").alias("entity_value")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_returnflag").alias("entity_type"), F.concat(F.lit("line"), F.col("l_linenumber").cast("string")).alias("source_channel"), value)


_LINKS = "links AS (SELECT l_orderkey AS doc_id, l_returnflag AS entity_type, 'line' || l_linenumber AS source_channel, l_partkey || '-' || l_linenumber AS entity_value FROM lineitem)"


@register("entity_samples", f"""WITH {_LINKS}, s AS (SELECT *, row_number() OVER (PARTITION BY entity_type, source_channel ORDER BY doc_id, entity_value) AS nth FROM links QUALIFY nth <= 12),
t AS (SELECT * FROM s ORDER BY entity_type, source_channel, nth LIMIT 200) SELECT doc_id, entity_type, source_channel, entity_value, nth, o_orderpriority AS case_content_clean FROM t LEFT JOIN orders ON o_orderkey = doc_id""")
def entity_samples(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderpriority").alias("case_content_clean"), F.lit("").alias("address_detail_clean"))
    rows = ip.entity_samples(_line_links(spark, d), orders)
    return rows.select("doc_id", "entity_type", "source_channel", "entity_value", F.col("nth").cast("long").alias("nth"), "case_content_clean")


@register("strata_counts", f"WITH {_LINKS} SELECT entity_type, source_channel, count(*) AS n FROM links GROUP BY ALL")
def strata_counts(spark, d):
    return ip.strata_counts(_line_links(spark, d))


# ----------------------------------------------------------- judgements
def _roles_sql(q: int, t: int) -> str:
    flip = lambda c, n: f"CASE WHEN doc_id % {n} = 0 THEN 1 - {c} ELSE {c} END" if n else c
    return f"SELECT doc_id, 'quality' AS role FROM labels WHERE {flip('quality', q)} = 1 UNION SELECT doc_id, 'toxic' FROM labels WHERE {flip('toxic', t)} = 1"


def _roles(spark, d, q: int, t: int):
    flip = lambda c, n: F.when(F.col("doc_id") % n == 0, 1 - F.col(c)).otherwise(F.col(c)) if n else F.col(c)
    marks = F.array_compact(F.array(F.when(flip("quality", q) == 1, "quality"), F.when(flip("toxic", t) == 1, "toxic")))
    return table(spark, d, "labels").select("doc_id", F.explode(marks).alias("role"))


_AUDIT = {
    "raw_tp": "r AND g", "raw_fp": "r AND NOT g", "raw_fn": "NOT r AND g", "final_tp": "f AND g", "final_fp": "f AND NOT g", "final_fn": "NOT f AND g",
    "correctly_kept": "r AND f AND g", "incorrectly_kept": "r AND f AND NOT g", "correctly_removed": "r AND NOT f AND NOT g", "wrongly_removed": "r AND NOT f AND g",
    "correct_additions": "NOT r AND f AND g", "incorrect_additions": "NOT r AND f AND NOT g",
}


@register("ledger_audit", f"""WITH raw AS ({_roles_sql(7, 11)}), fin AS ({_roles_sql(21, 5)}), gold AS ({_roles_sql(0, 0)}),
j AS (SELECT doc_id, role, raw.k IS NOT NULL AS r, fin.k IS NOT NULL AS f, gold.k IS NOT NULL AS g FROM (SELECT *, 1 AS k FROM raw) raw FULL JOIN (SELECT *, 1 AS k FROM fin) fin USING (doc_id, role) FULL JOIN (SELECT *, 1 AS k FROM gold) gold USING (doc_id, role))
SELECT role, """ + ", ".join(f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in _AUDIT.items()) + " FROM j GROUP BY role")
def ledger_audit(spark, d):
    return ev.ledger_audit(_roles(spark, d, 7, 11), _roles(spark, d, 21, 5), _roles(spark, d, 0, 0), ["doc_id"], ["role"])


@register("status_transitions", """WITH a AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'accepted' ELSE 'repair_required' END AS s FROM labels WHERE doc_id % 3 > 0), b AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'rejected' ELSE 'accepted' END AS s FROM labels WHERE doc_id % 4 > 0)
SELECT coalesce(a.s, 'missing') AS before, coalesce(b.s, 'missing') AS after, count(*) AS n FROM a FULL JOIN b USING (doc_id) GROUP BY 1, 2""")
def status_transitions(spark, d):
    rows = table(spark, d, "labels")
    before = rows.filter("doc_id % 3 > 0").select("doc_id", F.when(F.col("quality") == 1, "accepted").otherwise("repair_required").alias("status"))
    after = rows.filter("doc_id % 4 > 0").select("doc_id", F.when(F.col("toxic") == 1, "rejected").otherwise("accepted").alias("status"))
    return ev.status_transitions(before, after, ["doc_id"])


_ROLE = "['problem_behavior', 'problem_object', 'road'][1 + l_linenumber % 3]"
_MEMBER = f"(SELECT DISTINCT l_orderkey AS grp, {_ROLE} AS role, l_suppkey AS v FROM lineitem WHERE {{keep}})"
_PAIR = f"SELECT a.grp, a.role AS lo_role, a.v AS lo, b.role AS hi_role, b.v AS hi FROM {_MEMBER} a JOIN {_MEMBER} b ON a.grp = b.grp AND (a.role, a.v) < (b.role, b.v)"
_KINDS = "SELECT *, unnest(list_filter(['issue_co_membership', CASE WHEN lo_role <> hi_role AND 'road' NOT IN (lo_role, hi_role) THEN 'object_behavior_attachment' END, CASE WHEN lo_role <> hi_role AND 'road' IN (lo_role, hi_role) THEN 'location_attachment' END], lambda k: k IS NOT NULL)) AS kind FROM ({p})"


@register("comembership_scores", f"SELECT *, round(CASE WHEN tp + fp > 0 THEN fp::DOUBLE / (tp + fp) ELSE 0 END, 4) AS false_rate FROM ({prf_sql(_KINDS.format(p=_PAIR.format(keep='l_linenumber <> 2')), _KINDS.format(p=_PAIR.format(keep='l_linenumber <> 3')), 'grp, lo_role, lo, hi_role, hi', 'kind')})")
def comembership_scores(spark, d):
    role = F.element_at(F.array(*map(F.lit, ("problem_behavior", "problem_object", "road"))), (F.col("l_linenumber") % 3 + 1).cast("int"))
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", role.alias("role"), F.col("l_suppkey").alias("v"))
    return ev.comembership(line.filter("l_linenumber <> 2"), line.filter("l_linenumber <> 3"), "l_orderkey")


def _talk(rows, q: int, t: int):
    """Labels as statements: quality is an intent, toxicity an emotion; ``q`` and ``t`` spoil some evidence and levels."""
    off = lambda n: F.col("doc_id") % n == 0
    say = lambda label, evidence, strength: F.struct(label.alias("label"), evidence.alias("evidence"), strength.cast("int").alias("intensity"))
    none = F.array().cast("array<struct<label:string,evidence:string,intensity:int>>")
    intent = F.when(F.col("quality") == 1, F.array(say(F.lit("投诉"), F.when(off(q), "b").otherwise("a"), F.lit(None)))).otherwise(none)
    mood = F.when(F.col("toxic") == 1, F.array(say(F.when(off(t), "不满").otherwise("愤怒"), F.lit("c"), F.when(off(q), 2).otherwise(1)))).otherwise(none)
    kept = F.struct(F.when(off(t), "mixed").alias("label"), F.lit("").alias("target"), F.lit(None).cast("string").alias("evidence"))
    haste = F.struct(F.when(off(q), "high").otherwise("normal").alias("level"), F.lit("").alias("evidence"))
    return rows.select("doc_id", intent.alias("intents"), mood.alias("emotions"), kept.alias("satisfaction"), haste.alias("urgency"))


def _talk_sql(q: int, t: int) -> str:
    return f"""SELECT doc_id, 'intent_labels' AS measure, '投诉' AS said FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 'intent_grounded', CASE WHEN doc_id % {q} = 0 THEN 'b' ELSE 'a' END FROM labels WHERE quality = 1
 UNION ALL SELECT doc_id, 'emotion_labels', CASE WHEN doc_id % {t} = 0 THEN '不满' ELSE '愤怒' END FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, 'emotion_grounded', CASE WHEN doc_id % {t} = 0 THEN '不满' ELSE '愤怒' END || CASE WHEN doc_id % {q} = 0 THEN 2 ELSE 1 END FROM labels WHERE toxic = 1
 UNION ALL SELECT doc_id, 'satisfaction_exact', CASE WHEN doc_id % {t} = 0 THEN 'mixed' ELSE 'unknown' END FROM labels UNION ALL SELECT doc_id, 'urgency_exact', CASE WHEN doc_id % {q} = 0 THEN 'high' ELSE 'normal' END FROM labels"""


@register("discourse_scores", f"""WITH s AS ({prf_sql(_talk_sql(5, 3), _talk_sql(7, 4), 'doc_id, said', 'measure')}), e AS (SELECT *, measure LIKE '%exact' AS x, round(tp::DOUBLE / nullif(tp + fn, 0), 4) AS share FROM s)
SELECT measure, tp, CASE WHEN x THEN 0 ELSE fp END AS fp, fn, CASE WHEN x THEN share ELSE precision END AS precision, CASE WHEN x THEN share ELSE recall END AS recall, CASE WHEN x THEN share ELSE f1 END AS f1 FROM e""")
def discourse_scores(spark, d):
    rows = table(spark, d, "labels")
    return ev.discourse_scores(_talk(rows, 5, 3), _talk(rows, 7, 4))


# ----------------------------------------------------------------- runs
@register("report_keys", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'evidence,lang,meta,text' ELSE 'lang,meta,text' END AS keys, CASE WHEN doc_id % 2 = 0 THEN 'evidence' ELSE '' END AS leaked FROM documents")
def report_keys(spark, d):
    """Texts with quoted look-alikes of keys inside; only true keys are found."""
    said = F.concat(F.lit('"prompt": {"chunk_text":1}'), F.coalesce("text", F.lit("")), F.lit('\\": \\'))
    meta = F.struct(F.when(F.col("doc_id") % 2 == 0, 1).alias("evidence"), said.alias("text"))
    report = F.to_json(F.struct(F.coalesce("lang", F.lit("")).alias("lang"), F.array(meta).alias("meta")))
    rows = table(spark, d, "documents").select("doc_id", report.alias("r"))
    return rows.select("doc_id", F.array_join(rn.json_keys(F.col("r")), ",").alias("keys"), F.array_join(rn.leaked_keys(F.col("r")), ",").alias("leaked"))


@register("run_check", "SELECT count(*) AS records, count(*) FILTER (WHERE toxic = 1) AS rejects, count(*) FILTER (WHERE quality = 1) AS repair_attempts, 0::BIGINT AS repeated_identities, 'report_contains_sensitive_keys,record_count_mismatch,identity_manifest_hash_invalid' || CASE WHEN count(*) + count(*) FILTER (WHERE toxic = 1) <> 5 THEN ',identity_manifest_output_count_mismatch' ELSE '' END AS failures FROM labels")
def run_check(spark, d):
    rows = table(spark, d, "labels")
    records = rows.select("doc_id", F.lit("h").alias("content_hash"), F.lit("1").alias("prompt_version"), F.lit("m").alias("model"), (F.col("quality") == 1).alias("repaired"))
    stated = values(spark, [(-1, '{"a":[{"evidence":1}]}', 5, 5, 7, 0, "sha256:x")], "records_written", "report", "manifest_records", "orders_input", "scanned", "ignored_invalid", "manifest_sha256").withColumn("rejects_written", F.lit(None).cast("long"))
    return rn.run_check(records, rows.filter("toxic = 1"), stated).withColumn("failures", F.array_join("failures", ","))


_PHASE = "CASE WHEN user_id % 2 = 0 THEN 'primary' ELSE 'repair' END"
_KIND = "['model_result', 'batch_memory', 'run_failed'][1 + event_id % 3]"


@register("run_diagnostics", f"""WITH e AS (SELECT *, {_KIND} AS kind, {_PHASE} AS phase FROM events)
SELECT 'event' AS section, kind AS key, count(*) AS n FROM e GROUP BY 2 UNION ALL SELECT 'phase', phase, count(*) FROM e WHERE kind = 'model_result' GROUP BY 2 UNION ALL SELECT 'finish_reason', 'unknown', count(*) FROM e WHERE kind = 'model_result'
UNION ALL SELECT 'status_before', event_type, count(*) FROM e WHERE kind = 'model_result' GROUP BY 2 UNION ALL SELECT 'status_after', 'accepted', count(*) FROM e WHERE kind = 'model_result' UNION ALL SELECT 'warning_before', 'w' || user_id % 3, count(*) FROM e WHERE kind = 'model_result' GROUP BY 2
UNION ALL SELECT 'entities', 'roads', (2 * count(*))::BIGINT FROM e WHERE kind = 'model_result' UNION ALL SELECT 'failure', phase || ':' || event_type, count(*) FROM e WHERE kind = 'run_failed' GROUP BY 2""")
def run_diagnostics(spark, d):
    kind = F.element_at(F.array(*map(F.lit, ("model_result", "batch_memory", "run_failed"))), (F.col("event_id") % 3 + 1).cast("int"))
    none = F.lit(None).cast("array<string>")
    rows = table(spark, d, "events").select(
        kind.alias("event"), F.when(F.col("user_id") % 2 == 0, "primary").otherwise("repair").alias("phase"), F.lit(None).cast("string").alias("finish_reason"), F.col("event_type").alias("before_status"), F.lit("accepted").alias("after_status"),
        F.array(F.concat(F.lit("w"), (F.col("user_id") % 3).cast("string"))).alias("before_warnings"), none.alias("after_warnings"), none.alias("sanitation"), F.create_map(F.lit("roads"), F.lit(2)).alias("entity_counts"), F.lit("").alias("stage"), F.col("event_type").alias("exception_type"),
    )
    return rn.diagnostics(rows)


@register("ledger_replay", "SELECT * FROM (VALUES " + ", ".join(f"('{name}', '{status}', '{' '.join(codes)}', 'repair')" for name, _, _, status, codes in SETTLED) + ") AS t(doc_id, status, codes, selected_phase)")
def ledger_replay(spark, d):
    """The latest of two stored candidates; the first is cut off."""
    orders = _case_rows(spark, SETTLED)
    stored = orders.select("doc_id", "content_hash", F.lit("repair").alias("phase"), F.lit(2).alias("ledger_sequence"), "response")
    cut = stored.withColumns({"phase": F.lit("primary"), "ledger_sequence": F.lit(1), "response": F.lit("{")})
    rows = rn.replay(orders.drop("response"), cut.unionByName(stored))
    return rows.select("doc_id", "status", F.array_join("warnings", " ").alias("codes"), "selected_phase")
