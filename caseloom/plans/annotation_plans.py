"""Annotation queries: each order is a record, each of its lines an issue."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.operators import annotation as an
from caseloom.operators import profile as pf
from caseloom.plans.base import register
from caseloom.session import table


def _gold(spark, d, drop: int | None = None):
    """Lines as issues: brand, shipping state and supplier; ``drop`` leaves one line number out."""
    line, part, supp = table(spark, d, "lineitem"), table(spark, d, "part"), table(spark, d, "supplier")
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
    blank = F.array().cast(f"array<{an.MENTION}>")
    say = lambda c, **more: F.array(F.struct(c.alias("surface"), c.alias("canonical"), F.lit("title_clean").alias("field"), c.alias("evidence"), *(v.alias(k) for k, v in more.items())))
    mode = F.when(F.col("l_returnflag") == "R", "request").otherwise("problem")
    issue = lambda x: F.struct(x["mode"].alias("mode"), F.lit("current").alias("time_scope"), say(x["brand"]).alias("objects"), say(x["state"]).alias("predicates"), blank.alias("actions"), say(x["place"], type=F.lit("poi")).alias("locations"))
    keep = F.col("l_linenumber") != drop if drop else F.lit(True)
    slim = F.struct("l_linenumber", mode.alias("mode"), F.col("p_brand").alias("brand"), F.col("l_linestatus").alias("state"), F.col("s_name").alias("place"))  # only these are shuffled
    issues = F.array_sort(F.collect_list(F.when(keep, slim)))
    return rows.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.transform(issues, issue).alias("issues")).withColumn("content_hash", F.sha2(F.col("doc_id").cast("string"), 256))


_LINES = "lines AS (SELECT l_orderkey AS doc_id, l_linenumber AS n, p_brand, l_linestatus, l_returnflag, s_name FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"
_MODE = "CASE WHEN l_returnflag = 'R' THEN 'request' ELSE 'problem' END"
_NTH = f"row_number() OVER (PARTITION BY doc_id ORDER BY n, {_MODE}, p_brand, l_linestatus, s_name)"


@register("gold_projection_issues", f"""WITH {_LINES} SELECT doc_id, doc_id || '::issue::' || {_NTH} AS issue_id, CASE WHEN l_returnflag = 'R' THEN 'request' ELSE 'problem' END AS mode FROM lines""")
def gold_projection_issues(spark, d):
    return an.project_issues(_gold(spark, d))[0].select("doc_id", "issue_id", "mode")


@register("gold_projection_members", f"""WITH {_LINES}, m AS (SELECT doc_id, 'object' AS role, 'problem_object' AS entity_type, p_brand AS v FROM lines
 UNION ALL SELECT doc_id, CASE WHEN l_returnflag = 'R' THEN 'issue_predicate' ELSE 'behavior' END, CASE WHEN l_returnflag = 'R' THEN 'issue_predicate' ELSE 'problem_behavior' END, l_linestatus FROM lines
 UNION ALL SELECT doc_id, 'location', 'poi', s_name FROM lines)
SELECT DISTINCT doc_id || '::issue::flat' AS issue_id, role, entity_type, v AS normalized_value FROM m""")
def gold_projection_members(spark, d):
    return an.project_issues(_gold(spark, d), flat=True)[1].select("issue_id", "role", "entity_type", "normalized_value")


def _norm(c: str) -> str:
    return f"lower(regexp_replace({c}, '[[:space:][:punct:]]+', '', 'g'))"


_FRAMES = f"""SELECT DISTINCT doc_id, list_sort(['location:' || {_norm('s_name')}, 'object:' || {_norm('p_brand')}, 'predicate:' || {_norm('l_linestatus')}]) AS f FROM lines"""
_SIDES = f"""WITH {_LINES}, l AS ({_FRAMES}), r AS ({_FRAMES} WHERE n <> 3),
items AS (SELECT 'l' AS side, * FROM l UNION ALL SELECT 'r', * FROM r),
parts AS (SELECT DISTINCT side, doc_id, 'frames' AS kind, array_to_string(f, '|') AS v FROM items
 UNION SELECT DISTINCT side, doc_id, 'mentions', unnest(f) FROM items
 UNION SELECT DISTINCT side, doc_id, 'pairs', unnest([f[1] || '|' || f[2], f[1] || '|' || f[3], f[2] || '|' || f[3]]) FROM items),
j AS (SELECT doc_id, kind, bool_or(side = 'l') AS l, bool_or(side = 'r') AS r FROM parts GROUP BY doc_id, kind, v)"""


@register("annotation_agreement", f"""{_SIDES}, s AS (SELECT kind, count(*) FILTER (WHERE l AND r) AS matched, count(*) FILTER (WHERE l AND NOT r) AS left_only, count(*) FILTER (WHERE r AND NOT l) AS right_only FROM j GROUP BY kind)
SELECT *, round(2.0e0 * matched / (2 * matched + left_only + right_only), 4) AS f1 FROM s""")
def annotation_agreement(spark, d):
    return an.agreement(an.compare(_gold(spark, d), _gold(spark, d, drop=3)))


@register("annotation_conflicts", f"""{_SIDES} SELECT doc_id, string_agg(DISTINCT CASE kind WHEN 'mentions' THEN 'grounded_mentions' WHEN 'pairs' THEN 'issue_attachment' ELSE 'issue_frame' END, ',' ORDER BY CASE kind WHEN 'mentions' THEN 'grounded_mentions' WHEN 'pairs' THEN 'issue_attachment' ELSE 'issue_frame' END) AS reasons
FROM j WHERE l <> r GROUP BY doc_id""")
def annotation_conflicts(spark, d):
    return an.conflicts(an.compare(_gold(spark, d), _gold(spark, d, drop=3))).select("doc_id", "reasons")


@register("adjudication_merge", f"""{_SIDES}, c AS (SELECT DISTINCT doc_id FROM j WHERE l <> r)
SELECT doc_id, count(*) FILTER (WHERE c.doc_id IS NULL OR n <> 3) AS n_issues, CASE WHEN c.doc_id IS NULL THEN 'exact_double_annotation_agreement' ELSE 'second reading' END AS notes
FROM lines LEFT JOIN c USING (doc_id) GROUP BY doc_id, c.doc_id""")
def adjudication_merge(spark, d):
    """Conflicts are resolved to the copy without line 3."""
    left, right = _gold(spark, d).withColumn("annotator", F.lit("ann")), _gold(spark, d, drop=3).withColumn("annotator", F.lit("bob"))
    fixed = an.differing(left, right).select(*an.IDENTITY, F.col("right").alias("issues"), F.lit("eve").alias("adjudicator"), F.lit("second reading").alias("notes"))
    return an.adjudicate(left, right, fixed, "eve").select("doc_id", F.size("issues").cast("long").alias("n_issues"), "notes")


@register("gold_error_histogram", f"""WITH {_LINES}, t AS (SELECT l.*, strpos(o_orderpriority, p_brand) > 0 AS b, strpos(o_orderpriority, l_linestatus) > 0 AS p, strpos(o_orderpriority, s_name) > 0 AS s FROM lines l JOIN orders ON o_orderkey = doc_id)
SELECT code, n FROM (SELECT 'object_evidence_not_in_field' AS code, count(*) FILTER (WHERE NOT b) AS n FROM t UNION ALL SELECT 'predicate_evidence_not_in_field', count(*) FILTER (WHERE NOT p) FROM t UNION ALL SELECT 'location_evidence_not_in_field', count(*) FILTER (WHERE NOT s) FROM t) WHERE n > 0""")
def gold_error_histogram(spark, d):
    title = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.struct(F.col("o_orderpriority").alias("title_clean"), *(F.lit("").alias(f) for f in an.FIELDS[1:])).alias("clean_fields"))
    rows = _gold(spark, d).join(title, "doc_id").withColumn("status", F.lit("completed"))
    return an.gold_errors(rows).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@register("annotation_packet", "SELECT d.doc_id, d.lang, 'production' AS subset FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic = 1")
def annotation_packet(spark, d):
    body = F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_hash")
    docs = table(spark, d, "documents").select("doc_id", "lang", body)
    chosen = docs.join(table(spark, d, "labels").filter("toxic = 1"), "doc_id", "left_semi").select("doc_id", "content_hash", F.lit("production").alias("subset"))
    return an.packet(chosen, docs).select("doc_id", "lang", "subset")


@register("ledger_latest_attempts", """WITH t AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'repair' ELSE 'primary' END AS phase, turn // 4 AS run FROM conversations),
m AS (SELECT conv_id, max(turn) // 4 AS run FROM t GROUP BY 1)
SELECT conv_id, phase, max(turn) AS turn, phase = 'repair' OR max(turn) % 2 = 1 AS terminal FROM t JOIN m USING (conv_id, run) GROUP BY 1, 2""")
def ledger_latest_attempts(spark, d):
    phase = F.when(F.col("role") == "assistant", "repair").otherwise("primary")
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.lit("h").alias("content_hash"), phase.alias("phase"), F.floor(F.col("turn") / 4).alias("run_attempt_id"), F.col("turn").alias("ledger_sequence"), F.when(F.col("turn") % 2 == 0, "repair_required").otherwise("accepted").alias("status"))
    return an.latest_attempts(rows).select(F.col("doc_id").alias("conv_id"), "phase", F.col("ledger_sequence").alias("turn"), "terminal")


@register("sampling_manifest_report")
def sampling_manifest_report(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "text", pf.length_bucket(F.col("n_chars")).alias("bucket"))
    flags = F.array_compact(F.array(F.when(F.contains("text", F.lit("License")), "license"), F.when(F.contains("text", F.lit("!!")), "shouting"), F.when(F.contains("text", F.lit("@")), "mail")))
    rows = an.manifest(docs, ["lang", "bucket"], flags, 24, 24, "s3").join(docs, "doc_id")
    return rows.groupBy("subset", "lang", "bucket").agg(F.count(F.lit(1)).alias("n"))
