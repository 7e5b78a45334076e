"""Queries over synthetic model responses built from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.plans.base import register
from caseloom.plans.semantic_cases import SETTLED, VALIDATED
from caseloom.semantic import parse as sp
from caseloom.semantic import repair as sp_repair
from caseloom.session import table, values


def _orders(spark, d):
    """Documents as orders; the first word of each is its evidence."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.sha2(body, 256).alias("content_hash"), body.alias("case_content_clean"), *(F.lit("").alias(f) for f in sp.FIELDS[1:]))
    return rows.withColumn("word", F.regexp_extract("case_content_clean", "[A-Za-z]+", 0)).withColumn("k", F.pmod(F.col("doc_id").cast("long"), F.lit(4)))


def _respond(rows):
    """Well-formed, fenced with a trailing comma, without evidence, or cut off, by turns."""
    item = F.concat(F.lit('{"surface":"'), F.col("word"), F.lit('","canonical":"'), F.col("word"), F.lit('","source_field":"case_content_clean","evidence":"'), F.when(F.col("k") == 2, "~none~").otherwise(F.col("word")), F.lit('"}'))
    whole = F.concat(F.lit('{"event_summary":"s","entities":{"problem_objects":['), item, F.lit(']},"discourse":{"urgency":{"level":"normal","evidence":""}}}'))
    comma = F.concat(F.lit("```json\n"), F.regexp_replace(whole, r"\}\}\}$", "}},}"), F.lit("\n```"))
    return rows.withColumn("response", F.when(F.col("k") == 1, comma).when(F.col("k") == 3, F.substring(whole, 1, 40)).otherwise(whole))


def _records(spark, d):
    return sp.read_responses(_respond(_orders(spark, d)))


_K = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, doc_id % 4 AS k, regexp_extract(coalesce(text, ''), '[A-Za-z]+') AS word, coalesce(text, '') = '' AS nothing FROM documents"


@register("semantic_parse_status", f"""SELECT doc_id, CASE WHEN nothing THEN 'rejected' WHEN k = 3 OR k = 2 OR word = '' THEN 'repair_required' WHEN k = 1 THEN 'accepted_with_warnings' ELSE 'accepted' END AS status FROM ({_K})""")
def semantic_parse_status(spark, d):
    return _records(spark, d).select("doc_id", "status")


@register("semantic_projection", f"SELECT doc_id, 'problem_object' AS entity_type, word AS entity_value FROM ({_K}) WHERE k IN (0, 1) AND word <> ''")
def semantic_projection(spark, d):
    return sp.project_links(_records(spark, d)).select("doc_id", "entity_type", "entity_value")


@register("semantic_quality_report", f"SELECT CASE WHEN nothing THEN 'rejected' WHEN k = 3 OR k = 2 OR word = '' THEN 'repair_required' WHEN k = 1 THEN 'accepted_with_warnings' ELSE 'accepted' END AS key, count(*) AS n FROM ({_K}) GROUP BY 1")
def semantic_quality_report(spark, d):
    return sp.quality_report(_records(spark, d)).filter("section = 'status'").select("key", "n")


@register("semantic_settled_status", f"""SELECT doc_id, CASE WHEN nothing THEN 'rejected' WHEN k = 3 THEN 'repair_required' WHEN k IN (1, 2) OR word = '' THEN 'accepted_with_warnings' ELSE 'accepted' END AS status FROM ({_K})""")
def semantic_settled_status(spark, d):
    """Candidates without evidence are removed, so only cut responses still need repair."""
    return sp_repair.read_and_settle(_respond(_orders(spark, d))).select("doc_id", "status")


def _case_rows(spark, cases):
    """The cases' orders and responses as a table."""
    rows = values(spark, [(name, content, response) for name, content, response, *_ in cases], "doc_id", "case_content_clean", "response")
    return rows.withColumns({"content_hash": F.sha2("case_content_clean", 256), **{f: F.lit("") for f in sp.FIELDS[1:]}})


def _case_sql(cases):
    return "SELECT * FROM (VALUES " + ", ".join(f"('{name}', '{status}', '{' '.join(codes)}')" for name, _, _, status, codes in cases) + ") AS t(doc_id, status, codes)"


@register("semantic_validation_codes", _case_sql(VALIDATED))
def semantic_validation_codes(spark, d):
    """Every warning code, each in a small order of its own."""
    return sp.read_responses(_case_rows(spark, VALIDATED)).select("doc_id", "status", F.array_join("warnings", " ").alias("codes"))


@register("semantic_recovery_actions", _case_sql(SETTLED))
def semantic_recovery_actions(spark, d):
    return sp_repair.read_and_settle(_case_rows(spark, SETTLED)).select("doc_id", "status", F.array_join("warnings", " ").alias("codes"))


@register("semantic_repair_fields", """SELECT doc_id, CASE WHEN nothing THEN '' WHEN k = 3 THEN 'event_summary' WHEN k = 2 OR word = '' THEN 'entities.problem_objects.0' ELSE '' END AS fields
FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, doc_id % 4 AS k, regexp_extract(coalesce(text, ''), '[A-Za-z]+') AS word, coalesce(text, '') = '' AS nothing FROM documents) WHERE NOT nothing""")
def semantic_repair_fields(spark, d):
    found = _records(spark, d).filter("status <> 'rejected'")
    return found.select("doc_id", F.array_join(sp.repair_fields(F.col("warnings")), " ").alias("fields"))
