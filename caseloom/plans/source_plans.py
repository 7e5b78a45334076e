"""Queries over sources: orders, events and links of documents, manifests, rule entities in Chinese text."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.operators import entities
from caseloom.operators import profile as pf
from caseloom.plans.base import register
from caseloom.session import table, values
from caseloom.sources import graph_source as gs
from caseloom.sources import manifests, records


def _orders(spark, d):
    """Documents as raw rows: language as title and first type, source as area."""
    docs = table(spark, d, "documents")
    return gs.source_orders(docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").alias("title"), F.lit("NULL").alias("case_content"), F.lit("2024-05-06 07:08").alias("call_time"), F.struct(F.col("source").alias("area_code_area"), F.col("lang").alias("type1")).alias("metadata")))


@register("source_events", """SELECT 'event_' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 16) AS event_id, CAST(doc_id AS VARCHAR) AS doc_id,
'标题：' || lang || chr(10) || '区域：' || source || chr(10) || '分类：' || lang || chr(10) || '来电时间：2024-05-06 07:08' AS event_text, '2024-05' AS event_month FROM documents""")
def source_events(spark, d):
    return gs.order_events(_orders(spark, d)).select("event_id", "doc_id", "event_text", "event_month")


@register("semantic_event_override", """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 3 = 0 THEN 'summary' ELSE 'own' END AS text, CASE WHEN doc_id % 3 < 2 THEN 'v2' ELSE '' END AS projection_version FROM documents""")
def semantic_event_override(spark, d):
    """Accepted summaries replace the text; a rejected record only gives its version."""
    k = F.col("doc_id") % 3
    semantic = table(spark, d, "documents").filter(k < 2).select(F.col("doc_id").cast("string").alias("doc_id"), F.when(k == 0, "accepted").otherwise("rejected").alias("status"), F.lit("summary").alias("event_summary"), F.lit("v2").alias("projection_version"))
    events = gs.order_events(_orders(spark, d), semantic)
    return events.select("doc_id", F.when(F.col("event_text") == "summary", "summary").otherwise("own").alias("text"), "projection_version")


_CASES = (
    ("c1", "武进区湖塘镇人民路和平安路交叉口有流动摊贩占道经营"),
    ("c2", "平安路积水"),
    ("c3", "武进区"),
)
_WANT = (
    ("c1", "area", "武进区"), ("c1", "street", "湖塘镇"), ("c1", "intersection", "人民路和平安路交叉口"), ("c1", "road", "人民路"), ("c1", "road", "平安路"),
    ("c1", "problem_object", "流动摊贩"), ("c1", "problem_behavior", "占道经营"), ("c2", "road", "平安路"), ("c3", "area", "武进区"),
)


@register("rule_entities", "SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in _WANT) + ") AS t(doc_id, entity_type, entity_value)")
def rule_entities(spark, d):
    """Entities that the rules find in Chinese text and that name what the cases hold."""
    orders = values(spark, list(_CASES), "doc_id", "case_content_clean")
    named = values(spark, sorted({(kind, value) for _, kind, value in _WANT}), "entity_type", "entity_value")
    return entities.extract_links(orders).select("doc_id", "entity_type", "entity_value").distinct().join(F.broadcast(named), ["entity_type", "entity_value"], "left_semi")


_TEXT = "标题：路灯\n诉求内容：不亮\n已三天\n诉求目标：维修"


@register("order_normalisation", "SELECT * FROM (VALUES ('a', '路灯', '不亮|已三天', '维修', NULL), ('b', '', '自己的', '', NULL), ('', '', '内容', '', 'missing_doc_id'), ('d', '', '', '', 'empty_semantic_text')) AS t(doc_id, title, content, goal, code)")
def order_normalisation(spark, d):
    """Legacy documents get their fields from labelled lines; codes name what cannot be used."""
    rows = values(spark, [("a", "", _TEXT), ("b", "自己的", "诉求内容：别的"), ("", "内容", ""), ("d", " ", "无标签")], "doc_id", "case_content_clean", "text")
    out = records.normalise_orders(rows)
    return out.select("doc_id", F.col("title_clean").alias("title"), F.replace("case_content_clean", F.lit("\n"), F.lit("|")).alias("content"), F.col("case_goal_clean").alias("goal"), F.col("_code").alias("code"))


@register("manifest_packet", """SELECT row_number() OVER (ORDER BY doc_id DESC) AS position, CAST(doc_id AS VARCHAR) AS doc_id, sha256(coalesce(text, '')) AS content_hash, lang AS title_clean, '{"lang":"' || lang || '"}' AS metadata_json FROM documents WHERE doc_id % 50 = 0""")
def manifest_packet(spark, d):
    """A checked manifest in its own order, bound to the records, as an inference packet."""
    docs = table(spark, d, "documents").dropDuplicates(["doc_id"])
    orders = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_hash"), F.col("lang").alias("title_clean"), *(F.lit("").alias(c) for c in manifests.CLEAN[1:]), F.struct("lang").alias("metadata"))
    chosen = orders.filter(F.col("doc_id").cast("long") % 50 == 0).select(F.lit("m1").alias("schema"), "doc_id", "content_hash", (-F.col("doc_id").cast("long")).alias("ordinal"))
    packet = manifests.inference_packet(manifests.check_manifest(chosen, "m1"), orders, "p1")
    return packet.select("position", "doc_id", "content_hash", "title_clean", "metadata_json")


@register("nearest_rank_lengths", "SELECT lang, list_sort(list(n_chars))[round_even((count(*) - 1) * 0.9e0, 0)::BIGINT + 1] AS p90 FROM documents GROUP BY lang")
def nearest_rank_lengths(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(pf.nearest_rank(F.col("n_chars"), 0.9).alias("p90"))
