"""From documents or raw records to the stored event-entity graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import text as tx
from caseloom.operators import graph
from caseloom.operators.entities import extract_links
from caseloom.sources.records import read_json_lines, read_tsv

# --- fixed values: columns of an order; raw and metadata names of those that differ; labels of an event ---
TEXTS = {"title_clean": "title", "case_content_clean": "case_content", "case_goal_clean": "case_goal", "address_detail_clean": "address_detail"}
MAPPED = {
    "area_code_city": ("area_code_city",), "area_code_area": ("area_code_area",), "area_code_street": ("area_code_street",), "case_lnglat": ("case_lnglat",),
    "type1": ("case_accord_type_one_name", "type1"), "type2": ("case_accord_type_two_name", "type2"), "type3": ("case_accord_type_three_name", "type3"),
    "type4": ("case_accord_type_four_name", "type4"), "type5": ("case_accord_type_five_name", "type5"), "case_accord_code": ("case_accord_code",),
    "order_source": ("order_source",), "order_type": ("order_type",), "order_status": ("order_status",), "service_object_type": ("service_object_type",),
    "belong_dept": ("belong_dept",), "deptName": ("deptName",), "orgName": ("orgName",),
}
ACCEPTED = ("accepted", "accepted_with_warnings")
EVENT_SOURCE = "t_order_master"


def _reader(df: DataFrame):
    """A function from names to the first value that is not empty: each name in the row, then in its metadata."""
    inside = set(df.schema["metadata"].dataType.fieldNames()) if "metadata" in df.columns and hasattr(df.schema["metadata"].dataType, "fieldNames") else set()

    def value(*names: str) -> Column:
        found = [F.nullif(tx.clean(c), F.lit("")) for n in names for c in ([F.col(n)] if n in df.columns else []) + ([F.col(f"metadata.{n}")] if n in inside else [])]
        return F.coalesce(*found, F.lit(""))

    return value


def source_orders(rows: DataFrame) -> DataFrame:
    """Raw rows or documents as flat orders of 26 columns; missing columns are empty.

    The id is the document's own, else made from the raw id or the order id.
    """
    value = _reader(rows)
    own = F.coalesce(F.nullif(value("doc_id"), F.lit("")), tx.letter_id("order_", value("id", "order_id")))
    orders = rows.select(
        own.alias("doc_id"), value("id").alias("_raw"), value("order_id").alias("_order"), *(value(n, raw).alias(n) for n, raw in TEXTS.items()),
        value("call_time").alias("call_time"), value("call_month").alias("_month"), *(value(*names).alias(n) for n, names in MAPPED.items()),
    )
    hashes = [tx.short_hash(F.coalesce(F.nullif("_raw", F.lit("")), F.col("doc_id"))).alias("raw_id_hash"), F.when(F.col("_order") != "", tx.short_hash(F.col("_order"))).otherwise("").alias("order_id_hash")]
    month = F.when(F.col("_month") != "", F.col("_month")).when(F.length("call_time") >= 7, F.substring("call_time", 1, 7)).otherwise("")
    return orders.select("doc_id", *hashes, *TEXTS, "call_time", month.alias("call_month"), *MAPPED)


def read_orders(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Orders of a TSV or JSON-lines file, by its suffix; bad rows are left out; limit 0 and None mean all."""
    if path.endswith((".jsonl", ".json")):
        return source_orders(read_json_lines(spark, path, limit=limit or None).filter("_error IS NULL"))
    return source_orders(read_tsv(spark, path, limit=limit or None).filter("NOT _bad"))


def order_events(orders: DataFrame, semantic: DataFrame | None = None) -> DataFrame:
    """One event an order: id, labelled text, time, month, source, status, projection version.

    ``semantic`` (doc_id, status, event_summary, projection_version) replaces
    the text where it was accepted and has a summary, and always gives its
    version. It must have one row a document.
    """
    area = tx.join_present(" / ", *(F.col(f"area_code_{n}") for n in ("city", "area", "street")))
    kind = tx.join_present(" / ", *(F.col(f"type{n}") for n in range(1, 6)))
    lines = [("标题：", F.col("title_clean")), ("诉求内容：", F.col("case_content_clean")), ("诉求目标：", F.col("case_goal_clean")), ("地址详情：", F.col("address_detail_clean")), ("区域：", area), ("分类：", kind), ("来电时间：", F.col("call_time"))]
    events = orders.select(
        F.concat(F.lit("event_"), tx.short_hash(F.col("doc_id"))).alias("event_id"), "doc_id", tx.labelled_lines(lines).alias("event_text"), F.col("call_time").alias("event_time"),
        F.col("call_month").alias("event_month"), F.lit(EVENT_SOURCE).alias("event_source"), F.col("order_status").alias("event_status"), F.lit("").alias("projection_version"),
    )
    if semantic is None:
        return events
    told = semantic.select("doc_id", F.when(F.col("status").isin(*ACCEPTED), F.nullif("event_summary", F.lit(""))).alias("_summary"), F.col("projection_version").alias("_version"))
    return events.join(told, "doc_id", "left").withColumn("event_text", F.coalesce("_summary", "event_text")).withColumn("projection_version", F.coalesce("_version", F.lit(""))).drop("_summary", "_version")


def external_links(rows: DataFrame) -> DataFrame:
    """Links from elsewhere in the shape of the rules' links; those without document, type or value are left out."""
    have = lambda c: tx.clean(F.col(c)) if c in rows.columns else F.lit("")
    value, normal = have("entity_value"), tx.squeeze(have("normalized_value"))
    normal = F.coalesce(F.nullif(normal, F.lit("")), tx.squeeze(value))
    number = F.col("confidence").cast("double") if "confidence" in rows.columns else F.lit(None).cast("double")
    out = rows.select(
        have("doc_id").alias("doc_id"), have("entity_type").alias("entity_type"), F.coalesce(F.nullif(value, F.lit("")), normal).alias("entity_value"), normal.alias("normalized_value"), have("source_field").alias("source_field"),
        have("source_channel").alias("source_channel"), number.alias("confidence"), have("matched_text").alias("matched_text"), F.lit(1 << 20).cast("int").alias("ordinal"),
    )
    return out.filter("doc_id <> '' AND entity_type <> '' AND normalized_value <> ''")


def build_graph(orders: DataFrame, extra_links: DataFrame | None = None, semantic: DataFrame | None = None, label: str = "orders-graph") -> dict[str, DataFrame]:
    """Write and return the graph of orders: events, links, entities, source_orders.

    Links are the rules' and, after them, external ones of known documents.
    """
    events = order_events(orders, semantic)
    links = extract_links(orders)
    links = links.withColumn("confidence", F.col("confidence").cast("double"))
    if extra_links is not None:
        links = links.unionByName(external_links(extra_links))
    links = links.join(events.select("doc_id", "event_id"), "doc_id").withColumn("entity_id", graph.entity_id(F.col("entity_type"), F.col("normalized_value")))
    return graph.store_graph(events, links, label) | {"source_orders": orders}
