"""Manifests of chosen documents, bound to their records by identity, and the packet for inference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.session import numbered

CLEAN = ("title_clean", "case_content_clean", "case_goal_clean", "address_detail_clean")


def check_manifest(manifest: DataFrame, schema: str) -> DataFrame:
    """The manifest, or an error: empty, another schema tag, no hex digest, a document or identity twice."""
    bad_hash = ~F.coalesce(F.regexp_replace("content_hash", "^sha256:", ""), F.lit("")).rlike("^[0-9a-f]{64}$")
    count = lambda c: F.count(F.when(c, 1))
    rows = manifest.agg(F.count(F.lit(1)).alias("n"), count(~F.col("schema").eqNullSafe(schema)).alias("tags"), count(bad_hash).alias("hashes"), count(F.coalesce("doc_id", F.lit("")) == "").alias("ids")).first()
    twice = manifest.groupBy("doc_id").count().filter("count > 1").limit(1).count()
    for code, found in (("empty_manifest", not rows.n), ("manifest_schema_mismatch", rows.tags), ("missing_doc_id", rows.ids), ("invalid_content_hash", rows.hashes), ("duplicate_doc_id", twice)):
        if found:
            raise ValueError(code)
    return manifest


def bound_orders(manifest: DataFrame, orders: DataFrame, order: str = "ordinal") -> DataFrame:
    """The manifest's records with ``_ordinal``, in its order.

    Every manifest row must have one record with its hash: a missing one, a
    changed one or a repeated id is an error; other records don't matter.
    """
    found = manifest.select("doc_id", F.col("content_hash").alias("_want"), F.col(order).alias("_ordinal")).join(orders, "doc_id", "left")
    checks = found.agg(F.count(F.when(F.col("content_hash").isNull(), 1)).alias("missing"), F.count(F.when(F.col("content_hash") != F.col("_want"), 1)).alias("changed"), (F.count(F.lit(1)) - F.count_distinct("doc_id")).alias("repeated")).first()
    for code in ("missing", "changed", "repeated"):
        if checks[code]:
            raise ValueError(f"manifest_order_{code}:{checks[code]}")
    return found.drop("_want").orderBy("_ordinal")


def inference_packet(manifest: DataFrame, orders: DataFrame, schema: str) -> DataFrame:
    """Nine columns a record and no more, in manifest order: tag, position, identity, four texts, metadata as JSON."""
    rows = bound_orders(manifest, orders)
    metadata = F.to_json("metadata") if "metadata" in orders.columns else F.lit("{}")
    packed = rows.select(F.lit(schema).alias("schema"), "_ordinal", "doc_id", "content_hash", *CLEAN, metadata.alias("metadata_json"))
    return numbered(packed, "position", F.asc("_ordinal"), F.asc("doc_id")).drop("_ordinal")
