"""Reports on extraction runs: checks, diagnostics, replays of stored candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.semantic import parse as sp
from caseloom.semantic.repair import read_and_settle
from caseloom.session import settle

# --- fixed values: keys that no report may carry; parts of a semantic identity; phases of a candidate ---
FORBIDDEN_KEYS = ("prompt", "prompts", "raw_response", "primary_response", "repair_response", "chunk_text", "evidence")
IDENTITY = ("doc_id", "content_hash", "prompt_version", "model")
PHASES = ("primary", "repair")

#: Stand for an escaped backslash and quote while strings are cut out (private-use characters).
_ESCAPES = (("\\\\", "\ue000"), ('\\"', "\ue001"))


def json_keys(report: Column) -> Column:
    """Every key of a JSON text at any depth, sorted and distinct.

    Strings are consumed from left to right, so what looks like a key inside a
    value is part of that value; a key is a string before a colon. Escapes in
    keys stay as written. Linear in the text, of any length.
    """
    for written, mark in _ESCAPES:
        report = F.replace(report, F.lit(written), F.lit(mark))
    strings = F.regexp_extract_all(report, F.lit(r'"[^"]*+"\s*+:?'), 0)

    def name(s: Column) -> Column:
        key = F.regexp_replace(s, r'^"|"\s*:$', "")
        for written, mark in reversed(_ESCAPES):
            key = F.replace(key, F.lit(mark), F.lit(written))
        return key

    return F.array_sort(F.array_distinct(F.transform(F.filter(strings, lambda s: s.endswith(":")), name)))


def leaked_keys(report: Column) -> Column:
    return F.array_intersect(json_keys(report), F.array(*map(F.lit, FORBIDDEN_KEYS)))


def run_check(records: DataFrame, rejects: DataFrame, expected: DataFrame) -> DataFrame:
    """One row: what was written against what the run reported, and the codes of what fails.

    ``records`` has the identity, ``status``, ``repaired`` and ``warnings``;
    ``expected`` is the run report's single row: records_written,
    rejects_written (null: not stated), report (JSON text) and, for a run bound
    to a manifest, manifest_records, orders_input, scanned, ignored_invalid and
    manifest_sha256 (all null without one).
    """
    count = lambda c: F.count(F.when(c, 1))
    got = records.agg(F.count(F.lit(1)).alias("records"), count(F.col("repaired")).alias("repair_attempts"))
    same = records.groupBy(*IDENTITY).agg(F.count(F.lit(1)).alias("n")).agg(count(F.col("n") > 1).alias("repeated_identities"))
    lost = rejects.agg(F.count(F.lit(1)).alias("rejects"))
    row = got.crossJoin(same).crossJoin(lost).crossJoin(expected)  # four rows of one
    bound = F.col("manifest_records").isNotNull()
    codes = {
        "report_contains_sensitive_keys": F.size(leaked_keys(F.col("report"))) > 0,
        "duplicate_semantic_identity": F.col("repeated_identities") > 0,
        "record_count_mismatch": F.col("records_written") != F.col("records"),
        "reject_count_mismatch": F.col("rejects_written") != F.col("rejects"),
        "identity_manifest_count_mismatch": bound & ((F.col("manifest_records") < 1) | (F.col("manifest_records") != F.col("orders_input"))),
        "identity_manifest_scan_counts_invalid": bound & ((F.col("scanned") < F.col("orders_input")) | (F.col("ignored_invalid") < 0)),
        "identity_manifest_hash_invalid": bound & ~F.coalesce(F.col("manifest_sha256").rlike("^sha256:[0-9a-f]{64}$"), F.lit(False)),
        "identity_manifest_output_count_mismatch": bound & (F.col("records") + F.col("rejects") != F.col("orders_input")),
    }
    failed = F.array_compact(F.array(*(F.when(c, name) for name, c in codes.items())))
    return row.select("records", "rejects", "repair_attempts", "repeated_identities", failed.alias("failures"))


def run_histograms(records: DataFrame) -> DataFrame:
    """(section, key, n): statuses, warnings and finish reasons of a run's records, in one pass."""
    entry = lambda section, key: F.struct(F.lit(section).alias("section"), F.coalesce(key, F.lit("unknown")).alias("key"))
    warned = F.transform(F.coalesce("warnings", F.array().cast("array<string>")), lambda w: entry("warning", w))
    entries = F.concat(F.array(entry("status", F.col("status")), entry("finish_reason", F.col("finish_reason"))), warned)
    return records.select(F.explode(entries).alias("e")).select("e.*").groupBy("section", "key").agg(F.count(F.lit(1)).alias("n"))


def extraction_report(records: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row: coverage and empty shares of an extraction; histograms are ``parse.quality_report``."""
    size = lambda g: F.coalesce(F.size(f"entities.{g}"), F.lit(0))
    share = lambda c, name: F.round(F.coalesce(F.avg(F.when(c, 1.0).otherwise(0.0)), F.lit(0.0)), 4).alias(name)
    every = sum((size(g) for g in list(sp.GROUPS)[1:]), size("problem_objects"))
    gap = F.exists("warnings", lambda w: w.startswith("semantic_gap:"))
    got = records.agg(F.count(F.lit(1)).alias("records"), *(share(size(g) > 0, f"coverage_{g}") for g in sp.GROUPS), share(every == 0, "empty_entities"), share(F.size("discourse.intents") == 0, "empty_intents"), share(gap, "with_gaps"))
    return got.crossJoin(rejects.agg(F.count(F.lit(1)).alias("rejects")))  # one row each


def diagnostics(events: DataFrame) -> DataFrame:
    """(section, key, n): histograms of a run's event log, in one pass with map-side sums.

    ``events`` has event, phase, finish_reason, before_status, after_status,
    before_warnings, after_warnings, sanitation (arrays), entity_counts (map of
    numbers), stage and exception_type. Results of a model are counted by
    phase, reason, status, warning and action; failures by where they arose.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit("unknown"))
    entry = lambda section, key, n=F.lit(1): F.struct(F.lit(section).alias("section"), key.alias("key"), n.cast("long").alias("n"))
    each = lambda section, c: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: entry(section, x))
    none = F.array().cast("array<struct<section:string,key:string,n:bigint>>")
    single = F.array(*(entry(s, text(c)) for s, c in (("phase", "phase"), ("finish_reason", "finish_reason"), ("status_before", "before_status"), ("status_after", "after_status"))))
    counted = F.transform(F.map_entries(F.coalesce(F.col("entity_counts"), F.create_map().cast("map<string,bigint>"))), lambda x: entry("entities", x["key"], x["value"]))
    result = F.concat(single, each("warning_before", "before_warnings"), each("warning_after", "after_warnings"), each("sanitation", "sanitation"), counted)
    where = F.concat_ws(":", F.nullif("stage", F.lit("")), F.when(F.col("phase") != "", F.col("phase")), text("exception_type"))
    failed = F.array(entry("failure", where))
    kind = F.col("event")
    entries = F.concat(F.array(entry("event", text("event"))), F.when(kind == "model_result", result).otherwise(none), F.when(kind.isin("model_call_failed", "run_failed"), failed).otherwise(none))
    return events.select(F.explode(entries).alias("e")).select("e.*").groupBy("section", "key").agg(F.sum("n").alias("n"))


def diagnostics_totals(events: DataFrame, order: str = "line") -> DataFrame:
    """One row: repairs asked for, tokens in and out, latency, and the last event by ``order``."""
    result = F.col("event") == "model_result"
    total = lambda c: F.coalesce(F.sum(F.when(result, F.coalesce(F.col(c), F.lit(0)))), F.lit(0))
    return events.agg(
        F.count(F.when(result & F.col("repair_requested"), 1)).alias("repair_requested"), total("input_tokens").alias("input_tokens"), total("output_tokens").alias("output_tokens"),
        F.round(total("latency_ms"), 3).alias("latency_ms"), F.coalesce(F.max_by("event", order), F.lit("")).alias("last_event"),
    )


def replay(orders: DataFrame, candidates: DataFrame) -> DataFrame:
    """The present validator's verdict on each order's latest stored candidate; no model is asked.

    ``candidates`` has doc_id, content_hash, phase, ledger_sequence and
    ``response``. A phase that is unknown, a sequence below 1 or an identity
    without an order is an error, for the ledger and the orders then differ.
    """
    rows = candidates.select("doc_id", "content_hash", "phase", "ledger_sequence", "response")
    bad = F.when(~F.coalesce(F.col("phase").isin(*PHASES), F.lit(False)), "invalid_candidate_phase").when(~F.coalesce(F.col("ledger_sequence") >= 1, F.lit(False)), "invalid_ledger_sequence")
    wrong = rows.select(bad.alias("code")).filter("code IS NOT NULL").first()
    if wrong is not None:
        raise ValueError(wrong.code)
    key = ["doc_id", "content_hash"]
    last = settle(rows.groupBy(*key).agg(F.max_by(F.struct("phase", "response"), "ledger_sequence").alias("c")).select(*key, "c.*"), "replay")
    if last.join(orders.select(*key), key, "left_anti").first() is not None:
        raise ValueError("candidate_order_identity_mismatch")
    verdicts = read_and_settle(orders.join(last, key))
    return verdicts.join(last.select(*key, F.col("phase").alias("selected_phase")), key)
