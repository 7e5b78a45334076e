"""Model responses to structured rows: tolerant parsing, normalising, validation.

These are order-dependent rules over one nested value a row, so they run as
one Arrow-batched function; routing, reports and projection are relational.
"""

from __future__ import annotations

import ast
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from caseloom.semantic import words as w
from caseloom.semantic.words import FIELDS, Texts
from caseloom.session import settle

# --- fixed values: groups with their limits, enumerations, warning codes ---
GROUPS = {"problem_objects": 3, "problem_behaviors": 4, "roads": 4, "intersections": 2, "pois": 4}
INTENTS = ("投诉", "举报", "求助", "咨询", "建议", "表扬", "催办", "反馈", "其他")
EMOTIONS = ("愤怒", "不满", "焦虑", "无奈", "悲伤", "感谢", "认可")
SATISFACTION = ("satisfied", "dissatisfied", "mixed", "unknown")
URGENCY = ("normal", "high", "critical")
MAX_INTENTS, MAX_EMOTIONS = 3, 2
GENERIC = ("问题", "情况", "事情", "相关部门", "工作人员", "道路", "马路边", "小区", "地点")
NO_TARGETS = ("服务对象", "诉求人", "市民", "群众", "本人", "自己", "其")
POLITENESS = ("谢谢", "感谢", "感谢转交", "请优先处理，谢谢")
PRIORITY = ("优先处理", "请优先处理")
REJECTS = ("missing_doc_id", "empty_semantic_text", "repair_failed")
REPAIRS = (
    "json_parse_failed", "empty_event_summary", "missing_evidence:", "invalid_source_field:", "surface_evidence_mismatch:",
    "empty_canonical:", "generic_entity:", "duplicate_entity:", "road_poi_conflict:", "intersection_shape_conflict:", "poi_shape_conflict:",
    "request_action_as_behavior:", "normal_service_action_as_behavior:", "canonical_evidence_conflict:",
    "satisfaction_missing_target_or_evidence", "invalid_satisfaction_target", "unsupported_satisfaction_evidence",
    "template_politeness_as_satisfaction", "object_attitude_as_emotion:", "unsupported_emotion_evidence:",
    "urgency_missing_evidence", "template_priority_as_urgency", "possible_history_contamination",
)
_FENCE = re.compile(r"```(?:json)?[ \t]*\r?\n?(.*?)\r?\n?```", re.S | re.I)
_QUOTED = re.compile(r'"(?:\\.|[^"\\])*"|\'(?:\\.|[^\'\\])*\'', re.S)


def objects_in(text: str) -> Iterator[str]:
    """Complete top-level {...} spans; an outer one that never closes hides what is inside it."""
    at = 0
    while (start := text.find("{", at)) >= 0:
        depth, i = 0, start
        while i < len(text):
            quoted = _QUOTED.match(text, i) if text[i] in "\"'" else None
            if text[i] in "\"'" and not quoted:
                return
            if quoted:
                i = quoted.end()
                continue
            depth += {"{": 1, "}": -1}.get(text[i], 0)
            i += 1
            if not depth:
                break
        if depth:
            return
        yield text[start:i]
        at = i


def _without_trailing_commas(text: str) -> str:
    """Commas before a closing bracket go, outside strings."""
    parts, at = [], 0
    for m in _QUOTED.finditer(text):
        parts += [re.sub(r",(?=\s*[\]}])", "", text[at : m.start()]), m[0]]
        at = m.end()
    joined = "".join([*parts, re.sub(r",(?=\s*[\]}])", "", text[at:])])
    return joined


def _plain(value) -> bool:
    """Only what JSON can say: no NaN, tuples or keys that are not text."""
    if isinstance(value, dict):
        return all(isinstance(k, str) and _plain(v) for k, v in value.items())
    if isinstance(value, list):
        return all(map(_plain, value))
    return value is None or isinstance(value, (str, int)) or (isinstance(value, float) and math.isfinite(value))


def load_object(text: str) -> tuple[dict | None, str]:
    """(object, how it was recovered): strict JSON, trailing commas, raw controls, Python literal."""
    bare = _without_trailing_commas(text)
    attempts = [(json.loads, text, "")]
    if bare != text:
        attempts.append((json.loads, bare, "json_recovered_trailing_comma"))
    attempts += [(lambda t: json.loads(t, strict=False), text, "json_recovered_control_character"), (ast.literal_eval, text, "json_recovered_python_literal")]
    for load, source, note in attempts:
        try:
            value = load(source)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            continue
        if isinstance(value, dict) and _plain(value):
            return value, note
    return None, ""


def _text(x) -> str:
    return x if isinstance(x, str) else ""


def _dict(x) -> dict:
    return x if isinstance(x, dict) else {}


def normalise(value: dict) -> tuple[dict, list[str]]:
    """The stable shape, with ordered unique warnings for what had to be dropped or coerced."""
    notes: dict[str, None] = {}
    entities = {}
    for group, most in GROUPS.items():
        items, kept = _dict(value.get("entities")).get(group, []), []
        if not isinstance(items, list):
            notes[f"malformed_entity_group:{group}"] = None
            items = []
        for k, item in enumerate(items):
            if isinstance(item, str) and item.strip():
                notes[f"coerced_entity_string:{group}:{len(kept)}"] = None
                item = {"surface": item.strip(), "canonical": item.strip(), "evidence": item.strip()}
            if not isinstance(item, dict):
                notes[f"malformed_entity_item:{group}:{k}"] = None
                continue
            field = item.get("source_field") if isinstance(item.get("source_field"), str) else _text(item.get("field"))
            if field.split(".")[0] == "case_content_windows":
                field = "case_content_clean"
            kept.append({"surface": _text(item.get("surface")), "canonical": _text(item.get("canonical")), "source_field": field, "evidence": _text(item.get("evidence"))})
        if len(kept) > most:
            notes[f"group_limit_exceeded:{group}"] = None
        entities[group] = kept[:most]
    talk = _dict(value.get("discourse"))

    def labelled(name: str, known: tuple[str, ...], most: int) -> list[dict]:
        out = []
        for k, item in enumerate(talk.get(name) if isinstance(talk.get(name), list) else []):
            if _dict(item).get("label") not in known:
                notes[f"invalid_{name}_label:{k}"] = None
                continue
            level = item.get("intensity")
            out.append({"label": item["label"], "evidence": _text(item.get("evidence")), "intensity": level if isinstance(level, int) and not isinstance(level, bool) and 1 <= level <= 3 else 1})
        return out[:most]

    mood, haste = _dict(talk.get("satisfaction")), _dict(talk.get("urgency"))
    label, level = _text(mood.get("label")) or "unknown", _text(haste.get("level")) or "normal"
    if label not in SATISFACTION:
        notes["invalid_satisfaction_label"] = None
        label = "unknown"
    if level not in URGENCY:
        notes["invalid_urgency_level"] = None
        level = "normal"
    return {
        "event_summary": _text(value.get("event_summary")).strip(),
        "entities": entities,
        "discourse": {
            "intents": labelled("intents", INTENTS, MAX_INTENTS),
            "emotions": labelled("emotions", EMOTIONS, MAX_EMOTIONS),
            "satisfaction": {"label": label, "target": _text(mood.get("target")), "evidence": _text(mood.get("evidence"))},
            "urgency": {"level": level, "evidence": _text(haste.get("evidence"))},
        },
    }, list(notes)


def parse_response(text) -> tuple[dict, list[str]]:
    """First complete object of a response, normalised, and warnings."""
    if isinstance(text, str):
        body = text.strip()
        fenced = _FENCE.fullmatch(body)
        for span in objects_in(fenced[1] if fenced else body):
            value, note = load_object(span)
            if value is not None:
                shaped, notes = normalise(value)
                return shaped, [note] * bool(note) + notes
    return normalise({})[0], ["json_parse_failed"]


#: Checks of an entity in the order of their warnings: code, groups (None: all), whether it is wrong.
ENTITY_CHECKS = (
    ("invalid_source_field", None, lambda t, e: e["source_field"] not in FIELDS),
    ("missing_evidence", None, lambda t, e: not e["evidence"] or e["evidence"] not in t[e["source_field"]]),
    ("surface_evidence_mismatch", None, lambda t, e: e["surface"] and e["evidence"] and e["surface"] not in e["evidence"] and e["evidence"] not in e["surface"]),
    ("empty_canonical", None, lambda t, e: not e["canonical"]),
    ("generic_entity", None, lambda t, e: e["canonical"] in GENERIC or e["surface"] in GENERIC),
    ("duplicate_entity", None, None),  # needs the group, see validate
    ("road_poi_conflict", ("roads",), lambda t, e: not w.is_road(e["canonical"])),
    ("intersection_shape_conflict", ("intersections",), lambda t, e: not w.is_crossing(e["evidence"] or e["surface"] or e["canonical"])),
    ("poi_shape_conflict", ("pois",), lambda t, e: w.is_no_place(e["surface"]) or w.is_no_place(e["canonical"])),
    ("request_action_as_behavior", ("problem_behaviors",), w.only_requested),
    ("normal_service_action_as_behavior", ("problem_behaviors",), lambda t, e: not w.only_requested(t, e) and w.is_service(e)),
    ("canonical_evidence_conflict", None, lambda t, e: w.name_conflicts(e)),
)
TALK_CHECKS = (
    ("missing_evidence", None, lambda t, x: not t.field_with(x["evidence"])),
    ("unsupported_intent_evidence", ("intents",), lambda t, x: not w.intent_holds(x["label"], x["evidence"])),
    ("object_attitude_as_emotion", ("emotions",), lambda t, x: w.has(x["evidence"], w.OBJECT_ATTITUDES)),
    ("unsupported_emotion_evidence", ("emotions",), lambda t, x: not w.has(x["evidence"], w.OBJECT_ATTITUDES) and not w.emotion_holds(t, x["label"], x["evidence"])),
)
#: Checks of satisfaction (m) and urgency (u).
STATEMENT_CHECKS = (
    ("satisfaction_missing_target_or_evidence", lambda t, m, u: m["label"] != "unknown" and not (m["target"] and m["evidence"])),
    ("invalid_satisfaction_target", lambda t, m, u: m["label"] != "unknown" and m["target"] in NO_TARGETS),
    ("template_politeness_as_satisfaction", lambda t, m, u: m["label"] != "unknown" and m["evidence"] in POLITENESS),
    ("unsupported_satisfaction_evidence", lambda t, m, u: not w.satisfaction_holds(m["label"], m["evidence"])),
    ("missing_evidence:discourse.satisfaction", lambda t, m, u: m["evidence"] and not t.field_with(m["evidence"])),
    ("urgency_missing_evidence", lambda t, m, u: u["level"] != "normal" and not u["evidence"]),
    ("missing_evidence:discourse.urgency", lambda t, m, u: u["evidence"] and not t.field_with(u["evidence"])),
    ("template_priority_as_urgency", lambda t, m, u: u["level"] != "normal" and u["evidence"] in PRIORITY),
)
#: Checks of the record as a whole: what the texts show and the output lacks or mistakes.
WHOLE_CHECKS = (
    ("semantic_gap:problem_objects", lambda t, r: t.has(w.ANOMALIES) and not r["entities"]["problem_objects"]),
    ("semantic_gap:problem_behaviors", lambda t, r: t.has(w.ANOMALIES) and not r["entities"]["problem_behaviors"]),
    ("semantic_gap:pois", lambda t, r: t.has(w.POI_GAPS) and not r["entities"]["pois"]),
    ("possible_history_contamination", lambda t, r: w.has(t[FIELDS[0]], w.HISTORY) and w.has(t[FIELDS[0]], w.CURRENT) and w.has(r["event_summary"], w.SETTLED_SUMMARY) and not w.has(r["event_summary"], w.OPEN_SUMMARY)),
)


def status_of(codes: list[str]) -> str:
    """The gravest kind of warning decides."""
    for status, starts in (("rejected", REJECTS), ("repair_required", REPAIRS)):
        if any(c.startswith(starts) for c in codes):
            return status
    return "accepted_with_warnings" if codes else "accepted"


def validate(order: dict, found: dict, notes: list[str]) -> tuple[str, list[str]]:
    """(status, ordered unique warnings): every check of the tables above, in their order."""
    texts, out = Texts(order), list(notes)
    out += ["missing_doc_id"] * ("doc_id" in order and not _text(order["doc_id"]))
    out += ["empty_semantic_text"] * (not texts.joined)
    out += ["empty_event_summary"] * (not found["event_summary"])
    for group, items in found["entities"].items():
        names = [(e["canonical"], e["evidence"]) for e in items]
        for k, e in enumerate(items):
            for code, groups, wrong in ENTITY_CHECKS:
                if (groups is None or group in groups) and (wrong(texts, e) if wrong else names[k] in names[:k]):
                    out.append(f"{code}:entities.{group}.{k}")
    talk = found["discourse"]
    for group in ("intents", "emotions"):
        for k, item in enumerate(talk[group]):
            out += [f"{code}:discourse.{group}.{k}" for code, groups, wrong in TALK_CHECKS if (groups is None or group in groups) and wrong(texts, item)]
    out += [code for code, wrong in STATEMENT_CHECKS if wrong(texts, talk["satisfaction"], talk["urgency"])]
    out += [code for code, wrong in WHOLE_CHECKS if wrong(texts, found)]
    codes = list(dict.fromkeys(out))
    return status_of(codes), codes


def repair_fields(warnings: Column) -> Column:
    """Paths that a repair should look at, ordered and unique, from a warnings column."""

    def of(code: Column) -> Column:
        path = F.regexp_extract(code, r"^[^:]*:((?:entities|discourse)\..*)$", 1)
        whole = F.when(code.contains("satisfaction"), "discourse.satisfaction").when(code.contains("urgency"), "discourse.urgency")
        whole = whole.when(code.isin("empty_event_summary", "possible_history_contamination"), "event_summary")
        return F.coalesce(F.nullif(path, F.lit("")), whole)

    return F.array_distinct(F.array_compact(F.transform(warnings, of)))


_ENTITY = "array<struct<surface:string,canonical:string,source_field:string,evidence:string>>"
SEMANTIC = (
    "event_summary string, entities struct<" + ",".join(f"{g}:{_ENTITY}" for g in GROUPS) + ">, discourse struct<intents:array<struct<label:string,evidence:string,intensity:int>>,"
    "emotions:array<struct<label:string,evidence:string,intensity:int>>,satisfaction:struct<label:string,target:string,evidence:string>,urgency:struct<level:string,evidence:string>>, status string, warnings array<string>"
)


def judged(rows: DataFrame, judge, response: str = "response") -> DataFrame:
    """One Arrow pass over orders with responses; ``judge(order, response)`` gives (record, status, warnings)."""
    schema = f"doc_id string, content_hash string, {SEMANTIC}"
    kind = to_arrow_schema(StructType.fromDDL(schema))
    names = ["doc_id", "content_hash", *FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                cells = (c.to_pylist() for c in b.slice(lo, 1000).columns)
                out = []
                for *cell, text in zip(*cells, strict=True):
                    order = dict(zip(names, cell, strict=True))
                    record, status, codes = judge(order, text)
                    out.append({"doc_id": order["doc_id"], "content_hash": order["content_hash"], **record, "status": status, "warnings": codes})
                yield pa.RecordBatch.from_pylist(out, schema=kind)

    return rows.select(*names, response).mapInArrow(run, schema)


def read_responses(rows: DataFrame, response: str = "response") -> DataFrame:
    """Orders with a model response each to semantic records (one Arrow pass, no shuffle).

    ``rows`` has doc_id, content_hash, the four clean fields and ``response``.
    """

    def judge(order: dict, text) -> tuple[dict, str, list[str]]:
        found, notes = parse_response(text)
        return found, *validate(order, found, notes)

    return judged(rows, judge, response)


# --- fixed values: entity type of each group ---
TYPES = {"problem_objects": "problem_object", "problem_behaviors": "problem_behavior", "roads": "road", "intersections": "intersection", "pois": "poi"}
ACCEPTED = ("accepted", "accepted_with_warnings")


def project_links(records: DataFrame) -> DataFrame:
    """Link rows of accepted records; links carry no confidence."""
    link = lambda kind: lambda e: F.struct(F.lit(kind).alias("entity_type"), e["canonical"].alias("entity_value"), e["source_field"].alias("source_field"), e["evidence"].alias("matched_text"))
    tagged = [F.transform(f"entities.{g}", link(kind)) for g, kind in TYPES.items()]
    rows = records.filter(F.col("status").isin(*ACCEPTED)).select("doc_id", F.explode(F.concat(*tagged)).alias("l"))
    return rows.select("doc_id", "l.*", F.lit("semantic").alias("source_channel")).filter("entity_value <> ''")


def project_discourse(records: DataFrame) -> DataFrame:
    """One row a record: intents and emotions as JSON texts, satisfaction, urgency, conflict flag."""
    labels = lambda c: F.to_json(F.transform(c, lambda x: x["label"]))
    both = F.exists("discourse.intents", lambda x: x["label"] == "表扬") & F.exists("discourse.intents", lambda x: x["label"].isin("投诉", "举报"))
    return records.select("doc_id", "event_summary", labels("discourse.intents").alias("inferred_intents_json"), labels("discourse.emotions").alias("emotions_json"), F.col("discourse.satisfaction.label").alias("satisfaction"), F.col("discourse.urgency.level").alias("urgency"), both.cast("string").alias("intent_conflict"))


def quality_report(records: DataFrame) -> DataFrame:
    """(section, key, n): status and warning-code histograms and group sizes, in one pass."""
    code = lambda w: F.regexp_extract(w, "^[^:]*", 0)
    entry = lambda section, key: F.struct(F.lit(section).alias("section"), key.alias("key"))
    entries = F.concat(F.array(entry("status", F.col("status"))), F.transform("warnings", lambda w: entry("warning", code(w))), *(F.array(entry(g, F.size(f"entities.{g}").cast("string"))) for g in GROUPS))
    return records.select(F.explode(entries).alias("e")).select("e.*").groupBy("section", "key").agg(F.count(F.lit(1)).alias("n"))


def extract(orders: DataFrame, generate, done: DataFrame | None = None, repair: bool = True) -> DataFrame:
    """Two-phase extraction: primary responses, then one repair of those that need it.

    ``generate(frame, phase)`` is a DataFrame function that adds ``response``
    (a model behind ``mapInPandas``, or a fake in tests). ``done`` has the
    accepted identities (doc_id, content_hash), which are skipped. Responses
    go through recovery and removal to a fixed point. What a model said is
    written once a phase, so no action asks it again.
    """
    from caseloom.semantic.repair import read_and_settle

    todo = orders.join(done.select("doc_id", "content_hash"), ["doc_id", "content_hash"], "left_anti") if done is not None else orders
    first = settle(read_and_settle(generate(todo, "primary")), "semantic-primary")
    if not repair:
        return first
    needy = todo.join(first.filter("status = 'repair_required'").select("doc_id", "content_hash"), ["doc_id", "content_hash"], "left_semi")
    second = settle(read_and_settle(generate(needy, "repair")), "semantic-repair")
    failed = F.array_union(F.array(F.lit("repair_failed")), F.col("warnings"))
    second = second.withColumn("warnings", F.when(F.col("status") == "repair_required", failed).otherwise(F.col("warnings"))).withColumn("status", F.when(F.col("status") == "repair_required", "rejected").otherwise(F.col("status")))
    return first.filter("status <> 'repair_required'").unionByName(second)
