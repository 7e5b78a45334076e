"""Small orders with model responses that reach every warning code, and what must come out."""

from __future__ import annotations

import json


def _entity(surface: str, canonical: str | None = None, evidence: str | None = None, field: str = "case_content_clean") -> dict:
    return {"surface": surface, "canonical": surface if canonical is None else canonical, "source_field": field, "evidence": surface if evidence is None else evidence}


def _response(summary: str = "积水", talk: dict | None = None, **entities: list) -> str:
    return json.dumps({"event_summary": summary, "entities": entities, "discourse": talk or {}}, ensure_ascii=False)


def _mood(label: str, target: str, evidence: str) -> dict:
    return {"satisfaction": {"label": label, "target": target, "evidence": evidence}}


#: (id, content, response, status, warnings) under validation alone.
VALIDATED = (
    ("clean", "人民路积水", _response(roads=[_entity("人民路")]), "accepted", ()),
    ("poi_as_road", "万达广场门口积水", _response(roads=[_entity("万达广场")]), "repair_required", ("road_poi_conflict:entities.roads.0", "semantic_gap:pois")),
    ("one_road", "人民路积水", _response(intersections=[_entity("人民路")]), "repair_required", ("intersection_shape_conflict:entities.intersections.0",)),
    ("area_as_poi", "鹿城区积水", _response(pois=[_entity("鹿城区")]), "repair_required", ("poi_shape_conflict:entities.pois.0",)),
    ("request", "希望处理", _response(problem_behaviors=[_entity("处理", evidence="希望处理")]), "repair_required", ("request_action_as_behavior:entities.problem_behaviors.0",)),
    ("fact", "一直未处理", _response(problem_behaviors=[_entity("未处理")]), "accepted_with_warnings", ("semantic_gap:problem_objects",)),
    ("service", "市民咨询社保", _response(problem_behaviors=[_entity("咨询社保")]), "repair_required", ("normal_service_action_as_behavior:entities.problem_behaviors.0",)),
    ("name", "严重影响采光", _response(problem_behaviors=[_entity("严重影响采光", canonical="严重影响通风")]), "repair_required", ("canonical_evidence_conflict:entities.problem_behaviors.0",)),
    ("attitude", "服务态度恶劣", _response(talk={"emotions": [{"label": "愤怒", "evidence": "态度恶劣"}]}), "repair_required", ("object_attitude_as_emotion:discourse.emotions.0",)),
    ("emotion", "商家非常气愤", _response(talk={"emotions": [{"label": "愤怒", "evidence": "非常气愤"}]}), "repair_required", ("unsupported_emotion_evidence:discourse.emotions.0",)),
    ("mood", "积水", _response(talk=_mood("satisfied", "", "")), "repair_required", ("satisfaction_missing_target_or_evidence", "unsupported_satisfaction_evidence")),
    ("mood_target", "市民满意", _response(talk=_mood("satisfied", "市民", "满意")), "repair_required", ("invalid_satisfaction_target",)),
    ("mood_polite", "谢谢", _response(talk=_mood("satisfied", "答复", "谢谢")), "repair_required", ("template_politeness_as_satisfaction", "unsupported_satisfaction_evidence")),
    ("mood_evidence", "积水", _response(talk=_mood("satisfied", "答复", "满意")), "repair_required", ("missing_evidence:discourse.satisfaction",)),
    ("haste", "积水", _response(talk={"urgency": {"level": "high", "evidence": ""}}), "repair_required", ("urgency_missing_evidence",)),
    ("haste_template", "请优先处理", _response(talk={"urgency": {"level": "high", "evidence": "优先处理"}}), "repair_required", ("template_priority_as_urgency",)),
    ("haste_evidence", "积水", _response(talk={"urgency": {"level": "high", "evidence": "紧急"}}), "repair_required", ("missing_evidence:discourse.urgency",)),
    ("intent", "市民反映积水", _response(talk={"intents": [{"label": "投诉", "evidence": "市民"}]}), "accepted_with_warnings", ("unsupported_intent_evidence:discourse.intents.0",)),
    ("intent_evidence", "积水", _response(talk={"intents": [{"label": "投诉", "evidence": "投诉"}]}), "repair_required", ("missing_evidence:discourse.intents.0",)),
    ("evidence", "积水", _response(problem_objects=[_entity("井盖")]), "repair_required", ("missing_evidence:entities.problem_objects.0",)),
    ("field", "积水", _response(problem_objects=[_entity("积水", field="title")]), "repair_required", ("invalid_source_field:entities.problem_objects.0", "missing_evidence:entities.problem_objects.0")),
    ("surface", "路面积水", _response(problem_objects=[_entity("井盖", canonical="积水", evidence="积水")]), "repair_required", ("surface_evidence_mismatch:entities.problem_objects.0",)),
    ("unnamed", "积水", _response(problem_objects=[_entity("积水", canonical="")]), "repair_required", ("empty_canonical:entities.problem_objects.0",)),
    ("generic", "积水问题", _response(problem_objects=[_entity("问题")]), "repair_required", ("generic_entity:entities.problem_objects.0",)),
    ("twice", "积水", _response(problem_objects=[_entity("积水"), _entity("积水")]), "repair_required", ("duplicate_entity:entities.problem_objects.1",)),
    ("gaps", "小区路灯破损", _response(), "accepted_with_warnings", ("semantic_gap:problem_objects", "semantic_gap:problem_behaviors", "semantic_gap:pois")),
    ("history", "部门答复已清理，其不认可", _response(summary="已处理"), "repair_required", ("possible_history_contamination",)),
    ("no_summary", "积水", _response(summary=" "), "repair_required", ("empty_event_summary",)),
    ("no_text", "", _response(), "rejected", ("empty_semantic_text",)),
    ("", "积水", _response(), "rejected", ("missing_doc_id",)),
    ("cut", "积水", "{", "repair_required", ("json_parse_failed", "empty_event_summary")),
)

#: The same after recovery and removal to a fixed point.
SETTLED = (
    ("road_tail", "人民路12号积水", _response(roads=[_entity("人民路12号")]), "accepted_with_warnings", ("recovered_named_road:entities.roads.0",)),
    ("crossing", "人民路与解放街交叉口积水", _response(roads=[_entity("人民路"), _entity("解放街")]), "accepted_with_warnings", ("synthesized_intersection:entities.intersections.0",)),
    ("poi_as_road", "万达广场门口积水", _response(roads=[_entity("万达广场")]), "accepted_with_warnings", ("dropped_invalid_candidate:entities.roads.0", "semantic_gap:pois")),
    ("bare_poi", "人民医院积水", json.dumps({"event_summary": "积水", "entities": {"pois": ["人民医院"]}}, ensure_ascii=False), "accepted_with_warnings", ("recovered_entity_string:entities.pois.0", "coerced_entity_string:pois:0")),
    ("attitude", "服务态度恶劣", _response(talk={"emotions": [{"label": "愤怒", "evidence": "态度恶劣"}]}), "accepted_with_warnings", ("dropped_unsupported_emotion:discourse.emotions.0",)),
    ("weak_help", "市民投诉噪音，希望降低", _response(talk={"intents": [{"label": "求助", "evidence": "希望"}]}), "accepted_with_warnings", ("replaced_weak_intent:投诉", "recovered_explicit_intent:投诉")),
    ("haste", "积水", _response(talk={"urgency": {"level": "high", "evidence": ""}}), "accepted_with_warnings", ("reset_unverified_urgency",)),
    ("history", "部门答复已清理，其不认可", _response(summary="已处理"), "repair_required", ("possible_history_contamination",)),
)
