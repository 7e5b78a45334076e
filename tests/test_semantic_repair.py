"""Recovery and removal on small records."""

import pytest

from caseloom.semantic import repair, words
from caseloom.semantic.parse import normalise, parse_response, validate


def order(**fields):
    return {"doc_id": "d", "case_content_clean": "", "title_clean": "", "case_goal_clean": "", "address_detail_clean": ""} | fields


def settled(o, value):
    record, notes = normalise({"event_summary": "s"} | value)
    return repair.settle_record(o, record, notes)


def test_string_entity_is_recovered():
    o = order(case_content_clean="人民路有积水")
    record, status, codes = settled(o, {"entities": {"roads": ["人民路"]}})
    assert record["entities"]["roads"][0]["source_field"] == "case_content_clean"
    assert status == "accepted_with_warnings" and "recovered_entity_string:entities.roads.0" in codes


def test_unproven_entity_is_dropped():
    bad = {"surface": "x", "canonical": "x", "source_field": "case_content_clean", "evidence": "不在"}
    record, status, codes = settled(order(case_content_clean="有积水"), {"entities": {"pois": [bad]}})
    assert record["entities"]["pois"] == [] and status == "accepted_with_warnings"
    assert "dropped_invalid_candidate:entities.pois.0" in codes


def test_intents():
    o = order(case_content_clean="市民投诉噪音，希望处理")
    record, _, codes = settled(o, {"discourse": {"intents": [{"label": "求助", "evidence": "希望"}, {"label": "表扬", "evidence": "x"}]}})
    assert [(x["label"], x["evidence"]) for x in record["discourse"]["intents"]] == [("投诉", "投诉")]
    assert {"dropped_unsupported_intent:discourse.intents.1", "replaced_weak_intent:投诉", "recovered_explicit_intent:投诉"} <= set(codes)


@pytest.mark.parametrize(
    ("text", "label", "word"),
    [("市民表示非常气愤", "愤怒", "非常气愤"), ("商家非常气愤", "愤怒", ""), ("市民不认可", "认可", ""), ("其不认可", "不满", "其不认可"), ("市民对此表示认可", "认可", "认可")],
)
def test_emotion_owner(text, label, word):
    assert words.emotion_in(words.Texts(order(case_content_clean=text)), label)[0] == word


@pytest.mark.parametrize(("text", "want"), [("不是很满意", (False, True)), ("满意", (True, False)), ("满意但不认可", (True, True)), ("满意度不高", (False, True)), ("无", (False, False))])
def test_polarity(text, want):
    assert words.polarity(text) == want


def test_statements_are_reset():
    value = {"discourse": {"satisfaction": {"label": "satisfied", "target": "本人", "evidence": "谢谢"}, "urgency": {"level": "high", "evidence": ""}}}
    record, status, codes = settled(order(case_content_clean="谢谢"), value)
    assert record["discourse"]["satisfaction"]["label"] == "unknown" and record["discourse"]["urgency"]["level"] == "normal"
    assert {"reset_unverified_satisfaction", "reset_unverified_urgency"} <= set(codes) and status == "accepted_with_warnings"


def test_failed_and_empty_records():
    record, notes = parse_response("{")
    assert repair.settle_record(order(case_content_clean="投诉"), record, notes)[1] == "repair_required"
    assert settled(order(), {})[1] == "rejected"
    assert validate(order(case_content_clean="x"), *normalise({"event_summary": "s"}))[0] == "accepted"


def test_variants_merge():
    e = lambda canonical: {"surface": "摊", "canonical": canonical, "source_field": "case_content_clean", "evidence": "摊"}
    record, _, codes = settled(order(case_content_clean="摊"), {"entities": {"problem_objects": [e("摊"), e("流动摊贩")]}})
    assert [x["canonical"] for x in record["entities"]["problem_objects"]] == ["流动摊贩"]
    assert "deduplicated_entity_variant:entities.problem_objects.1" in codes
