"""Recovery of what a record's own text proves, removal of what it does not, to a fixed point.

A record is opened into claims: an entity, an intent or an emotion each, with
its place. Two tables say what happens to a claim: ``RECOVERIES`` by group
(what the texts prove instead) and ``REMOVALS`` by warning code (what becomes
of a claim that validation names). One engine applies either, notes what it
did and closes the record again; rules about a whole group stand beside them.
All of it is per record and runs inside the same Arrow pass as parsing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame

from caseloom.semantic import words as w
from caseloom.semantic.parse import GROUPS, MAX_INTENTS, judged, parse_response, validate
from caseloom.semantic.words import Texts

# --- fixed values: codes that unset a statement, labels sought in this order ---
SATISFACTION_CODES = ("satisfaction_missing_target_or_evidence", "invalid_satisfaction_target", "template_politeness_as_satisfaction", "unsupported_satisfaction_evidence", "missing_evidence:discourse.satisfaction")
URGENCY_CODES = ("urgency_missing_evidence", "template_priority_as_urgency", "missing_evidence:discourse.urgency")
EXPLICIT_INTENTS = ("投诉", "举报", "催办", "建议", "咨询", "表扬")
IMPLIED_INTENTS = ("咨询", "催办", "求助")
#: Codes with which a parse or a summary is beyond removal.
FINAL_CODES = ("json_parse_failed", "possible_history_contamination")


@dataclass(frozen=True)
class Claim:
    """One item of a record, at position ``at`` of ``section.group``."""

    section: str
    group: str
    at: int
    item: dict

    @property
    def path(self) -> str:
        return f"{self.section}.{self.group}.{self.at}"

    def with_item(self, **changes) -> Claim:
        return Claim(self.section, self.group, self.at, self.item | changes)


#: What a rule makes of a claim: the claim to keep (None: it goes) and a note, if it acted.
Outcome = tuple[Claim | None, str]


def open_record(record: dict) -> list[Claim]:
    lists = [("entities", g, x) for g, x in record["entities"].items()] + [("discourse", g, record["discourse"][g]) for g in ("intents", "emotions")]
    return [Claim(section, group, k, item) for section, group, items in lists for k, item in enumerate(items)]


def close_record(record: dict, claims: Iterable[Claim], **statements: dict) -> dict:
    held: dict[tuple[str, str], list[dict]] = {}
    for c in claims:
        held.setdefault((c.section, c.group), []).append(c.item)
    talk = {g: held.get(("discourse", g), []) for g in ("intents", "emotions")}
    return record | {"entities": {g: held.get(("entities", g), []) for g in record["entities"]}, "discourse": record["discourse"] | talk | statements}


def through(claims: list[Claim], rules_of: Callable[[Claim], Iterable[Callable[[Claim], Outcome]]]) -> tuple[list[Claim], list[str]]:
    """Each claim through its rules until one drops it; what is left, and the notes."""
    kept, notes = [], []
    for claim in claims:
        now: Claim | None = claim
        for rule in rules_of(claim):
            now, note = rule(now)
            notes += [f"{note}:{claim.path}"] * bool(note)
            if now is None:
                break
        if now is not None:
            kept.append(now)
    return kept, notes


# --- recovery of single claims ---
def relocate_string(t: Texts, coerced: set[str], c: Claim) -> Outcome:
    """An entity given as a bare string stands where its text is, if its shape fits the group."""
    field = t.field_with(c.item["evidence"]) if f"{c.group}:{c.at}" in coerced and w.fits_group(c.group, c.item["evidence"]) else ""
    return (c.with_item(source_field=field), "recovered_entity_string") if field else (c, "")


def shorten_road(t: Texts, coerced: set[str], c: Claim) -> Outcome:
    """A road with a direction or number after it is that road."""
    e = c.item
    road = "" if w.is_road(e["canonical"]) or not e["evidence"] or e["evidence"] not in t[e["source_field"]] else w.road_of(e["canonical"], e["surface"])
    return (c.with_item(surface=road, canonical=road), "recovered_named_road") if road else (c, "")


def prove_intent(t: Texts, coerced: set[str], c: Claim) -> Outcome:
    """An intent keeps evidence that proves it, gets a word of the texts that does, or goes."""
    label, evidence = c.item["label"], c.item["evidence"]
    if t.field_with(evidence) and w.intent_holds(label, evidence):
        return c, ""
    word = t.first_word(w.INTENT_WORDS.get(label, ()))
    return (c.with_item(evidence=word), "recovered_intent_evidence") if word else (None, "dropped_unsupported_intent")


def prove_emotion(t: Texts, coerced: set[str], c: Claim) -> Outcome:
    """An emotion likewise, if the caller is said to have it."""
    if w.emotion_holds(t, c.item["label"], c.item["evidence"]):
        return c, ""
    word, level = w.emotion_in(t, c.item["label"])
    return (c.with_item(evidence=word, intensity=level), "recovered_emotion_evidence") if word else (None, "dropped_unsupported_emotion")


RECOVERIES = {g: (relocate_string,) for g in GROUPS} | {"roads": (relocate_string, shorten_road), "intents": (prove_intent,), "emotions": (prove_emotion,)}


# --- rules about a whole group ---
def settle_intents(t: Texts, claims: list[Claim]) -> tuple[list[Claim], list[str]]:
    """One intent a label; an intent the texts name stands, and a weak plea for help yields to it."""
    by_label = {c.item["label"]: c for c in reversed(claims)}
    intents = sorted(by_label.values(), key=lambda c: c.at)
    new = lambda label, word: Claim("discourse", "intents", -1, {"label": label, "evidence": word, "intensity": 1})
    named = next(((x, word) for x in EXPLICIT_INTENTS if (word := t.first_word(w.LITERAL_WORDS[x]))), None)
    if named is None:
        implied = None if intents else next(((x, word) for x in IMPLIED_INTENTS if (word := t.first_word(w.INTENT_WORDS[x]))), None)
        return ([new(*implied)], [f"recovered_explicit_intent:{implied[0]}"]) if implied else (intents, [])
    strong = [c for c in intents if c.item["label"] != "求助" or c.item["evidence"] not in w.WEAK_HELP]
    notes = [f"replaced_weak_intent:{named[0]}"] * (len(strong) < len(intents))
    if named[0] not in by_label:
        strong, notes = [new(*named), *strong], [*notes, f"recovered_explicit_intent:{named[0]}"]
    return strong[:MAX_INTENTS], notes


def settle_emotions(t: Texts, claims: list[Claim]) -> tuple[list[Claim], list[str]]:
    """Without an emotion, the first that the caller is said to have, thanks and recognition aside."""
    found = None if claims else next(((x, *hit) for x in w.UNASKED_EMOTIONS if (hit := w.emotion_in(t, x))[0]), None)
    if found is None:
        return claims, []
    label, word, level = found
    return [Claim("discourse", "emotions", 0, {"label": label, "evidence": word, "intensity": level})], [f"recovered_explicit_emotion:{label}"]


def add_crossings(t: Texts, roads: list[Claim], crossings: list[Claim]) -> tuple[list[Claim], list[str]]:
    """Crossings that a field names of two proven roads of that field, up to the group's limit."""
    proven = [c.item for c in roads if w.is_road(c.item["canonical"]) and c.item["evidence"] and c.item["evidence"] in t[c.item["source_field"]] and c.item["canonical"] in c.item["surface"] + c.item["evidence"]]
    out, notes = list(crossings), []
    for one, other in combinations(proven, 2):
        span = w.crossing_in(t[one["source_field"]], one["canonical"], other["canonical"]) if one["source_field"] == other["source_field"] else ""
        known = {(c.item["source_field"], c.item["evidence"]) for c in out}
        if span and (one["source_field"], span) not in known and (not notes or len(out) < GROUPS["intersections"]):
            notes.append(f"synthesized_intersection:entities.intersections.{len(out)}")
            out.append(Claim("entities", "intersections", len(out), {"surface": span, "canonical": span, "source_field": one["source_field"], "evidence": span}))
    return out, notes


def one_of_variants(claims: list[Claim]) -> tuple[list[Claim], list[str]]:
    """Of entities that say the same of the same words one stays.

    Two entities of a group with equal field, evidence and surface are variants
    if either is named by the bare surface or one name holds the other. The
    later one joins the first of its kind; a name beyond the surface is
    preferred, then the shorter.
    """
    told = lambda c: (c.group, c.item["source_field"], c.item["evidence"], c.item["surface"])
    plain = lambda c: (c.item["canonical"] == c.item["surface"], len(c.item["canonical"]))
    leaders: dict[tuple, int] = {}
    out, notes = [], []
    for c in claims:
        at = leaders.setdefault(told(c), len(out)) if c.section == "entities" else len(out)
        if at < len(out):
            a, b = out[at].item["canonical"], c.item["canonical"]
            if c.item["surface"] in (a, b) or a in b or b in a:
                out[at] = min(out[at], c, key=plain)
                notes.append(f"deduplicated_entity_variant:{c.path}")
                continue
        out.append(c)
    return out, notes


def within_limits(claims: list[Claim]) -> tuple[list[Claim], list[str]]:
    out, notes, n = [], {}, dict.fromkeys(GROUPS, 0)
    for c in claims:
        if c.section == "entities" and n[c.group] >= GROUPS[c.group]:
            notes[f"truncated_group_to_limit:{c.group}"] = None
            continue
        n[c.group] = n.get(c.group, 0) + 1
        out.append(c)
    return out, list(notes)


def _renumbered(claims: list[Claim]) -> list[Claim]:
    n: dict[str, int] = {}
    out = []
    for c in claims:
        out.append(Claim(c.section, c.group, n.setdefault(c.group, 0), c.item))
        n[c.group] += 1
    return out


def recover(order: dict, record: dict, notes: list[str]) -> tuple[dict, list[str]]:
    """What the texts prove is added or corrected; unprovable intents and emotions go."""
    t = Texts(order)
    coerced = {note.partition(":")[2] for note in notes if note.startswith("coerced_entity_string:")}
    claims, did = through(open_record(record), lambda c: [lambda x, r=r: r(t, coerced, x) for r in RECOVERIES[c.group]])
    group = lambda name: [c for c in claims if c.group == name]
    intents, more = settle_intents(t, group("intents"))
    did += more
    emotions, more = settle_emotions(t, group("emotions"))
    did += more

    mood, haste = record["discourse"]["satisfaction"], record["discourse"]["urgency"]
    if mood["label"] in ("satisfied", "dissatisfied") and not w.satisfaction_holds(mood["label"], mood["evidence"]):
        sides = w.SATISFIED if mood["label"] == "satisfied" else w.DISSATISFIED
        word = next((x for text in t.by_field.values() if w.satisfaction_holds(mood["label"], text) for x in sides if x in text), "")
        mood, did = (mood | {"evidence": word}, [*did, "recovered_satisfaction_evidence"]) if word else (mood, did)
    if haste["level"] == "normal" and haste["evidence"]:
        haste, did = haste | {"evidence": ""}, [*did, "cleared_normal_urgency_evidence"]

    crossings, more = add_crossings(t, group("roads"), group("intersections"))
    did += more
    entities = [c for c in claims if c.section == "entities" and c.group != "intersections"] + crossings
    entities, more = one_of_variants(entities)
    return close_record(record, [*entities, *intents, *emotions], satisfaction=mood, urgency=haste), [*did, *more]


# --- removal, by warning code ---
def drop(t: Texts, c: Claim) -> Outcome:
    return None, "dropped_invalid_candidate" if c.section == "entities" else "dropped_unverified_evidence"


def align_surface(t: Texts, c: Claim) -> Outcome:
    return c.with_item(surface=c.item["evidence"]), "aligned_surface_to_evidence"


def relocate(t: Texts, c: Claim) -> Outcome:
    field = t.field_with(c.item["evidence"])
    return (c.with_item(source_field=field), "recovered_entity_source") if field else drop(t, c)


def drop_unless_found(t: Texts, c: Claim) -> Outcome:
    """An entity may have been relocated since the warning."""
    found = c.section == "entities" and c.item["evidence"] and c.item["evidence"] in t[c.item["source_field"]]
    return (c, "") if found else drop(t, c)


REMOVALS = {
    "invalid_source_field": relocate,
    "missing_evidence": drop_unless_found,
    "surface_evidence_mismatch": align_surface,
} | dict.fromkeys(
    (
        "empty_canonical", "generic_entity", "duplicate_entity", "road_poi_conflict", "intersection_shape_conflict", "poi_shape_conflict", "request_action_as_behavior",
        "normal_service_action_as_behavior", "canonical_evidence_conflict", "unsupported_intent_evidence", "object_attitude_as_emotion", "unsupported_emotion_evidence",
    ),
    drop,
)


def remove(order: dict, record: dict, codes: list[str]) -> tuple[dict, list[str]]:
    """Claims and statements that warnings name go or are aligned; the event stays."""
    t = Texts(order)
    named: dict[str, list[Callable]] = {}
    for code in codes:
        name, _, path = code.partition(":")
        if name in REMOVALS:
            named.setdefault(path, []).append(REMOVALS[name])
    claims, did = through(open_record(record), lambda c: [lambda x, r=r: r(t, x) for r in named.get(c.path, ())])
    for rule in (one_of_variants, within_limits):
        claims, more = rule(_renumbered(claims))
        did += more
    statements: dict[str, dict] = {}
    if set(codes) & set(SATISFACTION_CODES):
        statements["satisfaction"] = {"label": "unknown", "target": "", "evidence": ""}
        did.append("reset_unverified_satisfaction")
    if set(codes) & set(URGENCY_CODES):
        statements["urgency"] = {"level": "normal", "evidence": ""}
        did.append("reset_unverified_urgency")
    return close_record(record, claims, **statements), did


def settle_record(order: dict, record: dict, notes: list[str], rounds: int = 3) -> tuple[dict, str, list[str]]:
    """(record, status, warnings) after recovery and at most ``rounds`` of removal.

    A failed parse and a summary that mistakes history need a new response and
    are left alone; a rejected record stays rejected whatever was recovered.
    """
    record, did = recover(order, record, notes)
    status, codes = validate(order, record, notes)
    while rounds and status == "repair_required" and not set(codes) & set(FINAL_CODES):
        after, more = remove(order, record, codes)
        did += more
        if not more or after == record:
            break
        record, rounds = after, rounds - 1
        status, codes = validate(order, record, notes)
    if did and status in ("accepted", "accepted_with_warnings"):
        return record, "accepted_with_warnings", list(dict.fromkeys([*did, *codes]))
    return record, status, codes


def read_and_settle(rows: DataFrame, response: str = "response") -> DataFrame:
    """Like ``read_responses``, with recovery and removal before the status is set."""

    def judge(order: dict, text) -> tuple[dict, str, list[str]]:
        return settle_record(order, *parse_response(text))

    return judged(rows, judge, response)
