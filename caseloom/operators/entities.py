"""Rule-based entity extraction from documents, in column expressions.

Metadata fields and four texts each yield an array of candidate links; one
explode turns them into rows and the first of equal links (by ordinal) stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.text import clean, squeeze

# --- fixed values: dictionaries, suffixes and confidences ---
AREAS = ("钟楼区", "天宁区", "新北区", "武进区", "金坛区", "溧阳市", "常州市经济开发区", "经开区", "市本级")
OBJECTS = ("流动摊贩", "游商摊贩", "夜市摊贩", "摊贩", "小摊", "商贩")
BEHAVIORS = ("占道经营", "无照经营", "店外经营", "影响通行", "摆摊", "设摊", "扰民", "油烟")
OBJECT_ALIASES = {"卖菜摊子": "流动摊贩", "卖菜摊": "流动摊贩", "卖菜的": "流动摊贩", "路边摊": "流动摊贩", "流摊": "流动摊贩", "摊子": "流动摊贩", "摊点": "流动摊贩"}
BEHAVIOR_ALIASES = {"挡住人行道": "占道经营", "堵住人行道": "占道经营", "占用道路": "占道经营", "占用人行道": "占道经营", "占路经营": "占道经营", "影响通行": "影响通行"}
GENERIC = ("路", "街", "桥", "线", "巷", "弄", "道路", "关于道路", "政风热线", "常州12345热线", "12345热线", "小区", "关于小区", "导致小区", "该小区", "现小区", "市场", "要求市场", "本人要求市场", "其表示街道", "根据街道", "我街道", "关于街道")
GENERIC_PREFIXES = ("关于", "反映", "服务对象", "其表示", "本人要求", "希望", "要求", "导致", "现")
_NAME = r"[\x{4E00}-\x{9FFF}A-Za-z0-9]"
_ROAD_END = "(?:路|街|大道|巷|弄|桥|线)"
ROAD = _NAME + "{1,12}?" + _ROAD_END
STREET = _NAME + "{1,12}(?:街道|镇)"
CROSSING = f"({_NAME}{{1,12}}{_ROAD_END})(?:和|与|及|、)({_NAME}{{1,12}}{_ROAD_END})(?:交叉口|交界处|路口)"
POI = _NAME + "{1,16}(?:小区|市场|学校|广场|商场|夜市|公园|医院|菜场|地铁站)"
METADATA_FIELDS = (("call_month", "time_month"), ("area_code_area", "area"), ("area_code_street", "street"), ("case_lnglat", "lnglat"), ("type1", "case_type"), ("type2", "case_type"), ("type3", "case_type"), ("type4", "case_type"), ("type5", "case_type"), ("belong_dept", "department"), ("deptName", "department"), ("orgName", "department"))
TEXT_FIELDS = (("case_content_clean", "case_content"), ("address_detail_clean", "address_detail"), ("title_clean", "title"), ("case_goal_clean", "case_goal"))
LLM_TYPES = ("problem_object", "problem_behavior", "area", "street", "road", "intersection", "poi")


def _after(value: Column, marks: tuple[str, ...]) -> Column:
    """What follows the last of each mark in turn."""
    for m in marks:
        value = F.substring_index(value, m, -1)
    return value


def street_name(value: Column) -> Column:
    """At most eight characters before the last 街道 or, without one, 镇, and that ending."""
    value = _after(value, AREAS)
    out = value
    for end in ("镇", "街道"):
        cut = F.concat(F.right(F.regexp_extract(value, f"(?s)^(.*){end}", 1), F.lit(8)), F.lit(end))
        out = F.when(F.contains(value, F.lit(end)), cut).otherwise(out)
    return out


def road_name(value: Column) -> Column:
    """After areas, streets and a connector that follows another road."""
    value = _after(value, (*AREAS, "街道", "镇"))
    for c in ("和", "与", "及", "、"):
        value = F.regexp_replace(value, f"^.+{_ROAD_END}{c}(?=[^{c}]*$)", "")
    return value


def _text_links(text: Column, field: str, channel: str) -> Column:
    """array<struct<kind, value, matched, field, channel, confidence>> of one text."""

    def link(kind: str, value: Column, matched: Column, confidence: float) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"), matched.alias("matched"), F.lit(field).alias("field"), F.lit(channel).alias("channel"), F.lit(confidence).alias("confidence"))

    def known(kind: str, terms: tuple[str, ...], confidence: float) -> Column:
        hit = F.filter(F.array(*map(F.lit, terms)), lambda t: F.contains(text, t))
        return F.transform(hit, lambda t: link(kind, t, t, confidence))

    def crossing(m: Column) -> Column:
        one, two = F.regexp_extract(m, CROSSING, 1), F.regexp_extract(m, CROSSING, 2)
        joint = F.when(F.contains(m, F.lit("与")), "与").otherwise("和")
        end = F.when(F.contains(m, F.lit("交界处")), "交界处").when(F.contains(m, F.lit("路口")), "路口").otherwise("交叉口")
        whole = F.concat(road_name(one), joint, road_name(two), end)
        return F.array(link("intersection", whole, m, 0.9), link("road", road_name(one), one, 0.9), link("road", road_name(two), two, 0.9))

    found = lambda pattern: F.regexp_extract_all(text, F.lit(pattern), 0)
    return F.concat(
        known("area", AREAS, 0.9),
        known("problem_object", OBJECTS, 0.7),
        known("problem_behavior", BEHAVIORS, 0.7),
        F.flatten(F.transform(found(CROSSING), crossing)),
        F.transform(found(STREET), lambda m: link("street", street_name(m), m, 0.9)),
        F.transform(found(ROAD), lambda m: link("road", road_name(m), m, 0.9)),
        F.transform(found(POI), lambda m: link("poi", m, m, 0.6)),
    )


def extract_links(orders: DataFrame) -> DataFrame:
    """Links of flat orders: (doc_id, entity_type, entity_value, normalized_value, source_field, source_channel, confidence, matched_text, ordinal)."""
    field = lambda c: clean(F.col(c)) if c in orders.columns else F.lit("")
    struct = lambda kind, c: F.struct(F.lit(kind).alias("kind"), field(c).alias("value"), field(c).alias("matched"), F.lit(c).alias("field"), F.lit("metadata").alias("channel"), F.lit(1.0).alias("confidence"))
    arrays = [F.array(*(struct(kind, c) for c, kind in METADATA_FIELDS)), *(_text_links(field(c), c, channel) for c, channel in TEXT_FIELDS)]
    rows = orders.select(field("doc_id").alias("doc_id"), F.posexplode(F.concat(*arrays)).alias("ordinal", "l")).filter("doc_id <> ''")
    flat = rows.select("doc_id", F.col("l.kind").alias("entity_type"), F.col("l.value").alias("entity_value"), squeeze(F.col("l.value")).alias("normalized_value"), F.col("l.field").alias("source_field"), F.col("l.channel").alias("source_channel"), F.col("l.confidence").alias("confidence"), F.col("l.matched").alias("matched_text"), "ordinal").filter("normalized_value <> ''")
    first = F.row_number().over(Window.partitionBy("doc_id", "entity_type", "normalized_value", "source_field").orderBy("ordinal"))
    return flat.withColumn("nth", first).filter("nth = 1").drop("nth")


def canonical_value(kind: Column, value: Column) -> Column:
    """Aliases of objects and behaviours to their dictionary name."""
    value = squeeze(clean(value))
    named = lambda table: F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), value), value)
    return F.when(kind == "problem_object", named(OBJECT_ALIASES)).when(kind == "problem_behavior", named(BEHAVIOR_ALIASES)).otherwise(value)


def is_generic(kind: Column, value: Column) -> Column:
    """Too general or fragmentary to join on."""
    v = canonical_value(kind, value)
    prefixes = F.array(*map(F.lit, GENERIC_PREFIXES))
    begins = F.exists(prefixes, lambda p: v.startswith(p))
    short = F.exists(prefixes, lambda p: v.startswith(p) & (F.length(v) <= F.length(p) + 4))
    return (v == "") | v.isin(*GENERIC) | (kind.isin("road", "street", "poi") & (F.length(v) <= 1)) | ((kind == "poi") & short) | ((kind == "street") & begins)


def candidate_verdict(kind: Column, value: Column, confidence: Column, evidence: Column, source: Column, least: float = 0.55) -> Column:
    """ok, or the first reason to reject a model's candidate. Confidence that is no number is low."""
    return (
        F.when(~kind.isin(*LLM_TYPES), "unsupported_entity_type")
        .when(canonical_value(kind, value) == "", "empty_entity_value")
        .when(is_generic(kind, value), "generic_entity_value")
        .when(F.coalesce(F.try_to_number(confidence, F.lit("9.999999")).cast("double"), F.lit(0.0)) < least, "low_confidence")
        .when((clean(evidence) == "") | ~F.contains(source, clean(evidence)), "missing_evidence_span")
        .otherwise("ok")
    )
