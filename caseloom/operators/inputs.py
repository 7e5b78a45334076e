"""Profile of the orders that a model would read: lexical flags, payload variants, descriptors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions import text as tx
from caseloom.functions import view as vw
from caseloom.operators import profile as pf
from caseloom.session import settle

# --- fixed values: clean fields, metadata of a descriptor, flags and their patterns, markers of earlier answers ---
# (only whether a pattern occurs matters, so a name before a suffix is asked for at its least length: long runs of letters cost no backtracking)
FIELDS = ("title_clean", "case_content_clean", "case_goal_clean", "address_detail_clean")
DESCRIBED = ("service_object_type", "type1", "type2", "type3")
HISTORY_MARKERS = ("前期反映", "原工单", "处理结果", "部门答复", "答复如下")
PROXIES = {
    "history_or_response": "部门答复|处理结果|答复如下|经核实|经调查|前期反映|原工单|回复称|已答复",
    "current_disagreement": "不认可|仍未解决|再次要求|现再次反映|有异议|不接受答复|再次来电|仍然|至今",
    "explicit_complaint": "投诉|举报|维权",
    "consultation_question": "咨询|请问|如何|怎么|是否|哪些材料|办理流程|查询",
    "request_language": "希望|要求|请求|建议|请相关|请尽快|督促|协调|处理|解决",
    "negative_or_failure": "未|没有|尚未|拒绝|不予|无法|不能|失败|受阻|不通过|被拒",
    "road_form": "[一-鿿A-Za-z0-9]{2}(?:大道|公路|路|街|巷|弄|线)",
    "intersection_form": "[一-鿿A-Za-z0-9](?:大道|公路|路|街|巷|弄|线)(?:与|和|及|/|、)[一-鿿A-Za-z0-9]{1,16}(?:大道|公路|路|街|巷|弄|线)",
    "poi_form": "小区|新村|花园|家园|公园|学校|幼儿园|医院|市场|商场|广场|服务中心|公司|工厂|汽修厂|产业园|工业园|园区|机构|派出所|超市|大厦|体育馆",
    "doorplate_form": r"(?:大道|公路|路|街|巷|弄)\p{Nd}+(?:号|弄|栋|幢|单元)",
    "direct_dissatisfaction": "不满意|不认可|有异议|不接受答复|满意度不高",
    "direct_emotion": "气愤|愤怒|生气|焦虑|着急|担心|无奈|难过|悲伤",
    "high_urgency": "催办|再次要求|仍未解决|长期未解决|至今未",
    "critical_risk": "人身安全|火灾|燃气泄漏|漏气|坍塌|倒塌|触电|爆炸|生命危险",
}
SENTENCE_END = r"。！？!?；;\n"
#: No pattern takes more than so many characters in a row that are neither Han nor digits, and each ends in a Han character.
REACH = 20
LONG = (600, 1400)
EMPTY = "<EMPTY>"


def _said(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def many_sentences(content: Column, least: int = 3) -> Column:
    """Whether ``least`` sentences have a character that is not white space; the text is read once, and no further than that."""
    shown = rf"[^{SENTENCE_END}\s]"
    return content.rlike(rf"(?U)^[{SENTENCE_END}\s]*+{shown}(?:[^{SENTENCE_END}]*+[{SENTENCE_END}][{SENTENCE_END}\s]*+{shown}){{{least - 1}}}")


def with_searched(orders: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``orders`` with ``__searched``: the fields joined by newlines, without what no pattern of ``PROXIES`` can reach.

    Of a run of characters that are neither Han nor digits the first and last
    ``REACH`` stay. No match crosses the gap, for none takes so many of them in
    a row, and none begins or ends in it. So long texts of other scripts are
    read once, not once a pattern.
    """
    joined = F.concat_ws("\n", *(F.nullif(_said(f), F.lit("")) for f in fields))
    other = r"[^一-鿿\p{Nd}]"
    return orders.withColumn("__searched", F.regexp_replace(joined, rf"({other}{{{REACH}}}){other}+({other}{{{REACH}}})", "$1\n$2"))


def proxies() -> dict[str, Column]:
    """Each lexical flag as a condition on the rows of ``with_searched``."""
    joined = F.col("__searched")
    return {name: joined.rlike(pattern) for name, pattern in PROXIES.items()} | {"multi_sentence_3plus": many_sentences(_said("case_content_clean"))}


def descriptors(orders: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, content_hash, four metadata, length bucket, sorted flags); null and empty metadata are ``<EMPTY>``.

    ``model`` names a struct column of what a model returned (repaired boolean,
    warnings array of strings), whose gaps are flags too.
    """
    shown = [F.coalesce(F.nullif(F.col(f"metadata.{m}"), F.lit("")), F.lit(EMPTY)).alias(m) for m in DESCRIBED]
    conditions = proxies() | {"address_detail_present": _said("address_detail_clean") != ""}
    flags = F.array_compact(F.array(*(F.when(c, name) for name, c in conditions.items())))
    if model:
        gaps = F.transform(F.filter(F.coalesce(f"{model}.warnings", F.array().cast("array<string>")), lambda w: w.startswith("semantic_gap:")), lambda w: F.concat(F.lit("model_"), F.replace(w, F.lit(":"), F.lit("_"))))
        flags = F.concat(flags, F.array_compact(F.array(F.when(F.col(f"{model}.repaired"), "model_repair"))), gaps)
    return with_searched(orders).select("doc_id", "content_hash", *shown, pf.length_bucket(F.length(_said("case_content_clean"))).alias("length_bucket"), F.array_sort(F.array_distinct(flags)).alias("challenge_flags"))


def with_rare(described: DataFrame, column: str = "type3", most: int = 10) -> DataFrame:
    """Descriptors with ``rare_<column>`` where at most ``most`` rows share the value.

    Rows are counted map-side and joined with the rare values only, so a
    frequent value is never gathered anywhere.
    """
    rare = described.filter(F.col(column) != EMPTY).groupBy(column).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") <= most)
    rows = described.join(rare, column, "left")
    flagged = F.when(F.col("__n").isNotNull(), F.array_sort(F.array_union("challenge_flags", F.array(F.lit(f"rare_{column}"))))).otherwise(F.col("challenge_flags"))
    return rows.withColumn("challenge_flags", flagged).select(*described.columns)


def payloads(budget: int = 2200) -> dict[str, Column]:
    """Canonical JSON of what a model would read, in four variants of metadata."""
    content = _said("case_content_clean")
    window = pf.content_window(content, vw.CURRENT_MARKERS, budget)
    present = lambda markers: F.concat(F.lit("["), F.array_join(F.array_compact(F.array(*(F.when(F.contains(content, F.lit(m)), f'"{m}"') for m in markers))), ","), F.lit("]"))
    info = {
        "current_markers_present": tx.Verbatim(present(vw.CURRENT_MARKERS)), "history_markers_present": tx.Verbatim(present(HISTORY_MARKERS)),
        "kept_chars": tx.Verbatim(F.length(window).cast("string")), "original_chars": tx.Verbatim(F.length(content).cast("string")),
        "truncated": tx.Verbatim((F.length(content) > budget).cast("string")),
    }
    clean = {f: _said(f) for f in FIELDS} | {"case_content_clean": window, "input_window_info": info}

    def safe(names: tuple[str, ...]) -> tx.Verbatim:  # empty values are left out
        pairs = [F.when(F.coalesce(F.col(f"metadata.{m}"), F.lit("")) != "", F.concat(F.lit(f'"{m}":'), tx.json_text(F.col(f"metadata.{m}")))) for m in sorted(names)]
        return tx.Verbatim(F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}")))

    timeless = tuple(m for m in vw.SAFE_FIELDS if m != "call_month")
    variants = {"current": vw.SAFE_FIELDS, "without_time": timeless, "semantic_metadata_only": DESCRIBED}
    return {name: tx.canonical_json(clean | {"metadata_context": safe(kept)}) for name, kept in variants.items()} | {"clean_fields_only": tx.canonical_json(clean)}


def payload_report(orders: DataFrame, budget: int = 2200) -> DataFrame:
    """Reuse and lengths of each payload variant; one row a variant.

    One pass makes a digest and a length of each variant; payloads themselves
    are not shuffled. Groups of equal payloads count first, then sum.
    """
    entries = F.array(*(F.struct(F.lit(name).alias("variant"), F.sha2(c, 256).alias("digest"), F.length(c).alias("chars")) for name, c in payloads(budget).items()))
    rows = settle(orders.select(F.explode(entries).alias("p")).select("p.*"), "payloads")
    groups = rows.groupBy("variant", "digest").agg(F.count(F.lit(1)).alias("n"))
    reuse = groups.groupBy("variant").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_payloads"), F.count(F.when(F.col("n") > 1, 1)).alias("dup_groups"), F.max("n").alias("largest"))
    extra = F.col("rows") - F.col("distinct_payloads")
    lengths = pf.length_summary(rows, F.col("chars"), "variant").drop("n", "present")
    return reuse.withColumns({"beyond_first": extra, "rate": F.round(extra / F.col("rows"), 4)}).join(lengths, "variant")


def input_counts(orders: DataFrame, budget: int = 2200) -> DataFrame:
    """(section, key, n, rate): presence of each field and each flag, by one aggregate without a shuffle of rows."""
    size = F.length(_said("case_content_clean"))
    flags = proxies() | {f"content_over_{n}": size > n for n in LONG} | {"content_over_input_limit": size > budget}
    conditions = {("field_presence", f): _said(f) != "" for f in FIELDS} | {("proxy_counts", name): c for name, c in flags.items()}
    sums = with_searched(orders).agg(F.count(F.lit(1)).alias("total"), *(F.count(F.when(c, 1)).alias(f"c{i}") for i, c in enumerate(conditions.values())))
    entries = F.array(*(F.struct(F.lit(section).alias("section"), F.lit(key).alias("key"), F.col(f"c{i}").alias("n")) for i, (section, key) in enumerate(conditions)))
    rate = F.when(F.col("total") > 0, F.round(F.col("e.n") / F.col("total"), 4)).otherwise(0.0)
    return sums.select("total", F.explode(entries).alias("e")).select("e.*", rate.alias("rate"))


def input_profile(orders: DataFrame, order: str = "doc_id", head: int = 32, budget: int = 2200) -> dict[str, DataFrame]:
    """The whole profile: counts, field lengths, metadata shape, payload reuse, and the head against all rows."""
    described = settle(descriptors(orders), "descriptors")
    texts = orders.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.length(_said(f)).alias("chars")) for f in (*FIELDS, *(["chunk_text"] if "chunk_text" in orders.columns else []))))).alias("x")).select("x.*")
    keyed = F.concat_ws(":", F.lit("length"), "length_bucket")
    return {
        "counts": input_counts(orders, budget),
        "field_lengths": pf.length_summary(texts, F.col("chars"), "field"),
        "metadata_shape": pf.metadata_shape(orders.select("metadata.*"), [f.name for f in orders.schema["metadata"].dataType.fields]),
        "payload_reuse": payload_report(orders, budget),
        "head_drift": pf.head_drift(described, order, head, keyed),
    }


def by_length(orders: DataFrame, bounds: tuple[int, ...], text: str = "chunk_text", order: str = "doc_id") -> DataFrame:
    """Orders with ``bucket`` (first bound not exceeded), ranged and sorted by bucket, length and input order.

    Each partition is a run of similar lengths for a model's batches; no task
    sorts more than its partition.
    """
    n = F.length(_said(text))
    bucket = F.lit(len(bounds))
    for i, most in reversed(list(enumerate(sorted(bounds)))):
        bucket = F.when(n <= most, i).otherwise(bucket)
    keyed = orders.withColumns({"bucket": bucket, "chars": n})
    return keyed.repartitionByRange("bucket", "chars", order).sortWithinPartitions("bucket", "chars", order)


def entity_samples(links: DataFrame, orders: DataFrame, limit: int = 200, strata: tuple[str, str] = ("entity_type", "source_channel")) -> DataFrame:
    """Links for review: the first ``limit // 16`` of each stratum, at most ``limit`` in all by stratum, with their order's texts.

    The literal limit in a stratum is applied before rows are shuffled.
    """
    keys, each = list(strata), max(1, limit // 16)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id", "entity_value"))
    chosen = links.withColumn("nth", nth).filter(F.col("nth") <= each).orderBy(*keys, "nth").limit(limit)
    texts = orders.select("doc_id", "case_content_clean", "address_detail_clean")
    return chosen.join(texts, "doc_id", "left").withColumns({"label": F.lit(""), "label_reason": F.lit("")})


def strata_counts(links: DataFrame, strata: tuple[str, ...] = ("entity_type", "source_channel")) -> DataFrame:
    return links.groupBy(*strata).agg(F.count(F.lit(1)).alias("n"))
