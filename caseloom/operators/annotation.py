"""Annotation rounds over sampled records: manifest, packet, two copies, agreement, adjudication, projection.

A gold row is (doc_id, content_hash, subset, clean_fields, issues, ...); an
issue has objects, predicates, actions and locations, each a mention of
(surface, canonical, field, evidence). All steps are joins on the identity
(doc_id, content_hash); samples are small, so those sides may be broadcast by
the optimiser, but nothing depends on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.operators import profile as pf
from caseloom.operators.evaluation import ratio

IDENTITY = ["doc_id", "content_hash"]
# --- fixed values: enumerations of the annotation format ---
MODES = ("problem", "question", "request", "suggestion", "praise", "historical_response", "current_stance")
SCOPES = ("current", "historical")
LOCATIONS = ("road", "intersection", "poi")
STATUSES = ("unlabeled", "in_progress", "completed", "adjudicated")
FIELDS = ("title_clean", "case_content_clean", "case_goal_clean", "address_detail_clean")

MENTION = "struct<surface:string,canonical:string,field:string,evidence:string>"
PLACE = "struct<surface:string,canonical:string,field:string,evidence:string,type:string>"
ISSUES = f"array<struct<mode:string,time_scope:string,objects:array<{MENTION}>,predicates:array<{MENTION}>,actions:array<{MENTION}>,locations:array<{PLACE}>>>"


def manifest(docs: DataFrame, strata: list[str], flags: Column, production: int, challenge: int, seed: str, ident: str = "doc_id") -> DataFrame:
    """(id, subset): a stratified production sample and, from the rest, a challenge sample by flags."""
    rank = pf.hash_rank(seed, F.col(ident))
    first = pf.stratified(docs, strata, production, rank, ident).select(ident, F.lit("production").alias("subset"))
    rest = docs.join(first.select(ident), ident, "left_anti")
    second = pf.round_robin(rest, ident, flags, rank, challenge).select(ident, F.lit("challenge").alias("subset"))
    return first.unionByName(second)


def packet(chosen: DataFrame, orders: DataFrame) -> DataFrame:
    """Chosen identities with their records; fails on one whose record is missing or changed."""
    found = chosen.join(orders.withColumnRenamed("content_hash", "__hash"), "doc_id", "left")
    wrong = F.col("__hash").isNull() | (F.col("__hash") != F.col("content_hash"))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("manifest_identity_mismatch:"), F.col("doc_id").cast("string")))).otherwise(F.col("content_hash"))
    return found.withColumn("content_hash", checked).drop("__hash").withColumn("status", F.lit("unlabeled")).withColumn("annotator", F.lit(""))


def start_round(rows: DataFrame, left: str, right: str) -> tuple[DataFrame, DataFrame]:
    """Two copies in progress under one round id; annotators must differ."""
    if not left.strip() or not right.strip() or left.strip() == right.strip():
        raise ValueError("annotation_round_requires_distinct_annotators")
    if not rows.filter("status <> 'unlabeled' OR annotator <> ''").limit(1).isEmpty():
        raise ValueError("annotation_packet_not_pristine")
    digest = rows.select(F.sha2(F.concat_ws("|", *IDENTITY), 256).alias("h")).agg(F.sha2(F.concat_ws("␟", F.array_sort(F.collect_list("h"))), 256)).first()[0]
    names = "␟".join(sorted((left.strip(), right.strip())))
    copy = lambda who: rows.withColumns({"annotator": F.lit(who.strip()), "status": F.lit("in_progress"), "round_id": F.substring(F.sha2(F.lit(f"{digest}␟{names}"), 256), 1, 16)})
    return copy(left), copy(right)


#: ASCII characters that do not count in a mention, one by one so that Java looks them up in a bit set.
_ASCII_OUT = r"""[\t\n\x0B\f\r !"#%&'()*,\-./:;?@\[\\\]_{}]+"""


def _said(m: Column) -> Column:
    """A mention's identity: punctuation and white space do not count, nor does case.

    The Unicode classes take most of the time, so they are asked only for texts
    with characters beyond ASCII; there letters, digits and Han are ruled out
    first.
    """
    text = F.coalesce(F.when(m["surface"] != "", m["surface"]), m["canonical"], F.lit(""))
    every = r"(?U)[[^0-9A-Za-z一-鿿]&&[\s\p{Punct}，。；：、！？（）《》“”‘’]]+"
    ascii_only = F.octet_length(text) == F.length(text)
    return F.lower(F.when(ascii_only, F.regexp_replace(text, _ASCII_OUT, "")).otherwise(F.regexp_replace(text, every, "")))


def _frames(issues: Column) -> Column:
    """Each issue as its sorted distinct role:mention strings; issues without any are left out."""

    def members(issue: Column) -> Column:
        role = lambda name, of: F.transform(F.coalesce(issue[name], F.array()), lambda m: F.concat(F.lit(of + ":"), _said(m)))
        every = F.concat(role("objects", "object"), role("predicates", "predicate"), role("actions", "action"), role("locations", "location"))
        return F.array_sort(F.array_distinct(F.filter(every, lambda x: ~x.endswith(":"))))

    return F.filter(F.transform(F.coalesce(issues, F.array().cast(ISSUES)), members), lambda f: F.size(f) > 0)


def frames(gold: DataFrame) -> DataFrame:
    """(identity, frame): each issue as its sorted distinct role:mention strings, empty ones left out."""
    return gold.select(*IDENTITY, F.explode(_frames(F.col("issues"))).alias("frame")).distinct()


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """(identity, kind, matched, left_only, right_only) for mentions, pairs and frames.

    Both sides must hold the same identities; otherwise the query fails. Only
    the frames of both sides are dealt, once, by identity; mentions and pairs
    are made where they are compared. A record is bounded by its issues.
    """

    def pairs(frame: Column) -> Column:
        return F.flatten(F.transform(frame, lambda a: F.transform(F.filter(frame, lambda b: b > a), lambda b: F.concat_ws("␟", a, b))))

    def sets(f: str) -> dict[str, Column]:
        c = F.col(f)
        return {"mentions": F.array_distinct(F.flatten(c)), "pairs": F.array_distinct(F.flatten(F.transform(c, pairs))), "frames": F.transform(c, lambda x: F.concat_ws("␞", x))}

    side = lambda gold, tag: gold.select(*IDENTITY, F.lit(tag).alias("side"), _frames(F.col("issues")).alias("f"))
    rows = side(left, "l").unionByName(side(right, "r")).filter(" AND ".join(f"{c} IS NOT NULL" for c in IDENTITY))
    of = lambda tag: F.collect_list(F.when(F.col("side") == tag, F.col("f")))
    both = rows.groupBy(*IDENTITY).agg(*(of(t).alias(t) for t in "lr"))
    whole = F.when((F.size("l") == 0) | (F.size("r") == 0), F.raise_error(F.lit("annotation_identity_sets_differ"))).otherwise(F.lit(True))
    both = both.filter(whole).select(*IDENTITY, *(F.array_distinct(F.flatten(t)).alias(t) for t in "lr"))
    one, two, size = sets("l"), sets("r"), lambda c: F.size(c).cast("long")
    made = both.select(*IDENTITY, *(c.alias(f"{k}_l") for k, c in one.items()), *(c.alias(f"{k}_r") for k, c in two.items()))
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), size(F.array_intersect(f"{k}_l", f"{k}_r")).alias("matched"), size(F.array_except(f"{k}_l", f"{k}_r")).alias("left_only"), size(F.array_except(f"{k}_r", f"{k}_l")).alias("right_only")) for k in one)))
    return made.select(*IDENTITY, kinds.alias("k")).select(*IDENTITY, "k.*")


def agreement(compared: DataFrame) -> DataFrame:
    """Dice-F1 and sums for each kind."""
    sums = compared.groupBy("kind").agg(*(F.sum(c).alias(c) for c in ("matched", "left_only", "right_only")))
    return sums.withColumn("f1", ratio(2 * F.col("matched"), 2 * F.col("matched") + F.col("left_only") + F.col("right_only")))


def conflicts(compared: DataFrame) -> DataFrame:
    """(identity, reasons) of records on which the two sides differ."""
    differs = compared.filter("left_only + right_only > 0")
    reason = F.element_at(F.create_map(F.lit("mentions"), F.lit("grounded_mentions"), F.lit("pairs"), F.lit("issue_attachment"), F.lit("frames"), F.lit("issue_frame")), F.col("kind"))
    return differs.groupBy(*IDENTITY).agg(F.array_join(F.array_sort(F.collect_set(reason)), ",").alias("reasons"))


def _by_identity(**sides: DataFrame) -> DataFrame:
    """(identity, known, and each side's rows as a list): sides are grouped once and, if they are dealt by doc_id already, where they are.

    ``known`` is aggregated, for as a plain filter on the identity it would go
    down into one use of a side only, and its rows would be dealt once a use.
    """
    rows = None
    for tag, side in sides.items():
        more = [F.col(c) if c in side.columns else F.lit(None).cast("string").alias(c) for c in ("adjudicator", "notes")]
        part = side.select(*IDENTITY, F.lit(tag).alias("side"), F.struct("issues", *more).alias("row"))
        rows = part if rows is None else rows.unionByName(part)
    known = F.max(F.col(IDENTITY[0]).isNotNull() & F.col(IDENTITY[1]).isNotNull()).alias("known")
    return rows.groupBy(*IDENTITY).agg(known, *(F.collect_list(F.when(F.col("side") == t, F.col("row"))).alias(t) for t in sides))


def _open(rows: DataFrame) -> DataFrame:
    """``rows`` of ``_by_identity`` with ``open``: known records whose frames differ on the two sides.

    Mentions and pairs are parts of frames, so they differ only where frames do.
    """
    left, right = (F.get(t, F.lit(0))["issues"] for t in ("left", "right"))
    told = lambda issues: F.array_sort(F.array_distinct(_frames(issues)))
    lone = F.when(F.col("known") & ((F.size("left") == 0) != (F.size("right") == 0)), F.raise_error(F.lit("annotation_identity_sets_differ")).cast("boolean"))
    twice = F.when((F.size("left") > 1) | (F.size("right") > 1), F.raise_error(F.lit("invalid_or_duplicate_identity")).cast("boolean"))
    return rows.withColumn("open", F.coalesce(lone, twice, F.col("known") & ~left.eqNullSafe(right) & (told(left) != told(right))))


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(identity, left, right): both readings of the records that ``conflicts`` names, without the reasons."""
    side = lambda gold: gold.select(*IDENTITY, "issues")
    issues = lambda t: F.get(t, F.lit(0))["issues"].alias(t)
    return _open(_by_identity(left=side(left), right=side(right))).filter("open").select(*IDENTITY, issues("left"), issues("right"))


def adjudicate(left: DataFrame, right: DataFrame, resolved: DataFrame, adjudicator: str) -> DataFrame:
    """Final rows: exact agreements as they are, conflicts as resolved.

    ``resolved`` (identity, issues, adjudicator, notes) must hold exactly the
    conflicts, with notes, all by this adjudicator, who is neither annotator.
    No side may hold an identity twice. The three are grouped once by identity,
    where they are compared too.
    """
    who = left.select("annotator").union(right.select("annotator")).distinct()
    if not who.filter(F.col("annotator") == adjudicator).limit(1).isEmpty():
        raise ValueError("adjudicator_not_independent")
    side = lambda gold: gold.select(*IDENTITY, "issues")
    rows = _open(_by_identity(left=side(left), right=side(right), given=resolved))
    given, own = F.get("given", F.lit(0)), F.get("left", F.lit(0))
    is_open, is_given = F.col("open"), F.size("given") > 0
    code = (
        F.when(F.size("given") > 1, "invalid_or_duplicate_identity")
        .when(~is_open & is_given, "conflict_identity_sets_differ")
        .when(is_open & ~is_given, "conflict_not_resolved")
        .when(is_given & (given["adjudicator"] != adjudicator), "conflict_adjudicator_mismatch")
        .when(is_given & (F.trim(F.coalesce(given["notes"], F.lit(""))) == ""), "conflict_resolution_missing_notes")
    )
    issues = F.when(code.isNotNull(), F.raise_error(code)).when(is_given, given["issues"]).otherwise(own["issues"])
    notes = F.when(is_given, given["notes"]).otherwise(F.lit("exact_double_annotation_agreement"))
    rows = rows.filter((F.size("left") > 0) | is_given | F.col("known"))
    return rows.select(*IDENTITY, issues.alias("issues"), F.lit("adjudicated").alias("status"), F.lit(adjudicator).alias("annotator"), notes.alias("notes"))


def project_issues(gold: DataFrame, flat: bool = False) -> tuple[DataFrame, DataFrame]:
    """(issue events, member links): one event an issue, or one a record if flat.

    The predicate of a problem is a behaviour, of any other mode an issue
    predicate. Equal links of one issue count once.
    """
    rows = gold.select("doc_id", F.posexplode("issues").alias("n", "i"))
    suffix = F.lit("flat") if flat else (F.col("n") + 1).cast("string")
    rows = rows.withColumn("issue_id", F.concat(F.col("doc_id").cast("string"), F.lit("::issue::"), suffix))
    one = lambda c: F.when(F.size(F.collect_set(F.when(c != "", c))) == 1, F.max(F.when(c != "", c))).otherwise("mixed")
    events = rows.groupBy("issue_id", "doc_id").agg(one(F.col("i.mode")).alias("mode"), one(F.col("i.time_scope")).alias("time_scope"))
    problem = F.coalesce(F.col("i.mode"), F.lit("")).isin("", "problem")

    def tagged(name: str, role: Column, kind) -> Column:
        return F.transform(F.coalesce(F.col(f"i.{name}"), F.array()), lambda m: F.struct(role.alias("role"), (kind(m) if callable(kind) else kind).alias("entity_type"), m["surface"].alias("surface"), F.coalesce(F.when(m["canonical"] != "", m["canonical"]), m["surface"]).alias("normalized_value"), m["field"].alias("source_field"), m["evidence"].alias("evidence")))

    links = F.concat(
        tagged("objects", F.lit("object"), F.lit("problem_object")),
        tagged("predicates", F.when(problem, "behavior").otherwise("issue_predicate"), F.when(problem, "problem_behavior").otherwise("issue_predicate")),
        tagged("actions", F.lit("request_action"), F.lit("request_action")),
        F.filter(tagged("locations", F.lit("location"), lambda m: m["type"]), lambda x: x["entity_type"].isin(*LOCATIONS)),
    )
    members = rows.select("issue_id", "doc_id", F.explode(links).alias("l")).select("issue_id", "doc_id", "l.*").filter("surface <> ''").distinct()
    return events, members


def gold_errors(gold: DataFrame) -> DataFrame:
    """(identity, code): what is wrong with a gold row, one row a code.

    ``gold`` has clean_fields (a struct of the four texts), issues, status.
    """
    known = F.array(*map(F.lit, FIELDS))

    def of_mention(m: Column, prefix: str) -> Column:
        source = F.coalesce(*(F.when(m["field"] == f, F.col(f"clean_fields.{f}")) for f in FIELDS), F.lit(""))
        blank = lambda c: F.coalesce(c, F.lit("")) == ""
        return F.array_compact(F.array(
            F.when(blank(m["surface"]), f"{prefix}_missing_surface"),
            F.when(blank(m["evidence"]), f"{prefix}_missing_evidence"),
            F.when(~blank(m["evidence"]) & blank(m["field"]), f"{prefix}_missing_field"),
            F.when(~blank(m["field"]) & ~F.array_contains(known, m["field"]), f"{prefix}_invalid_field"),
            F.when(~blank(m["evidence"]) & F.array_contains(known, m["field"]) & ~F.contains(source, m["evidence"]), f"{prefix}_evidence_not_in_field"),
        ))

    def of_issue(i: Column) -> Column:
        part = lambda name, prefix: F.flatten(F.transform(F.coalesce(i[name], F.array()), lambda m: of_mention(m, prefix)))
        own = F.array_compact(F.array(F.when(~F.coalesce(i["mode"], F.lit("")).isin(*MODES), "issue_invalid_mode"), F.when(~F.coalesce(i["time_scope"], F.lit("")).isin(*SCOPES), "issue_invalid_time_scope")))
        places = F.flatten(F.transform(F.coalesce(i["locations"], F.array()), lambda m: F.array_compact(F.array(F.when(~F.coalesce(m["type"], F.lit("")).isin(*LOCATIONS), "location_invalid_type")))))
        return F.concat(own, places, part("objects", "object"), part("predicates", "predicate"), part("actions", "action"), part("locations", "location"))

    row = F.array_compact(F.array(
        F.when(F.coalesce(F.col("doc_id").cast("string"), F.lit("")) == "", "missing_doc_id"),
        F.when(~F.coalesce("content_hash", F.lit("")).rlike("^(sha256:)?[0-9a-f]{64}$"), "invalid_content_hash"),
        F.when(~F.coalesce("status", F.lit("")).isin(*STATUSES), "invalid_status"),
    ))
    codes = F.concat(row, F.flatten(F.transform(F.coalesce("issues", F.array().cast(ISSUES)), of_issue)))
    return gold.select(*IDENTITY, F.explode(codes).alias("code"))


def latest_attempts(ledger: DataFrame) -> DataFrame:
    """Of each identity's latest run, the last entry of each phase and whether it ends the run."""
    run = ledger.groupBy(*IDENTITY).agg(F.max_by("run_attempt_id", "ledger_sequence").alias("run_attempt_id"))
    last = F.row_number().over(Window.partitionBy(*IDENTITY, "phase").orderBy(F.desc("ledger_sequence")))
    rows = ledger.join(run, [*IDENTITY, "run_attempt_id"], "left_semi").withColumn("__r", last).filter("__r = 1").drop("__r")
    return rows.withColumn("terminal", (F.col("phase") == "repair") | (F.col("status") != "repair_required"))
