"""Readers and writers of work records: TSV, JSON lines, documents, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions import text as tx
from caseloom.session import settle

# --- fixed values: columns of the raw table, of metadata and of derived fields ---
RAW_COLUMNS = (
    "id", "order_id", "title", "service_object_type", "case_content", "case_goal", "address_detail",
    "area_code_city", "area_code_area", "area_code_street", "case_accord_type_one_name", "case_accord_type_two_name",
    "case_accord_type_three_name", "order_source", "order_type", "order_status", "call_time",
)
METADATA = {
    "service_object_type": "service_object_type", "area_code_city": "area_code_city", "area_code_area": "area_code_area",
    "area_code_street": "area_code_street", "type1": "case_accord_type_one_name", "type2": "case_accord_type_two_name",
    "type3": "case_accord_type_three_name", "order_source": "order_source", "order_type": "order_type",
    "order_status": "order_status", "call_time": "call_time",
}
CLEAN_FIELDS = {"title_clean": "title", "case_content_clean": "case_content", "case_goal_clean": "case_goal", "address_detail_clean": "address_detail"}
LABELS = {"title": "标题：", "service_object_type": "诉求类型：", "case_content": "诉求内容：", "case_goal": "诉求目标：", "category": "业务分类：", "area": "所属区域：", "address_detail": "地址详情：", "call_time": "来电时间：", "order_source": "来源渠道："}

DOCUMENT_SCHEMA = T.StructType([
    *(T.StructField(c, T.StringType()) for c in ("doc_id", *CLEAN_FIELDS, "embedding_text", "display_text", "text")),
    T.StructField("metadata", T.StructType([T.StructField(m, T.StringType()) for m in (*METADATA, "call_month")])),
    T.StructField("content_hash", T.StringType()),
])


def read_tsv(spark: SparkSession, path: str, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Tab-separated records with a header, all texts, plus ``_bad``: wrong number of cells.

    A quoted cell may hold tabs, doubled quotes and newlines, so a file is
    read by one task; large inputs should be many files. Rows with too few or
    too many cells are kept and flagged, so that they can be counted.
    ``limit`` keeps the first records in input order, bad ones included; 0 and
    None mean all. The flag needs every column parsed, so the rows are staged
    once as Parquet in the shared folder; what follows reads columns from there.
    """
    how = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": True}
    header = columns or spark.read.csv(path, **how).columns
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in header), T.StructField("_corrupt", T.StringType())])
    rows = spark.read.schema(schema).csv(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", enforceSchema=True, **how)
    staged = settle(rows.withColumn("_bad", F.col("_corrupt").isNotNull()).withColumn("_at", F.monotonically_increasing_id()), "tsv").drop("_corrupt")
    return (_first(staged, limit) if limit else staged).drop("_at")


def _first(rows: DataFrame, limit: int) -> DataFrame:
    if limit < 0:
        raise ValueError("limit must not be negative")
    return rows.orderBy("_at").limit(limit)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, line, _at): lines of text files, numbered from 1 in each file over all its splits.

    A split's first line is known from the lines of the file's earlier splits,
    a table of one row a split, so that nothing is sorted.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("_at"))
    lines = settle(lines, "lines")
    splits = lines.groupBy("file", "start").agg(F.min("_at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = splits.select("file", "start", "first", (F.sum("n").over(Window.partitionBy("file").orderBy("start")) - F.col("n")).alias("before"))
    return lines.join(F.broadcast(before), ["file", "start"]).select("value", "file", (F.col("before") + F.col("_at") - F.col("first") + 1).alias("line"), "_at")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT_SCHEMA, limit: int | None = None, strict: bool = False) -> DataFrame:
    """JSON lines with ``_line`` and ``_error``: null, ``invalid_json`` or ``record_not_object``; blank lines are skipped.

    Missing ids become ``line_<n>``, n counting every line of its file, blank
    ones too; ``text`` and ``display_text`` stand in for each other. ``limit``
    keeps the first records (None: all). ``strict`` fails on the first bad line
    with ``line_<n>:<code>``, and a limit of 0 is then an empty table.
    """
    lines = numbered_lines(spark, path).filter(tx.strip(F.col("value")) != "")
    if limit or (strict and limit == 0):
        lines = _first(lines, limit)
    parsed = F.try_parse_json("value")
    error = F.when(parsed.isNull(), "invalid_json").when(~F.schema_of_variant(parsed).startswith("OBJECT"), "record_not_object")
    names = schema.fieldNames()
    rows = lines.select("_at", F.col("line").alias("_line"), F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"), error.alias("_error"))
    out = rows.select(*(F.col(f"r.{c}").alias(c) for c in names), "_error", "_line", "_at")
    if "doc_id" in names:
        out = out.withColumn("doc_id", F.coalesce(F.when(F.col("doc_id") != "", F.col("doc_id")), F.concat(F.lit("line_"), F.col("_line"))))
    if {"text", "display_text"} <= set(names):
        present = lambda c: F.when(F.col(c) != "", F.col(c))
        both = F.coalesce(present("display_text"), present("text"), F.lit(""))
        out = out.withColumn("text", F.coalesce(present("text"), both)).withColumn("display_text", both)
    if strict:
        fail_on_first(out, F.col("_error"))
    return out.drop("_at")


def fail_on_first(rows: DataFrame, code: Column) -> None:
    """Raise ``line_<n>:<code>`` for the first row in input order whose code is not null."""
    bad = rows.filter(code.isNotNull()).orderBy("_at").select("_line", code.alias("code")).first()
    if bad is not None:
        raise ValueError(f"line_{bad._line}:{bad.code}")


def error_counts(rows: DataFrame) -> DataFrame:
    """(code, n) of the bad lines that ``read_json_lines`` let through."""
    return rows.filter("_error IS NOT NULL").groupBy(F.col("_error").alias("code")).agg(F.count(F.lit(1)).alias("n"))


def normalise_orders(docs: DataFrame) -> DataFrame:
    """Documents as work orders: doc_id, four clean fields, chunk_text, metadata, content_hash and ``_code``.

    A document without clean fields gets them from the labelled lines of its
    text. ``_code`` is ``missing_doc_id``, ``empty_semantic_text`` or null.
    """
    have = lambda c: tx.clean(F.col(c)) if c in docs.columns else F.lit("")
    stops = list(LABELS.values())
    legacy = lambda c: tx.clean(tx.labelled_field(have("text"), LABELS[c], stops))
    fields = {name: F.coalesce(F.nullif(have(name), F.lit("")), legacy(c)) for name, c in CLEAN_FIELDS.items()}
    rows = docs.select(have("doc_id").alias("doc_id"), *(c.alias(n) for n, c in fields.items()), have("content_hash").alias("content_hash"), *(["metadata"] if "metadata" in docs.columns else []))
    parts = [("标题：", "title_clean"), (LABELS["case_content"], "case_content_clean"), (LABELS["case_goal"], "case_goal_clean"), (LABELS["address_detail"], "address_detail_clean")]
    rows = rows.withColumn("chunk_text", tx.labelled_lines([(label, F.col(c)) for label, c in parts]))
    own = F.concat(F.lit("sha256:"), F.sha2("chunk_text", 256))
    code = F.when(F.col("doc_id") == "", "missing_doc_id").when(F.col("chunk_text") == "", "empty_semantic_text")
    return rows.withColumn("content_hash", F.coalesce(F.nullif("content_hash", F.lit("")), own)).withColumn("_code", code)


def last_by_id(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the last in input order wins."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in rest))


def _column(df: DataFrame, name: str) -> Column:
    return tx.clean(F.col(name)) if name in df.columns else F.lit("")


def build_documents(raw: DataFrame) -> DataFrame:
    """Raw records to documents: cleaned, redacted, with views, metadata, counters and hash.

    ``_redactions`` sums the counters over the four texts, five display parts
    and all metadata values, so a part that is also metadata counts twice.
    Times are typed values and are not redacted.
    """
    rows = raw.select(*(_column(raw, c).alias(c) for c in RAW_COLUMNS))
    rows = rows.withColumn("category", tx.join_present(" / ", *(F.col(f"case_accord_type_{n}_name") for n in ("one", "two", "three"))))
    rows = rows.withColumn("area", tx.join_present(" / ", *(F.col(f"area_code_{n}") for n in ("city", "area", "street"))))
    raw_display = tx.labelled_lines([(LABELS[c], F.col(c)) for c in LABELS])
    source = F.coalesce(F.when(F.col("id") != "", F.col("id")), F.when(F.col("order_id") != "", F.col("order_id")), raw_display)
    rows = rows.withColumn("doc_id", tx.letter_id("order_", source))
    texts = ["title", "case_content", "case_goal", "address_detail"]
    parts = ["service_object_type", "category", "area", "order_source"]
    meta = [c for c in METADATA.values() if c != "call_time"]
    counters = []
    for c in dict.fromkeys([*texts, *parts, *meta]):
        rows = tx.redact(rows, c, counts=f"_n_{c}")
        counters += [f"_n_{c}"] * ((c in texts or c in parts) + (c in meta))
    metadata = {m: F.col(c) for m, c in METADATA.items()} | {"call_month": tx.month_of(F.col("call_time"))}
    clean_fields = {name: F.col(c) for name, c in CLEAN_FIELDS.items()}
    display = tx.labelled_lines([(LABELS[c], F.col(c)) for c in LABELS])
    total = F.struct(*(sum((F.col(f"{n}.{k}") for n in counters[1:]), F.col(f"{counters[0]}.{k}")).alias(k) for k in tx.COUNTERS))
    content_hash = F.concat(F.lit("sha256:"), F.sha2(tx.canonical_json(clean_fields | {"metadata": metadata}), 256))
    return rows.select(
        "doc_id",
        *(c.alias(n) for n, c in clean_fields.items()),
        tx.labelled_lines([(LABELS["case_content"], F.col("case_content")), (LABELS["case_goal"], F.col("case_goal"))]).alias("embedding_text"),
        display.alias("display_text"),
        display.alias("text"),
        F.struct(*(c.alias(n) for n, c in metadata.items())).alias("metadata"),
        content_hash.alias("content_hash"),
        total.alias("_redactions"),
    )


def disposition(docs: DataFrame) -> Column:
    """empty, polluted (a tab, real or written, in text or metadata) or exported."""
    fields = [F.col(c) for c in CLEAN_FIELDS]
    everything = F.array(*fields, F.col("text"), *(F.col(f"metadata.{m}") for m in (*METADATA, "call_month")))
    polluted = F.exists(everything, lambda x: F.contains(x, F.lit("\t")) | F.contains(x, F.lit("\\t")))
    return F.when(F.array_join(F.array(*fields), "") == "", "empty").when(polluted, "polluted").otherwise("exported")


def publish(spark: SparkSession, out: str, write) -> None:
    """Have ``write(folder)`` fill a side folder, then put it in the place of ``out``.

    The old output is renamed away, the new one renamed in and only then the
    old one deleted; a failure while writing leaves the old output as it was
    and no side folder. (Two renames are not one step: a reader may find
    nothing between them.)
    """
    jvm, mark = spark.sparkContext._jvm, uuid.uuid4().hex
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    side, old = f"{out.rstrip('/')}.new-{mark}", f"{out.rstrip('/')}.old-{mark}"
    try:
        write(side)
        had = fs.exists(path(out))
        if had and not fs.rename(path(out), path(old)):
            raise OSError(f"cannot move {out}")
        if not fs.rename(path(side), path(out)):
            if had:
                fs.rename(path(old), path(out))
            raise OSError(f"cannot publish {out}")
        if had:
            fs.delete(path(old), True)
    finally:
        fs.delete(path(side), True)


def export_documents(spark: SparkSession, tsv: str, out: str, limit: int | None = None) -> DataFrame:
    """TSV to JSON-lines documents; returns the quality report as one row.

    Documents and report (``_report``, which readers of the folder skip) are
    published together; see ``publish`` for what a failure leaves.
    """
    raw = read_tsv(spark, tsv, limit=limit)
    good = build_documents(raw.filter("NOT _bad"))
    marked = settle(good.withColumn("_fate", disposition(good)), "export")
    sums = F.struct(*(F.coalesce(F.sum(f"_redactions.{k}"), F.lit(0)).alias(k) for k in tx.COUNTERS)).alias("redactions")
    count = lambda c: F.count(F.when(c, 1))
    report = marked.agg(count(F.col("_fate") == "exported").alias("exported"), count(F.col("_fate") == "empty").alias("empty"), count(F.col("_fate") == "polluted").alias("polluted"), sums)
    bad = raw.agg(F.count(F.lit(1)).alias("rows"), count(F.col("_bad")).alias("bad_field_count"))
    whole = settle(bad.crossJoin(report), "export-report")  # two one-row tables

    def write(folder: str) -> None:
        marked.filter("_fate = 'exported'").drop("_fate", "_redactions").write.json(folder)
        whole.write.json(f"{folder}/_report")

    publish(spark, out, write)
    return whole


def check_documents(docs: DataFrame) -> DataFrame:
    """Integrity report: missing ids, repeated ids and identities, wrong hashes, presence rates."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    fields = {n: blank(n) for n in CLEAN_FIELDS} | {"metadata": {m: blank(f"metadata.{m}") for m in (*METADATA, "call_month")}}
    wrong = F.concat(F.lit("sha256:"), F.sha2(tx.canonical_json(fields), 256)) != blank("content_hash")
    count = lambda c: F.count(F.when(c, 1))
    flat = docs.agg(F.count(F.lit(1)).alias("rows"), count(blank("doc_id") == "").alias("missing_ids"), count(wrong).alias("wrong_hashes"), *(F.round(F.avg(F.when(blank(n) != "", 1.0).otherwise(0.0)), 6).alias(f"present_{n}") for n in CLEAN_FIELDS))
    ids = docs.groupBy("doc_id").count().agg(count(F.col("count") > 1).alias("repeated_ids"))
    identities = docs.groupBy("doc_id", "content_hash").count().agg(count(F.col("count") > 1).alias("repeated_identities"))
    return flat.crossJoin(ids).crossJoin(identities)


def safety_report(docs: DataFrame) -> DataFrame:
    """Residual counts over each document's distinct visible texts, and whether all are 0."""
    values = F.array_distinct(F.array_compact(F.array(*(F.when(F.col(c) != "", F.col(c)) for c in CLEAN_FIELDS), *(F.when(F.col(f"metadata.{m}") != "", F.col(f"metadata.{m}")) for m in (*METADATA, "call_month")))))
    seen = F.when(F.size(values) > 0, values).otherwise(F.array_compact(F.array(F.when(F.col("text") != "", F.col("text")))))
    texts = docs.select(F.explode(seen).alias("x")).select(*tx.residual_counts(F.col("x")))
    names = [n for n, _ in tx.RESIDUALS]
    sums = texts.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))
    return sums.withColumn("safe", sum((F.col(n) for n in names[1:]), F.col(names[0])) == 0)


def file_sha256(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, length, sha256) of whole files, each streamed through a digest, so of any size."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        fs = path.getFileSystem(conf)
        stream = fs.open(path)
        try:
            digest = jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()
        rows.append((name, fs.getFileStatus(path).getLen(), digest))
    return spark.createDataFrame(rows, "path string, length long, sha256 string")


def append_ledger(rows: DataFrame, path: str) -> None:
    """Append entries with a batch mark; order inside a batch is ``ledger_sequence``."""
    rows.withColumn("_batch", F.lit(uuid.uuid4().hex)).write.mode("append").parquet(path)
