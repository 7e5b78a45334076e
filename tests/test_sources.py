"""Readers over many splits, strict errors, publishing, manifests, vectors and the graph of orders."""

import hashlib

import pytest
from pyspark.sql import functions as F

from caseloom.session import numbered
from caseloom.sources import graph_source, manifests, records, vectors


def test_line_numbers_over_splits(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.jsonl").write_text("".join(f'{{"text":"{name}{n}"}}\n' + "\n" * (n % 3 == 0) for n in range(200)), "utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        rows = records.read_json_lines(spark, str(tmp_path)).select("doc_id", "text").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {}
    for name in "ab":
        line = 0
        for n in range(200):
            want[f"{name}{n}"] = f"line_{line + 1}"
            line += 1 + (n % 3 == 0)
    assert {r.text: r.doc_id for r in rows} == want


def test_strict_and_limit(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"doc_id":"d1","text":"x"}\n\n{bad\n[1]\n', "utf-8")
    with pytest.raises(ValueError, match="^line_3:invalid_json$"):
        records.read_json_lines(spark, str(path), strict=True)
    assert records.read_json_lines(spark, str(path), strict=True, limit=1).count() == 1
    assert records.read_json_lines(spark, str(path), strict=True, limit=0).count() == 0
    with pytest.raises(ValueError, match="negative"):
        records.read_json_lines(spark, str(path), limit=-1)
    assert {r.code: r.n for r in records.error_counts(records.read_json_lines(spark, str(path))).collect()} == {"invalid_json": 1, "record_not_object": 1}


def test_quoted_newlines(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('id\tcase_content\n1\t"two\nlines ""quoted"""\n2\tplain\n3\n', "utf-8")
    rows = records.read_tsv(spark, str(tmp_path / "a.tsv")).collect()
    assert [(r.id, r.case_content, r._bad) for r in rows] == [("1", 'two\nlines "quoted"', False), ("2", "plain", False), ("3", None, True)]
    assert records.read_tsv(spark, str(tmp_path / "a.tsv"), limit=2).count() == 2
    orders = graph_source.read_orders(spark, str(tmp_path / "a.tsv"))
    assert orders.count() == 2 and len(orders.columns) == 26


def test_failed_export_keeps_the_old_output(spark, tmp_path):
    out = str(tmp_path / "out")
    records.publish(spark, out, lambda folder: spark.range(3).write.json(folder))

    def fail(folder):
        spark.range(9).write.json(folder)
        raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        records.publish(spark, out, fail)
    assert spark.read.json(out).count() == 3
    records.publish(spark, out, lambda folder: spark.range(5).write.json(folder))
    assert spark.read.json(out).count() == 5 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["out"]


def test_file_sha256(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"abc" * 100_000)
    row = records.file_sha256(spark, str(tmp_path / "x")).first()
    assert (row.length, row.sha256) == (300_000, hashlib.sha256(b"abc" * 100_000).hexdigest())


def test_ledger_appends_and_last_wins(spark, tmp_path):
    row = lambda n, v: spark.createDataFrame([("d", n, v)], "doc_id string, ledger_sequence long, value string")
    for n, v in ((1, "a"), (2, "b")):
        records.append_ledger(row(n, v), str(tmp_path / "ledger"))
    kept = spark.read.parquet(str(tmp_path / "ledger"))
    assert kept.count() == 2 and kept.select("_batch").distinct().count() == 2
    assert records.last_by_id(kept, "doc_id", "ledger_sequence").first().value == "b"


def manifest_rows(spark, rows):
    return spark.createDataFrame(rows, "schema string, doc_id string, content_hash string, ordinal int")


def test_manifest_errors(spark):
    good = ("m", "a", "0" * 64, 0)
    for rows, code in (([], "empty"), ([("x", "a", "0" * 64, 0)], "schema"), ([("m", "", "0" * 64, 0)], "missing_doc"), ([("m", "a", "zz", 0)], "hash"), ([good, good], "duplicate")):
        with pytest.raises(ValueError, match=code):
            manifests.check_manifest(manifest_rows(spark, rows), "m")
    orders = spark.createDataFrame([("a", "0" * 64), ("z", "bad")], "doc_id string, content_hash string")
    assert manifests.bound_orders(manifest_rows(spark, [good]), orders).count() == 1
    for rows, code in (([("m", "b", "0" * 64, 0)], "missing"), ([("m", "a", "1" * 64, 0)], "changed")):
        with pytest.raises(ValueError, match=code):
            manifests.bound_orders(manifest_rows(spark, rows), orders)


def test_vectors(spark, tmp_path):
    docs = spark.createDataFrame([("a", "xx"), ("b", "xyyy"), ("c", "")], "doc_id string, display_text string")
    count = lambda c: F.length(F.regexp_replace("_text", f"[^{c}]", "")).cast("float")
    made = vectors.embed(docs, lambda df: df.withColumn("vector", F.array(count("x"), count("y"))), F.col("display_text"))
    vectors.write_vectors(made, str(tmp_path / "v"))
    best = vectors.search(vectors.load_vectors(spark, str(tmp_path / "v")), [1.0, 0.0], 2).collect()
    assert [(r.doc_id, r.score) for r in best] == [("a", 1.0), ("b", round(1 / 10**0.5, 6))]
    vectors.write_vectors(spark.createDataFrame([("a", [1.0]), ("b", [1.0, 2.0])], "doc_id string, vector array<float>"), str(tmp_path / "v"))
    with pytest.raises(ValueError, match="vector_index_mismatch"):
        vectors.load_vectors(spark, str(tmp_path / "v"))


def test_graph_of_orders(spark):
    raw = spark.createDataFrame([("1", "平安路积水", "武进区", "2024-03-05 10:00"), ("2", "NULL", "", "")], "id string, case_content string, area_code_area string, call_time string")
    orders = graph_source.source_orders(raw)
    one = orders.orderBy(F.desc("case_content_clean")).first()
    extra = spark.createDataFrame([(one.doc_id, "poi", "医院", 0.8), ("unknown", "poi", "x", 0.8), (one.doc_id, "", "y", 0.8)], "doc_id string, entity_type string, entity_value string, confidence double")
    graph = graph_source.build_graph(orders, extra)
    links = {(r.entity_type, r.entity_value, r.doc_id) for r in graph["links"].collect()}
    assert {("road", "平安路", one.doc_id), ("area", "武进区", one.doc_id), ("poi", "医院", one.doc_id), ("time_month", "2024-03", one.doc_id)} <= links
    assert {d for *_, d in links} == {one.doc_id}
    assert graph["events"].count() == 2 and graph["entities"].count() == len({x[:2] for x in links})


def test_numbered(spark):
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("x"))
    got = numbered(rows, "n", F.desc("x")).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 5001)) and [r.x for r in got] == sorted((r.x for r in got), reverse=True)
