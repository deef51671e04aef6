"""The registered queries and the pipeline."""

import os
from collections import Counter

import duckdb
import pytest
from corpora import documents, prose

import __spark_entry__ as contract
import corpus_pipeline
from footfall.llm import dart_minhash, line_dedup, packing, queries, secret_scan, toxicity

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "labels", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = connection.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    found = contract.queries()[name](spark, SF_DIR)
    assert set(found.columns) == set(columns)
    assert Counter(tuple(r) for r in found.select(*columns).collect()) == Counter(expected.fetchall())


def test_every_number_has_one_query():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_native_plans_have_no_python(spark):
    for name in ("op1_line_dedup", "op2_license_scan", "op12_quality_rules"):
        plan = contract.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def small_corpus():
    passage = "\n".join(prose(900 + i, 20) for i in range(4))
    rows = [(i, prose(i, 80)) for i in range(60)]
    rows += [(100 + i, f"{prose(200 + i, 40)}\n{passage}\n{prose(300 + i, 40)}") for i in range(4)]
    rows += [(200, rows[0][1]), (201, rows[1][1] + " more"), (300, f"{prose(77, 60)} password=0123456789abcdef01 {prose(78, 20)}"), (400, None)]
    return rows, passage


def test_pipeline(spark, tmp_path):
    rows, passage = small_corpus()
    toxic = [(1000 + i, f"{prose(2000 + i, 30)} moron {prose(3000 + i, 30)}") for i in range(60)]
    labels = [(i, int(i >= 1000)) for i, _ in rows + toxic]
    documents(spark, rows + toxic).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, str(tmp_path)), "test")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    text = {name: {r.doc_id: r.text for r in df.collect()} for name, df in seen.items() if name != "packing"}
    before = dict(rows)
    assert text["toxicity"] == before
    lines = text["line dedup"]
    assert passage in lines[100] and not any(passage in lines[i] for i in (101, 102, 103))
    assert lines[200] == "" and lines[0] == before[0]
    gone = set(lines) - set(text["near duplicates"])
    assert gone == {201, 400}
    assert text["secret scan"][300] == before[300].replace("password=0123456789abcdef01", "[SECRET]")
    assert {i: t for i, t in text["secret scan"].items() if i != 300} == {i: t for i, t in text["near duplicates"].items() if i != 300}
    pieces = seen["packing"].collect()
    assert {r.doc_id for r in pieces} == set(text["secret scan"])
    again = corpus_pipeline.run(spark, str(tmp_path))
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[k] for k in key) for r in again.collect()) == Counter(tuple(r[k] for k in key) for r in pieces)


def test_stages_of_an_empty_table(spark, tmp_path):
    docs = documents(spark, [(1, "x")]).limit(0)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.clean(docs, labels).count() == 0
    assert line_dedup.deduplicated(docs).count() == 0
    assert dart_minhash.kept(docs).count() == 0
    assert secret_scan.redacted(docs).count() == 0
    assert packing.pack_documents(docs, queries.tokenizer_file("byte_bpe_50k.json")).count() == 0
