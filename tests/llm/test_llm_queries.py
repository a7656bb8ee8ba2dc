"""Registered queries of the subpackage over a data folder."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracles import compare  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

COLUMNS = {
    "op1_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op2_lm_score": {"doc_id": "bigint", "n_words": "bigint", "log_prob": "double"},
    "op3_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op6_near_dup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op8_licenses": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
                     "base_labels": "string", "labels": "string", "score": "double"},
    "op10_quality": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
                     "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
}
PIECES = {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_per_document(spark, name):
    rows = queries()[name](spark, SF)
    kinds = dict(rows.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    ids = sorted(r.doc_id for r in rows.collect())
    assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())


@pytest.mark.parametrize("name", ["op9_packing", "pipeline"])
def test_pieces(spark, name):
    rows = queries()[name](spark, SF)
    assert dict(rows.dtypes) == PIECES and rows.count() > 0


def test_contaminated_documents_hold_the_passage(spark):
    rows = queries()["op7_decontaminate"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in rows}
    assert {(d, i) for d, t in texts.items() for i, b in items.items() if b in t} <= found
    assert found


@pytest.mark.parametrize("name", ["op4_line_dedup"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert compare(queries()[name](spark, SF).toPandas(), con.execute(oracle_sql()[name]).df()) == "ok"
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_held_out_accuracy(spark):
    rows = queries()["op3_language_id"](spark, SF).where("held_out")
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    assert rows.join(truth, "doc_id").selectExpr("avg(cast(lang = lang_pred as int))").first()[0] > 0.97


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in queries() if n.startswith("op")}
    assert names == {f"op{k}" for k in range(1, 11)} and "pipeline" in queries()
