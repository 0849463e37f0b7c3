"""Every query of the subpackage: against DuckDB where it has SQL, and its columns and row count everywhere."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
import shoptrail.llm.queries as registered

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
SQL = registered.oracle_sql()
COLUMNS = {
    "op1": "contaminated doc_id items_sha256 n_hit n_items n_words",
    "op2": "doc_id size source_size taken target",
    "op3": "doc_id n_bytes n_tokens over_limit",
    "op4": "base_score doc_id held_out n_known n_tokens score train_tokens",
    "op5": "doc_id held_out predicted score",
    "op6": "query_id rank score vec_id",
    "op7": "component_id doc_id fingerprint",
    "op8": "doc_id held_out predicted score",
    "op9": "doc_id n_bytes n_lines n_removed text_sha256",
    "op10": "doc_id entire licences n_licences",
    "op11": "collapsed_sha256 doc_id exponent_milli length n_runs period runs_sha256 start",
    "op12": "audit blank conv_id cost duplicate gaps illegal repaired_sha256 truncated",
    "op13": "component_id doc_id kept n_shingles",
    "pipeline": "doc_id size source_size taken target",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def _sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: ("nan" if math.isnan(v) else round(v, 9)) if isinstance(v, float) else v
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_all_are_registered():
    assert {k.split("_")[0] for k in registered.queries()} == set(COLUMNS)
    assert set(registered.queries()) <= set(entry_point.queries())
    assert set(SQL) <= set(registered.queries())


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_sql(spark, duck, key):
    found = registered.queries()[key](spark, FOLDER)
    result = duck.execute(SQL[key])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(found.columns)
    assert _sorted_rows(found.collect(), found.columns) == _sorted_rows(result.fetchall(), names)


@pytest.mark.parametrize("key", sorted(set(registered.queries()) - set(SQL)))
def test_returns_whole_table(spark, key):
    found = registered.queries()[key](spark, FOLDER)
    assert " ".join(sorted(found.columns)) == COLUMNS[key.split("_")[0]]
    n = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    if key.startswith("op12"):
        n = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id").distinct().count()
    assert 0 < found.count() < n if key == "pipeline" else found.count() == n
