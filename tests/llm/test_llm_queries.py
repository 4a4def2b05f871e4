import duckdb
import pytest
from conftest import TABLES, TESTDATA

import __spark_entry__
import corpus_pipeline
from slipway.llm.queries import ORACLES, QUERIES


def rows(table):
    columns = sorted(table.column_names)
    return columns, sorted(zip(*(table[name].to_pylist() for name in columns), strict=True), key=repr)


@pytest.mark.parametrize("name", ORACLES)
def test_same_as_sql(spark, folder, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{TESTDATA}/{table}.parquet')")
    found = QUERIES[name](spark, folder).toArrow()
    expected = connection.sql(ORACLES[name]).to_arrow_table()
    assert {c: str(found.schema.field(c).type) for c in found.column_names} == {
        c: str(expected.schema.field(c).type) for c in expected.column_names
    }
    assert rows(found) == rows(expected)


def test_every_number_is_registered():
    names = __spark_entry__.queries()
    assert {name.split("_")[0] for name in QUERIES} == {f"op{number}" for number in range(1, 14)}
    assert QUERIES.keys() | {"pipeline"} <= names.keys()


def test_pipeline(spark, folder, table):
    """Stage by stage against what each operator says about its input."""
    docs = table("documents")
    ids = {row.doc_id for row in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, folder)
        path = corpus_pipeline.stored(found, "test")
        left = {row.doc_id for row in path.select("doc_id").collect()}
        assert left <= ids and path.count() == len(left)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert found.columns == docs.columns
        if name in ("secret scan", "byte-level BPE"):
            assert left == ids
        else:
            assert left < ids
        docs, ids = path, left
    assert set(docs.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
