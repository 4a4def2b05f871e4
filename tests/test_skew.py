"""The SQL over tables in which one key holds a third of all rows, rows are repeated and values are missing."""

import duckdb
import pytest
from pyspark.sql import functions as F

from slipway.plans.acceptance import ACCEPTANCE, ASOF_ORACLE, sql_join_asof
from slipway.plans.operator_queries import OPERATORS
from test_queries import rows

HOT = {
    "orders": ("o_custkey", 7), "lineitem": ("l_orderkey", 5), "events": ("user_id", 3),
    "documents": ("text", "the the the"), "customer": ("c_nationkey", 4), "conversations": ("text", "x\n\ny"),
}
MISSING = {
    "orders": ["o_custkey", "o_orderpriority", "o_totalprice", "o_orderstatus"],
    "lineitem": ["l_partkey", "l_returnflag", "l_quantity", "l_orderkey"],
    "events": ["value", "props"],
    "documents": ["text", "lang"],
    "customer": ["c_acctbal", "c_nationkey"],
    "part": ["p_size", "p_brand", "p_retailprice"],
    "supplier": ["s_acctbal", "s_nationkey"],
}
TABLES = {*HOT, *MISSING, "nation", "region", "pages", "embeddings"}

# Text that is missing ends a submission's life as text, and a missing time has no place in a window.
OPERATOR_NAMES = (
    "row_positions", "kv_map", "udaf_pandas", "udf_sql", "udf_pandas", "base64_decode", "udtf_rows", "render_rows",
    "sink_roundtrip_csv", "sink_roundtrip_json", "sink_roundtrip_xml", "sink_roundtrip_default", "run_submissions",
    "rejected_submissions", "submission_status", "stream_tumbling", "session_isolation",
)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    from conftest import TESTDATA

    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        df = spark.read.parquet(f"{TESTDATA}/{name}.parquet")
        number = F.abs(F.xxhash64(F.lit(name), *df.columns))
        if name in HOT:
            key, value = HOT[name]
            hot = F.lit(value).cast(df.schema[key].dataType)
            df = df.withColumn(key, F.when(number % 3 == 0, hot).otherwise(F.col(key)))
        for i, column in enumerate(MISSING.get(name, [])):
            df = df.withColumn(column, F.when(number % 11 != i + 3, F.col(column)))
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def oracle(skewed):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{skewed}/{name}.parquet/*.parquet')")
    yield connection
    connection.close()


def compare(found, expected):
    found, expected = found.toArrow(), expected.to_arrow_table()
    columns = sorted(found.column_names)
    assert columns == sorted(expected.column_names)
    assert rows(found, columns) == rows(expected, columns)


@pytest.mark.parametrize("name", ACCEPTANCE)
def test_sql(spark, skewed, oracle, name):
    query = ACCEPTANCE[name]
    compare(query.run(spark, skewed), oracle.sql(query.oracle_sql))


def test_asof(spark, skewed, oracle):
    compare(sql_join_asof(spark, skewed), oracle.sql(ASOF_ORACLE))


@pytest.mark.parametrize("name", OPERATOR_NAMES)
def test_operator(spark, skewed, oracle, name):
    query = OPERATORS[name]
    compare(query.run(spark, skewed), oracle.sql(query.oracle))
