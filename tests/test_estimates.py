"""Estimates stay within what their queries promise."""

from slipway.plans.acceptance import ACCEPTANCE


def test_approximate_distinct_holds_ten_per_cent(spark, tmp_path):
    """Of these 2,000 keys the default sketch sees 11.35 % too many or too few."""
    keys = spark.range(396000, 398000).selectExpr("id as l_partkey")
    keys.union(keys).write.parquet(f"{tmp_path}/lineitem.parquet")
    off = "abs(approx_count_distinct(l_partkey) - 2000) / 2000 as off"
    assert keys.selectExpr(off).first().off > 0.1
    assert [tuple(row) for row in ACCEPTANCE["sql_approx_distinct"].run(spark, str(tmp_path)).collect()] == [(True,)]
