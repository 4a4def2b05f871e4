"""Stored sketches against exact answers, over any days."""

import os

from pyspark.sql import functions as F

from slipway.operators.sketches import daily_sketches, distinct_members, in_both, merged, only_in, quantile, store_days


def stored(spark, path):
    rows = spark.range(60_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("day"),
        F.when(F.col("id") % 3 == 0, "a").otherwise(None).alias("kind"),
        (F.col("id") / 10 + 1000 * (F.col("id") % 10)).cast("long").alias("member"), F.rand(1).alias("size"),
    )
    store_days(daily_sketches(rows, F.col("day"), ["kind"], "member", "size"), path)
    return rows


def test_any_days_within_the_error(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = stored(spark, path)
    for first, last in ((None, None), ("2024-01-02", "2024-01-04"), ("2024-01-09", None), ("2025-01-01", None)):
        found = merged(spark, path, ["kind"], first, last).select("kind", "n", distinct_members().alias("d"), quantile(0.9).alias("q"))
        own = rows.where((F.col("day") >= (first or "2024-01-01")) & (F.col("day") <= (last or "2025-01-01")))
        exact = {row.kind: row for row in own.groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("member").alias("d")).collect()}
        got = {row.kind: row for row in found.collect()}
        assert got.keys() == exact.keys()
        for kind, row in got.items():
            assert row.n == exact[kind].n and abs(row.d - exact[kind].d) < 0.08 * exact[kind].d and abs(row.q - 0.9) < 0.03


def test_set_operations(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = stored(spark, path)
    one = merged(spark, path, [], "2024-01-01", "2024-01-03").select(F.col("member_set").alias("x"))
    other = merged(spark, path, [], "2024-01-03", "2024-01-05").select(F.col("member_set").alias("y"))
    found = one.crossJoin(other).select(in_both("x", "y").alias("both"), only_in("x", "y").alias("only")).first()
    members = lambda a, b: {r.member for r in rows.where(F.col("day").between(a, b)).select("member").distinct().collect()}
    x, y = members("2024-01-01", "2024-01-03"), members("2024-01-03", "2024-01-05")
    assert abs(found.both - len(x & y)) < 0.08 * len(x | y) and abs(found.only - len(x - y)) < 0.08 * len(x | y)


def test_a_day_is_replaced_alone_and_pruned(spark, tmp_path):
    path = str(tmp_path / "s")
    stored(spark, path)
    again = spark.createDataFrame([(1, 2.0)], "member long, size double")
    store_days(daily_sketches(again.withColumn("kind", F.lit("z")), F.lit("2024-01-05").cast("date"), ["kind"], "member", "size"), path)
    assert merged(spark, path, ["kind"], "2024-01-05", "2024-01-05").select("kind", "n").collect() == [("z", 1)]
    assert len([name for name in os.listdir(path) if name.startswith("day=")]) == 10
    assert merged(spark, path, [], "2024-01-06").first().n == 5 * 6000
    plan = merged(spark, path, ["kind"], "2024-01-05", "2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
