"""Band joins against all pairs, over dense stretches, heavy values, nulls and empty sides."""

import random

import pytest

from slipway.operators.band_join import band_join, bin_edges


def rows(chance, count):
    kinds = [lambda: chance.uniform(0, 1000), lambda: 500.0, lambda: 500 + chance.gauss(0, 1), lambda: None, lambda: float("nan")]
    return [(n, chance.choices(kinds, [5, 4, 4, 1, 1])[0]()) for n in range(count)]


@pytest.mark.parametrize("seed, below, above, bins", [(1, 2.5, 2.5, None), (2, 0, 0, 40), (3, -1, 4, 7), (4, 300, 50, 25)])
def test_all_pairs(spark, seed, below, above, bins):
    chance = random.Random(seed)
    left, right = rows(chance, 300), rows(chance, 250)
    expected = sorted(
        (i, j) for i, v in left for j, w in right
        if v is not None and w is not None and v == v and w == w and v - below <= w <= v + above
    )
    a = spark.createDataFrame(left, "i long, v double").repartition(3)
    b = spark.createDataFrame(right, "j long, w double")
    found = band_join(a, b, "v", "w", below, above, bins)
    assert sorted((row.i, row.j) for row in found.collect()) == expected
    assert found.columns == ["i", "v", "j", "w"]


def test_repeated_rows_and_empty_sides(spark):
    a = spark.createDataFrame([(1, 5)] * 40 + [(2, None)], "i long, v long")
    b = spark.createDataFrame([(6,)] * 3, "w long")
    assert band_join(a, b, "v", "w", 1, 1, 20).count() == 120
    assert band_join(a.limit(0), b, "v", "w", 1, 1).count() == band_join(a, b.limit(0), "v", "w", 1, 1).count() == 0


def test_plan_has_no_nested_loop(spark, table):
    events = table("events").selectExpr("event_id as a", "value as v"), table("events").selectExpr("event_id as b", "value as w")
    plan = band_join(*events, "v", "w", 0.01, 0.01)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "MapIn" not in plan


def test_edges_follow_the_rows(spark):
    values = spark.range(1000).selectExpr("cast(if(id < 900, id / 1000, id) as double) as v")
    edges = bin_edges([values], 10)
    assert len(edges) == 9 and sum(edge < 1 for edge in edges) >= 8
