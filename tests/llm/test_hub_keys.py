"""One key at half of all rows: adaptive execution must split the joins that meet it."""

import pytest
from pyspark.sql import functions as F

from slipway.llm import components, url_trust
from slipway.llm.components import connected_components

SETTINGS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def split(spark):
    session = spark.newSession()
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    return session


def hub(session):
    half = session.range(40_000, numPartitions=4)
    return half.select(F.lit(0).cast("long").alias("a"), (F.col("id") + 1).alias("b")).union(
        half.select((F.col("id") + 100_000).alias("a"), (F.col("id") + 200_000).alias("b"))
    )


def test_a_hub_is_split(split):
    near = components._both_ways(components.stored(hub(split), "edges"))
    joined = near.join(components._least_near(near), "a")
    rows = joined.selectExpr("sum(b)")
    rows.collect()
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()


def test_components_of_a_hub(split):
    found = connected_components(hub(split))
    assert found.where("label = 0").count() == 40_001
    assert found.count() == 40_001 + 80_000
    assert found.where("node >= 100000 and label <> node % 100000 + 100000").count() == 0


def test_a_host_with_very_many_links_is_split(split):
    links = hub(split).selectExpr("concat('h', a) as src", "concat('h', b) as dst", "1L as n")
    edges, totals = url_trust._shares(links, "src", "dst")
    assert totals.where("slots < 1").isEmpty() and edges.count() == 80_000
    joined = edges.join(totals, edges["src"] == totals["by"]).selectExpr("sum(total)")
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_slots_of_a_hub(split, monkeypatch):
    monkeypatch.setattr(url_trust, "LINKS_PER_SLOT", 1000)
    links = hub(split).selectExpr("concat('h', a) as src", "concat('h', b) as dst", "1L as n")
    edges, totals = url_trust._shares(links, "src", "dst")
    assert totals.where("by = 'h0'").first().slots == 40
    most = edges.groupBy("src", "slot").count().agg(F.max("count")).first()[0]
    assert most < 1300
