from pyspark.sql import functions as F

from slipway.operators.positions import sorted_table, with_row_index
from slipway.plans.acceptance import sql_join_asof
from slipway.session import open_session


def split_session(spark):
    """A session in which small sort partitions are not put together."""
    return open_session(
        spark, {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    )


def test_index_follows_the_order(spark):
    df = split_session(spark).range(10_000).select(F.xxhash64("id").alias("h"), "id")
    rows = with_row_index(df.repartition(5), ["h"]).collect()
    assert sorted(r.row_index for r in rows) == list(range(10_000))
    assert [r.row_index for r in sorted(rows, key=lambda r: r.h)] == list(range(10_000))


def test_frequent_value_is_spread(spark):
    df = split_session(spark).range(30_000)
    df = df.select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    table = sorted_table(df, ["k", "id"])
    sizes = [r["count"] for r in table.groupBy("_part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 30_000 / 3
    assert with_row_index(df, ["k", "id"]).agg(F.count_distinct("row_index").alias("n")).first().n == 30_000


def test_copies_are_all_numbered(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"))
    assert sorted(r.row_index for r in with_row_index(df, ["k"]).collect()) == list(range(100))
    assert with_row_index(df.limit(0), ["k"]).count() == 0


def test_copies_that_fill_a_partition_are_spread(spark):
    df = split_session(spark).range(30_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"))
    sizes = [r["count"] for r in sorted_table(df, ["k"]).groupBy("_part").count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 5_000
    rows = with_row_index(df, ["k"]).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(30_000))
    assert [r.k for r in rows] == sorted(r.k for r in rows)
    assert rows[0].asDict().keys() == {"k", "row_index"}


def last_clicks(events):
    """Brute force: the latest click of the same user before each purchase."""
    found = {}
    for event in events:
        if event["event_type"] == "purchase":
            before = [
                (e["ts"], e["event_id"]) for e in events
                if e["event_type"] == "click" and e["user_id"] == event["user_id"] and e["ts"] < event["ts"]
            ]
            if before:
                found[event["event_id"]] = max(before)[1]
    return found


def test_asof_join_on_the_tables(spark, folder, table):
    events = [r.asDict() for r in table("events").collect()]
    assert {r.event_id: r.po for r in sql_join_asof(spark, folder).collect()} == last_clicks(events)


def test_asof_join_with_one_user_and_equal_times(spark, tmp_path):
    events = spark.range(3000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 5).cast("bigint").alias("user_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.floor(F.col("id") / 4))).alias("ts"),
        F.element_at(F.array(F.lit("click"), F.lit("purchase"), F.lit("view")), (F.abs(F.hash("id")) % 3 + 1)).alias(
            "event_type"
        ),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    rows = [r.asDict() for r in events.collect()]
    session = split_session(spark)
    assert {r.event_id: r.po for r in sql_join_asof(session, str(tmp_path)).collect()} == last_clicks(rows)
