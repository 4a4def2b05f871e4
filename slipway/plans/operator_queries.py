"""The library's own operators, run over whole tables, each with the same question for an independent engine."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slipway.functions.aggregates import AggregateRegistry, Largest, WeightedMedian
from slipway.functions.scalars import mean_by, register_lines, register_sql_function, register_vectorized
from slipway.functions.tables import in_parts, register_first_rows
from slipway.operators.band_join import band_join
from slipway.operators.decode import (
    base64_text, decode_submissions, key_value_map, notebook_requests, route_submissions, valid_submissions,
)
from slipway.operators.execute import JobRegistry, run_sql
from slipway.operators.positions import with_row_index
from slipway.operators.render import render_columns, render_csv, render_json, render_rows
from slipway.operators.runner import Runner
from slipway.operators.sinks import literal_rows, publish_global_view, read_result, write_result
from slipway.operators.sketches import daily_sketches, distinct_members, in_both, merged, quantile, store_days
from slipway.operators.status import StatusStore, append_status
from slipway.operators.versions import read_version, write_version
from slipway.plans.tables import read_table, views
from slipway.session import open_session, table_views, work_path
from slipway.sources.submissions import read_submissions
from slipway.streaming.submissions import stream_submissions as start_stream
from slipway.streaming.windows import append_closed, distinct_events, tumbling_counts, write_latest


@dataclass(frozen=True)
class OperatorQuery:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


OPERATORS: dict[str, OperatorQuery] = {}


def _query(name: str, oracle: str | None):
    def add(run):
        OPERATORS[name] = OperatorQuery(run, oracle)
        return run

    return add


def _session(spark: SparkSession, folder: str, *tables: str) -> SparkSession:
    return open_session(spark, setup=views(folder, tables))


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))


# Decode, check, route


@_query(
    "decode_submissions",
    "select doc_id, 'SQL' as type, text as code, cast(doc_id as varchar) as a0, lang, source as result_format "
    "from documents",
)
def _decode_submissions(spark, folder):
    submissions = read_table(spark, folder, "documents").select(
        "doc_id",
        _json(
            type=F.lit("SQL"),
            code=F.col("text"),
            arguments=F.array(F.col("doc_id").cast("string")),
            environment=F.create_map(F.lit("lang"), F.col("lang")),
            resultFormat=F.col("source"),
        ).alias("value"),
    )
    return valid_submissions(decode_submissions(submissions)).select(
        "doc_id",
        "type",
        "code",
        F.col("arguments")[0].alias("a0"),
        F.col("environment")["lang"].alias("lang"),
        F.col("resultFormat").alias("result_format"),
    )


def _event_submissions(spark, folder) -> DataFrame:
    """A submission per event, with a different fault for each event type but one."""
    kind, code = F.col("event_type"), F.col("event_id").cast("string")
    return read_table(spark, folder, "events").select(
        "event_id",
        "event_type",
        F.when(kind == "click", F.concat(F.lit('{"type":"SQL","code":"'), code, F.lit('"}')))
        .when(kind == "view", F.concat(F.lit('{"type":"sql","code":"'), code, F.lit('"}')))
        .when(kind == "purchase", F.concat(F.lit('{"type":"SQL","resultPath":"'), code, F.lit('"}')))
        .when(kind == "signup", F.concat(F.lit('{"type":"SQL","arguments":"'), code, F.lit('"}')))
        .otherwise(F.concat(F.lit("{bad "), code))
        .alias("value"),
    )


@_query(
    "rejected_submissions",
    "select event_id, case event_type when 'view' then 'UNKNOWN_TYPE' when 'purchase' then 'UNKNOWN_FIELD' "
    "when 'signup' then 'BAD_FIELD_TYPE' else 'MALFORMED' end as reason from events where event_type <> 'click'",
)
def _rejected_submissions(spark, folder):
    decoded = decode_submissions(_event_submissions(spark, folder))
    return decoded.filter(F.col("reason").isNotNull()).select("event_id", "reason")


@_query(
    "notebook_requests",
    "select event_id, case event_type when 'purchase' then '--event ' || event_id end as arguments "
    "from events where event_type in ('purchase', 'click')",
)
def _notebook_requests(spark, folder):
    kind, event = F.col("event_type"), F.col("event_id").cast("string")

    def request(arguments: Column) -> Column:
        return _json(appId=event, configOverrides=F.struct(arguments.alias("arguments")))

    submissions = read_table(spark, folder, "events").select(
        "event_id",
        F.when(kind == "purchase", request(F.array(F.lit("--event"), event)))
        .when(kind == "click", request(event))
        .otherwise(_json(type=F.lit("SQL"), code=F.concat(F.lit("select appId from t where id = "), event)))
        .alias("value"),
    )
    requests = notebook_requests(decode_submissions(submissions))
    return requests.select("event_id", F.array_join("launch_arguments", " ").alias("arguments"))


@_query(
    "route_submissions",
    """select event_type, case when t = 'SQL' then 'sql' when t in ('PYTHON', 'PYTHON_BASE64') then 'job'
              else 'unsupported' end as route, p = '' as inline, count(*) as n
       from (select event_type, case event_type when 'click' then 'SQL' when 'purchase' then 'PYTHON'
                    when 'view' then 'PYTHON_BASE64' else 'COMMAND' end as t,
                    case when value > 50 then '' else 'p' end as p from events)
       group by all""",
)
def _route_submissions(spark, folder):
    kind = F.col("event_type")
    submissions = read_table(spark, folder, "events").select(
        "event_type",
        F.concat(
            F.lit('{"type":"'),
            F.when(kind == "click", "SQL")
            .when(kind == "purchase", "PYTHON")
            .when(kind == "view", "PYTHON_BASE64")
            .otherwise("COMMAND"),
            F.lit('","code":"'),
            F.base64(F.col("event_id").cast("string").cast("binary")),
            F.lit('","resultsPath":"'),
            F.when(F.col("value") > 50, "").otherwise("p"),
            F.lit('"}'),
        ).alias("value"),
    )
    routed = route_submissions(valid_submissions(decode_submissions(submissions)))
    return routed.groupBy("event_type", "route", "inline").agg(F.count("*").alias("n"))


@_query("base64_decode", "select doc_id, text as t from documents")
def _base64_decode(spark, folder):
    encoded = read_table(spark, folder, "documents").select(
        "doc_id", F.base64(F.col("text").cast("binary")).alias("code")
    )
    return encoded.select("doc_id", base64_text(F.col("code")).alias("t"))


@_query("kv_map", "select c_custkey, c_name as name, c_mktsegment || '=1' as seg, 2::int as n from customer")
def _kv_map(spark, folder):
    header = F.concat(F.lit("name=x,junk,seg="), "c_mktsegment", F.lit("=1,name="), "c_name")
    maps = read_table(spark, folder, "customer").select("c_custkey", key_value_map(header).alias("m"))
    return maps.select(
        "c_custkey", F.col("m")["name"].alias("name"), F.col("m")["seg"].alias("seg"), F.size("m").alias("n")
    )


# Sources, sessions, execution


@_query(
    "inline_ddl_table",
    """select label, count(*) as n, cast(sum(weight) as bigint) as weight
       from events join (values ('click', 1, 'low'), ('view', 0, 'low'), ('purchase', 10, 'high'),
                                ('signup', 5, 'high'), ('error', 2, 'low')) l(kind, weight, label) on event_type = kind
       group by label""",
)
def _inline_ddl_table(spark, folder):
    """Rows at hand with a declared schema, joined to a table."""
    labels = literal_rows(
        spark,
        [("click", 1, "low"), ("view", 0, "low"), ("purchase", 10, "high"), ("signup", 5, "high"), ("error", 2, "low")],
        "kind string, weight int, label string",
    )
    counts = read_table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    joined = counts.join(labels, counts["event_type"] == labels["kind"])
    return joined.groupBy("label").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("weight")).alias("weight"))


@_query("catalog_table", "select c_mktsegment, count(*) as n, round(sum(c_acctbal), 2) as s from customer group by 1")
def _catalog_table(spark, folder):
    path = work_path(spark, "catalog")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    totals = run_sql(
        _session(spark, folder, "customer"),
        "select c_mktsegment, count(*) as n, round(sum(c_acctbal), 2) as s from customer group by 1",
    )
    totals.write.option("path", path).saveAsTable(name)
    return run_sql(open_session(spark), f"select * from {name}")


@_query("global_temp_view", "select event_type, count(*) as n from events group by 1")
def _global_temp_view(spark, folder):
    name = work_path(spark, "view").rsplit("/", 1)[1].replace("-", "_")
    counts = read_table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    publish_global_view(counts, name)
    return run_sql(open_session(spark), f"select * from global_temp.{name}")


@_query(
    "session_isolation",
    "select role, count(*) as n, cast(sum(length(text)) as bigint) as chars from conversations group by 1",
)
def _session_isolation(spark, folder):
    """Three sessions use one view name for different rows."""

    def totals(role: str) -> DataFrame:
        session = open_session(spark)
        read_table(session, folder, "conversations").filter(F.col("role") == role).createOrReplaceTempView("mine")
        return run_sql(session, "select role, count(*) as n, sum(length(text)) as chars from mine group by role")

    return totals("user").union(totals("assistant")).union(totals("system"))


@_query("row_count", "select count(*) as n from lineitem")
def _row_count(spark, folder):
    return run_sql(_session(spark, folder, "lineitem"), "select count(*) as n from lineitem")


JOBS = JobRegistry()


@JOBS.register("priority_totals")
def _priority_totals(session, arguments, environment):
    """Orders per priority from the year given as the first argument on."""
    orders = session.table("orders").filter(F.year("o_orderdate") >= int(arguments[0]))
    return orders.groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@_query(
    "named_job",
    "select o_orderpriority, count(*) as n, round(sum(o_totalprice), 2) as total from orders "
    "where year(o_orderdate) >= 1998 group by 1",
)
def _named_job(spark, folder):
    return JOBS.run(_session(spark, folder, "orders"), "priority_totals", ["1998"])


# Rendering


@_query(
    "render_json",
    "select cast(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey, "
    "'c_acctbal': c_acctbal, 'c_mktsegment': c_mktsegment}) as varchar) as value from customer",
)
def _render_json(spark, folder):
    return render_json(read_table(spark, folder, "customer"))


@_query(
    "render_csv",
    "select concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f'), o_orderpriority) as value from orders",
)
def _render_csv(spark, folder):
    return render_csv(read_table(spark, folder, "orders"))


@_query(
    "render_rows",
    "select cast(to_json([cast(p_partkey as varchar), p_name, p_brand, p_type, cast(p_size as varchar), "
    "cast(p_retailprice as varchar)]) as varchar) as value from part",
)
def _render_rows(spark, folder):
    return render_rows(read_table(spark, folder, "part"))


@_query(
    "render_columns",
    """with o as (select row_number() over (order by o_orderkey) - 1 as i, * from orders),
            e as (select 'o_orderkey' as "column", i, cast(to_json(o_orderkey) as varchar) as v from o
                  union all select 'o_custkey', i, cast(to_json(o_custkey) as varchar) from o
                  union all select 'o_orderstatus', i, cast(to_json(o_orderstatus) as varchar) from o
                  union all select 'o_totalprice', i, cast(to_json(o_totalprice) as varchar) from o
                  union all select 'o_orderpriority', i, cast(to_json(o_orderpriority) as varchar) from o
                  union all select 'o_orderdate', i, cast(epoch_ms(o_orderdate) as varchar) from o)
       select "column", i // 1000 as chunk, '{' || string_agg('"' || i || '":' || v, ',' order by i) || '}' as value
       from e group by 1, 2""",
)
def _render_columns(spark, folder):
    return render_columns(read_table(spark, folder, "orders"), ["o_orderkey"])


@_query("row_positions", "select event_id, row_number() over (order by user_id, ts, event_id) - 1 as i from events")
def _row_positions(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts")
    return with_row_index(events, ["user_id", "ts", "event_id"], "i").select("event_id", "i")


# Sinks


def _round_trip(table: DataFrame, result_format: str | None) -> DataFrame:
    path = work_path(table.sparkSession, "result")
    write_result(table, path, result_format)
    return read_result(table.sparkSession, path, result_format, table.schema)


@_query("sink_roundtrip_csv", "select * from documents")
def _sink_roundtrip_csv(spark, folder):
    return _round_trip(read_table(spark, folder, "documents"), "csv")


@_query("sink_roundtrip_json", "select * from events")
def _sink_roundtrip_json(spark, folder):
    return _round_trip(read_table(spark, folder, "events"), "json")


@_query("sink_roundtrip_parquet", "select * from lineitem")
def _sink_roundtrip_parquet(spark, folder):
    return _round_trip(read_table(spark, folder, "lineitem"), "parquet")


@_query("sink_roundtrip_orc", "select * from conversations")
def _sink_roundtrip_orc(spark, folder):
    return _round_trip(read_table(spark, folder, "conversations"), "orc")


@_query("sink_roundtrip_text", "select p_name as value from part")
def _sink_roundtrip_text(spark, folder):
    return _round_trip(read_table(spark, folder, "part").select(F.col("p_name").alias("value")), "text")


@_query("sink_roundtrip_xml", "select * from customer")
def _sink_roundtrip_xml(spark, folder):
    return _round_trip(read_table(spark, folder, "customer"), "xml")


@_query("sink_roundtrip_default", "select * from orders")
def _sink_roundtrip_default(spark, folder):
    return _round_trip(read_table(spark, folder, "orders"), None)


# Functions


@_query("udf_sql", "select event_id, value * value as v from events")
def _udf_sql(spark, folder):
    session = _session(spark, folder, "events")
    register_sql_function(session, "mysqr", "x double", "double", "x * x")
    return run_sql(session, "select event_id, mysqr(value) as v from events")


@_query("udf_pandas", "select event_id, value * value as v from events")
def _udf_pandas(spark, folder):
    def square(values: pd.Series) -> pd.Series:
        return values * values

    session = _session(spark, folder, "events")
    register_vectorized(session, "sqr", square, "double")
    return run_sql(session, "select event_id, sqr(value) as v from events")


@_query("udaf_pandas", "select event_type, round(avg(value), 6) as v from events group by event_type")
def _udaf_pandas(spark, folder):
    means = mean_by(read_table(spark, folder, "events"), "event_type", "value")
    return means.select("event_type", F.round("mean", 6).alias("v"))


@_query(
    "udtf_rows",
    """select doc_id, i::int as i, lines[i + 1] as line
       from (select doc_id, lines, unnest(range(len(lines))) as i
             from (select doc_id, string_split(text, chr(10)) as lines from documents))""",
)
def _udtf_rows(spark, folder):
    session = _session(spark, folder, "documents")
    register_lines(session)
    return run_sql(session, "select doc_id, t.i, t.line from documents, lateral lines(text) t")


@_query(
    "udtf_table_argument",
    """select l_suppkey, l_orderkey, l_linenumber, l_extendedprice::double as price from lineitem
       qualify row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber) <= 5""",
)
def _udtf_table_argument(spark, folder):
    session = open_session(spark)
    register_first_rows(session)
    lines = read_table(session, folder, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("double").alias("price")
    )
    return in_parts(lines, "first_rows", ["l_suppkey"], ["price desc", "l_orderkey", "l_linenumber"], "5")


def _aggregates() -> AggregateRegistry:
    known = AggregateRegistry()
    known.register("weighted_median", WeightedMedian())
    known.register("largest_three", Largest(3))
    return known


@_query(
    "udaf_weighted_median",
    """with weights as (select l_returnflag, l_quantity, sum(l_linenumber) as w from lineitem group by all),
            sums as (select l_returnflag, l_quantity, sum(w) over (partition by l_returnflag order by l_quantity) as up_to,
                            sum(w) over (partition by l_returnflag) as whole from weights)
       select l_returnflag, min(l_quantity)::double as v from sums where 2 * up_to >= whole group by l_returnflag""",
)
def _udaf_weighted_median(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    return _aggregates().aggregate(lines, ["l_returnflag"], "weighted_median", ["l_quantity", "l_linenumber"], "v")


@_query(
    "udaf_largest",
    """select l_linestatus, place, l_extendedprice::double as price
       from (select l_linestatus, l_extendedprice,
                    row_number() over (partition by l_linestatus order by l_extendedprice desc) - 1 as place from lineitem)
       where place < 3""",
)
def _udaf_largest(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    found = _aggregates().aggregate(lines, ["l_linestatus"], "largest_three", ["l_extendedprice"], "prices")
    return found.select("l_linestatus", F.posexplode("prices").alias("place", "price")).withColumn("place", F.col("place").cast("long"))


# Scripts, and control of what runs


@_query(
    "sql_script",
    """with cuts as (select 1000 * power(2, i) as cut from range(0, 40) t(i)),
            counts as (select cut, count(o_orderkey) as n from cuts left join orders on o_totalprice > cut group by cut),
            chosen as (select min(cut) as cut from counts where n * 10 <= (select count(*) from orders))
       select o_orderpriority, count(*) as n from orders, chosen where o_totalprice > cut group by o_orderpriority""",
)
def _sql_script(spark, folder):
    return run_sql(
        _session(spark, folder, "orders"),
        """begin
             declare cut double default 1000;
             declare most bigint;
             set most = (select count(*) from orders);
             while (select count(*) from orders where o_totalprice > cut) * 10 > most do
               set cut = cut * 2;
             end while;
             select o_orderpriority, count(*) as n from orders where o_totalprice > cut group by o_orderpriority;
           end""",
    )


@_query(
    "retried_submissions",
    """select 'OK' as state, 'after 2 attempts' as note, r_name, count(c_custkey) as customers
       from region join nation on n_regionkey = r_regionkey join customer on c_nationkey = n_nationkey group by r_name""",
)
def _retried_submissions(spark, folder):
    jobs, tried = JobRegistry(), set()

    @jobs.register("customers_of_region")
    def customers(session, arguments, environment):
        if arguments[0] not in tried:
            tried.add(arguments[0])
            raise ConnectionError("the first attempt of each does not get through")
        return session.sql(
            "select r_name, count(*) as customers from region join nation on n_regionkey = r_regionkey "
            "join customer on c_nationkey = n_nationkey where r_name = ? group by r_name",
            args=[arguments[0]],
        )

    runner = Runner(
        work_path(spark, "results"), table_views(spark, folder, ["region", "nation", "customer"]), jobs,
        attempts=3, pause=0.05, time_limit=3600,
    )
    request = F.struct(
        F.lit("PYTHON").alias("type"), F.lit("customers_of_region").alias("code"), F.array("r_name").alias("arguments"),
        F.lit("parquet").alias("resultFormat"), F.concat(F.lit("by_region/of="), "r_regionkey").alias("resultsPath"),
    )
    status = runner.run(read_table(spark, folder, "region").select(F.to_json(request).alias("value")))
    counts = spark.read.parquet(f"{runner.results_root}/by_region")
    region = F.regexp_extract("results_path", r"of=(\d+)$", 1).cast("int").alias("of")
    return counts.join(status.select("state", F.col("error_message").alias("note"), region), "of").drop("of")


# Joins and aggregates beyond SQL's own


@_query(
    "band_join",
    """select a.event_type as a, b.event_type as b, count(*) as n, min(b.t - a.t) as least, max(b.t - a.t) as most
       from (select event_type, epoch_us(ts) as t from events) a join (select event_type, epoch_us(ts) as t from events) b
       on b.t between a.t - 5000000 and a.t + 20000000 group by all""",
)
def _band_join(spark, folder):
    """Events of any users from 5 seconds before to 20 seconds after each other: no key is equal."""
    events = read_table(spark, folder, "events")
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    left = events.select(F.col("event_type").alias("a"), time.alias("t"))
    right = events.select(F.col("event_type").alias("b"), time.alias("u"))
    near = band_join(left, right, "t", "u", 5_000_000, 20_000_000)
    gap = F.col("u") - F.col("t")
    return near.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(gap).alias("least"), F.max(gap).alias("most"))


@_query(
    "stored_sketches",
    """with d as (select event_type, user_id, value, ts::date as day from events),
       r as (select min(day) + 3 as lo, max(day) - 3 as hi from d)
       select event_type, count(*) as n, true as members_ok, true as both_ok, true as median_ok
       from d, r where day between lo and hi group by event_type""",
)
def _stored_sketches(spark, folder):
    """Sketches stored by day, merged over all days but three at each end, held against exact answers."""
    session = open_session(spark, {"spark.sql.session.timeZone": "UTC"})
    events = read_table(session, folder, "events").withColumn("day", F.to_date("ts"))
    path = work_path(spark, "sketches")
    store_days(daily_sketches(events, F.col("day"), ["event_type"], "user_id", "value"), path)
    bounds = events.agg(F.date_add(F.min("day"), 3).alias("lo"), F.date_sub(F.max("day"), 3).alias("hi")).first()
    whole = merged(session, path, ["event_type"], str(bounds.lo), str(bounds.hi))
    early = merged(session, path, ["event_type"], last=str(bounds.lo)).select("event_type", F.col("member_set").alias("early"))
    inside = events.where(F.col("day").between(bounds.lo, bounds.hi))
    before = events.where(F.col("day") <= bounds.lo).select("event_type", "user_id").distinct()
    shared = before.intersect(inside.select("event_type", "user_id")).groupBy("event_type").agg(F.count("*").alias("shared"))
    exact = inside.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("members_exact"), F.percentile("value", F.array(F.lit(0.45), F.lit(0.55))).alias("middle")
    )
    held = whole.join(early, "event_type").join(exact, "event_type").join(shared, "event_type")
    near = F.abs(distinct_members() - F.col("members_exact")) <= 0.06 * F.col("members_exact")
    both = F.abs(in_both("early", "member_set") - F.col("shared")) <= 0.06 * F.col("members_exact")
    median = quantile(0.5).between(F.col("middle")[0], F.col("middle")[1])
    return held.select("event_type", "n", near.alias("members_ok"), both.alias("both_ok"), median.alias("median_ok"))


# Running submissions


@_query(
    "typed_arguments",
    """select c_mktsegment, count(*) as n, round(sum(o_totalprice), 2) as s from orders join customer on o_custkey = c_custkey
       where c_mktsegment in ('BUILDING', 'MACHINERY', 'FURNITURE') and o_orderdate >= date '1996-03-01' and o_totalprice > 1234.5
       group by c_mktsegment order by c_mktsegment limit 2""",
)
def _typed_arguments(spark, folder):
    """A submission that binds a list, a date, a decimal and a limit, all by name."""
    runner = Runner(work_path(spark, "typed"), setup=table_views(spark, folder, ["orders", "customer"]))
    config = {"parameters": {
        "segments": ["BUILDING", "MACHINERY", "FURNITURE"], "day": {"type": "date", "value": "1996-03-01"}, "least": 1234.5, "n": 2,
    }}
    code = (
        "select c_mktsegment, count(*) as n, round(sum(o_totalprice), 2) as s from orders join customer on o_custkey = c_custkey "
        "where array_contains(:segments, c_mktsegment) and o_orderdate >= :day and o_totalprice > :least "
        "group by c_mktsegment order by c_mktsegment limit :n"
    )
    text = json.dumps({"type": "SQL", "code": code, "config": json.dumps(config), "resultFormat": "parquet", "resultsPath": "typed"})
    runner.run(spark.createDataFrame([(text,)], "value string"))
    return read_result(spark, f"{runner.results_root}/typed", "parquet")


@_query(
    "named_class",
    "select o_orderpriority, count(*) as n from orders where year(o_orderdate) >= 1997 group by o_orderpriority",
)
def _named_class(spark, folder):
    """A submission that names a registered program by its class, with arguments."""
    jobs = JobRegistry()

    @jobs.register("org.example.Priorities")
    def _priorities(session, arguments, environment):
        orders = session.table("orders").where(F.year("o_orderdate") >= int(arguments[0]))
        return orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))

    runner = Runner(work_path(spark, "classes"), setup=table_views(spark, folder, ["orders"]), jobs=jobs)
    text = json.dumps({"type": "JAVA", "className": "org.example.Priorities", "arguments": ["1997"], "resultsPath": "c"})
    runner.run(spark.createDataFrame([(text,)], "value string"))
    return read_result(spark, f"{runner.results_root}/c")


@_query(
    "versioned_result",
    "select o_orderstatus, count(*) as n, 2::bigint as version from orders group by o_orderstatus",
)
def _versioned_result(spark, folder):
    """Two versions of one result, the second made of the first; the newest is read, and its number."""
    path = work_path(spark, "versions")
    write_version(read_table(spark, folder, "orders"), path)
    number = write_version(read_version(spark, path).groupBy("o_orderstatus").agg(F.count("*").alias("n")), path, "json")
    return read_version(spark, path).withColumn("version", F.lit(number).cast("long"))


@_query(
    "status_lookup",
    "select event_type as state, count(*) as n from events where event_id % 97 = 0 group by event_type",
)
def _status_lookup(spark, folder):
    """Every event as an outcome in a status store of several segments, of which a stated set of ids is looked up."""
    path = work_path(spark, "outcomes")
    key = F.sha2(F.col("event_id").cast("string"), 256).alias("submission_id")
    events = read_table(spark, folder, "events")
    outcomes = events.select(key, F.col("event_type").alias("state"), F.col("ts").cast("timestamp").alias("finished_at"))
    for part in range(4):
        append_status(outcomes.where(F.crc32("submission_id") % 4 == part), path)
        if part % 2:
            StatusStore(spark, path).compact(after=2)
    asked = events.where("event_id % 97 = 0").select(key)
    return StatusStore(spark, path).known(asked).groupBy("state").agg(F.count("*").alias("n"))


def _segment_submissions(spark, folder) -> DataFrame:
    """One SQL submission per market segment, its argument bound and its result stored by segment."""
    segments = read_table(spark, folder, "customer").select("c_mktsegment").distinct()
    code = (
        "select c_mktsegment, count(*) as n, round(sum(c_acctbal), 2) as s "
        "from customer where c_mktsegment = ? group by c_mktsegment"
    )
    return segments.select(
        _json(
            type=F.lit("SQL"),
            code=F.lit(code),
            arguments=F.array("c_mktsegment"),
            resultFormat=F.lit("parquet"),
            resultsPath=F.concat(F.lit("segments/"), "c_mktsegment"),
        ).alias("value")
    )


def _runner(spark, folder, *tables) -> Runner:
    return Runner(work_path(spark, "results"), setup=views(folder, tables), jobs=JOBS)


def _segment_results(spark, runner) -> DataFrame:
    stored = spark.read.schema("c_mktsegment string, n bigint, s double").parquet(f"{runner.results_root}/segments/*")
    states = runner.status(spark).select(
        F.element_at(F.split("results_path", "/"), -1).alias("c_mktsegment"), "state", "response"
    )
    return stored.join(states, "c_mktsegment")


_SEGMENTS_ORACLE = (
    "select c_mktsegment, count(*) as n, round(sum(c_acctbal), 2) as s, 'OK' as state, "
    "'SQL code submitted' as response from customer group by 1"
)


@_query("run_submissions", _SEGMENTS_ORACLE)
def _run_submissions(spark, folder):
    runner = _runner(spark, folder, "customer")
    runner.run(_segment_submissions(spark, folder))
    return _segment_results(spark, runner)


@_query("stream_submissions", _SEGMENTS_ORACLE)
def _stream_submissions(spark, folder):
    """The same submissions, arriving as files."""
    runner = _runner(spark, folder, "customer")
    inbox = work_path(spark, "inbox")
    _segment_submissions(spark, folder).write.text(inbox)
    start_stream(spark, inbox, runner, work_path(spark, "checkpoint"), available_now=True).awaitTermination()
    return _segment_results(spark, runner)


@_query(
    "inline_results",
    """select c_mktsegment, cast(count(*) as varchar) as inline_rows
       from customer group by 1""",
)
def _inline_results(spark, folder):
    """Results without a path are kept as rendered text."""
    runner = _runner(spark, folder, "customer")
    segments = read_table(spark, folder, "customer").select("c_mktsegment").distinct()
    submissions = segments.select(
        _json(
            type=F.lit("SQL"),
            code=F.lit("select c_mktsegment, count(*) as n from customer where c_mktsegment = ? group by 1"),
            arguments=F.array("c_mktsegment"),
            resultFormat=F.lit("json"),
        ).alias("value")
    )
    runner.run(submissions)
    texts = spark.read.text(f"{runner.results_root}/_inline/*")
    return texts.select(
        F.get_json_object("value", "$.c_mktsegment").alias("c_mktsegment"),
        F.get_json_object("value", "$.n").alias("inline_rows"),
    )


@_query(
    "inline_answer",
    """select row_number() over (order by o_totalprice desc, o_orderkey) - 1 as i, o_orderkey || ',' || o_custkey as value
       from orders""",
)
def _inline_answer(spark, folder):
    """The answer to a submission without a path, in the order that its query asks for."""
    runner = _runner(spark, folder, "orders")
    code = "select o_orderkey, o_custkey from orders order by o_totalprice desc, o_orderkey"
    submission = _json(type=F.lit("SQL"), code=F.lit(code), resultFormat=F.lit("csv"))
    status = runner.run(spark.range(1).select(submission.alias("value")))
    rows = runner.answer_rows(spark, status.first()["submission_id"])
    return with_row_index(rows.withColumn("at", F.monotonically_increasing_id()), ["at"], "i").select("i", "value")


@_query("read_submissions", "select doc_id, text as code, true as has_file from documents")
def _read_submissions(spark, folder):
    """Submissions of a whole table, written as files and read from there."""
    inbox = work_path(spark, "inbox")
    number = F.col("doc_id").cast("string")
    read_table(spark, folder, "documents").select(
        _json(type=F.lit("SQL"), code=F.col("text"), arguments=F.array(number))
    ).write.text(inbox)
    read = decode_submissions(read_submissions(spark, inbox))
    return valid_submissions(read).select(
        F.col("arguments")[0].cast("bigint").alias("doc_id"), "code", F.contains("source_file", F.lit("inbox-")).alias("has_file")
    )


@_query(
    "submission_status",
    """select event_type as label, case event_type when 'click' then 'OK' when 'view' then 'FAILED'
              when 'purchase' then 'UNSUPPORTED' when 'signup' then 'REJECTED' else 'OK' end as state,
              case event_type when 'view' then 'DIVIDE_BY_ZERO' when 'signup' then 'UNKNOWN_FIELD' end as condition,
              case event_type when 'click' then 'SQL code submitted' when 'view' then 'Failed to submit code'
              when 'purchase' then 'R code submitted' when 'signup' then 'Failed to parse code submission'
              else 'PYTHON_BASE64 code submitted' end as response,
              cast(count(*) as bigint) as deliveries
       from events group by event_type""",
)
def _submission_status(spark, folder):
    """One submission per event, the same for all events of a type: each type is run once, its deliveries counted."""
    kind = F.col("event_type")
    submissions = read_table(spark, folder, "events").select(
        F.when(kind == "click", _json(type=F.lit("SQL"), code=F.lit("select count(*) as n from orders")))
        .when(kind == "view", _json(type=F.lit("SQL"), code=F.lit("select sum(o_orderkey / 0) as x from orders")))
        .when(kind == "purchase", _json(type=F.lit("R"), code=F.lit("print(1)")))
        .when(kind == "signup", _json(type=F.lit("SQL"), language=F.lit("en")))
        .otherwise(
            _json(
                type=F.lit("PYTHON_BASE64"),
                code=F.base64(F.lit("priority_totals").cast("binary")),
                arguments=F.array(F.lit("1998")),
            )
        )
        .alias("value"),
        kind.alias("source_file"),
    )
    status = _runner(spark, folder, "orders").run(submissions)
    return status.select(
        F.col("source_file").alias("label"),
        "state",
        F.col("error_condition").alias("condition"),
        "response",
        "deliveries",
    )


# Streaming windows


def _event_stream(spark, folder) -> DataFrame:
    """Events as a stream; watermarks need ``timestamp``, so the wall-clock time is cast."""
    # As a pattern, so that the table may be one file or a folder of files.
    events = spark.readStream.schema(read_table(spark, folder, "events").schema).parquet(f"{folder}/events.parque[t]")
    return events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "event_id")


@_query(
    "stream_tumbling",
    "select time_bucket(interval '1 hour', ts) as ws, event_type, count(*) as n from events group by 1, 2",
)
def _stream_tumbling(spark, folder):
    session = open_session(spark, {"spark.sql.session.timeZone": "UTC"})
    path, checkpoint = work_path(spark, "windows"), work_path(spark, "checkpoint")
    counts = tumbling_counts(_event_stream(session, folder), "ts", ["event_type"], "1 hour")
    flat = counts.select(F.col("window.start").cast("timestamp_ntz").alias("ws"), "event_type", "n")
    write_latest(flat, path, checkpoint).awaitTermination()
    return read_result(session, path, "parquet", flat.schema)


@_query(
    "stream_watermark",
    """select time_bucket(interval '1 hour', ts) as ws, event_type, count(*) as n from events
       where time_bucket(interval '1 hour', ts) + interval '1 hour'
             <= (select max(ts) from events) - interval '1 hour'
       group by 1, 2""",
)
def _stream_watermark(spark, folder):
    """Only windows that the watermark, one hour behind the latest event, has closed."""
    session = open_session(spark, {"spark.sql.session.timeZone": "UTC"})
    path, checkpoint = work_path(spark, "windows"), work_path(spark, "checkpoint")
    counts = tumbling_counts(_event_stream(session, folder), "ts", ["event_type"], "1 hour", "1 hour")
    flat = counts.select(F.col("window.start").cast("timestamp_ntz").alias("ws"), "event_type", "n")
    append_closed(flat, path, checkpoint).awaitTermination()
    return session.read.schema(flat.schema).parquet(path)


@_query("stream_dedup", "select event_id, event_type, ts from events")
def _stream_dedup(spark, folder):
    """Every event is delivered twice and comes out once."""
    session = open_session(spark, {"spark.sql.session.timeZone": "UTC"})
    path, checkpoint = work_path(spark, "events"), work_path(spark, "checkpoint")
    delivered = _event_stream(session, folder).union(_event_stream(session, folder))
    once = distinct_events(delivered, "ts", ["event_id"], "1 hour")
    flat = once.select("event_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))
    append_closed(flat, path, checkpoint).awaitTermination()
    return session.read.schema(flat.schema).parquet(path)
