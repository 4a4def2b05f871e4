"""SQL that a user may submit, as text with the tables it reads and the same question for an independent engine.

Every query reads whole tables. Where a key may be frequent, rows are aggregated by it before they are joined or
windowed, so that the partial aggregation takes the weight off that key before any shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipway.operators.execute import run_sql
from slipway.operators.positions import sorted_table
from slipway.plans.tables import read_table, views
from slipway.session import open_session, size_shuffles


@dataclass(frozen=True)
class Query:
    tables: str
    sql: str
    oracle: str | None = None
    args: Sequence[Any] | Mapping[str, Any] | None = None
    conf: Mapping[str, str] = field(default_factory=dict)

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        session = open_session(spark, self.conf, views(folder, self.tables.split()))
        return size_shuffles(run_sql(session, self.sql, self.args))

    @property
    def oracle_sql(self) -> str:
        return self.oracle or self.sql


ACCEPTANCE: dict[str, Query] = {
    # Projection, filter, expressions
    "sql_filter_project": Query(
        "lineitem",
        """select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) as net
           from lineitem where l_shipdate < timestamp '1996-01-01' and l_returnflag in ('A', 'R')""",
        conf={"spark.sql.timestampType": "TIMESTAMP_NTZ"},
    ),
    "sql_like_between": Query(
        "part",
        """select p_partkey from part
           where p_name like '%ring%' and p_size between 5 and 20 and p_brand is not null""",
    ),
    "sql_conditional": Query(
        "part",
        """select p_partkey, case when p_size > 25 then 'L' else 'S' end as c,
                  coalesce(nullif(p_type, 'ECONOMY'), 'E') as e, cast(p_size as string) as s
           from part""",
    ),
    # Joins
    "sql_join_inner": Query(
        "region nation customer orders",
        """select r_name, n_name, count(*) as customers, cast(sum(n) as bigint) as orders, round(sum(s), 2) as total
           from customer
           join (select o_custkey, count(*) as n, sum(o_totalprice) as s from orders group by o_custkey) o
             on c_custkey = o_custkey
           join nation on c_nationkey = n_nationkey
           join region on n_regionkey = r_regionkey
           group by r_name, n_name""",
    ),
    "sql_join_fact": Query(
        "orders lineitem",
        """select o_orderpriority, l_returnflag, cast(sum(n) as bigint) as lines, round(sum(q), 2) as quantity
           from orders
           join (select l_orderkey, l_returnflag, count(*) as n, sum(l_quantity) as q
                 from lineitem group by l_orderkey, l_returnflag) l
             on l_orderkey = o_orderkey
           group by o_orderpriority, l_returnflag""",
    ),
    "sql_join_left": Query(
        "customer orders",
        """select c_custkey, coalesce(n, 0) as n
           from customer
           left join (select o_custkey, count(*) as n from orders group by o_custkey) o on c_custkey = o_custkey""",
    ),
    "sql_join_full": Query(
        "part supplier", "select p_partkey, s_suppkey from part full join supplier on p_partkey = s_suppkey"
    ),
    "sql_join_semi": Query(
        "customer orders",
        """select c_custkey from customer
           where exists (select 1 from (select distinct o_custkey as k from orders
                                        where o_orderpriority = '1-URGENT' and o_orderstatus = 'F') u
                         where k = c_custkey)""",
    ),
    "sql_join_anti": Query(
        "customer orders",
        """select c_custkey from customer
           where not exists (select 1 from (select distinct o_custkey as k from orders
                                            where o_orderpriority = '1-URGENT' and o_orderstatus = 'F') u
                             where k = c_custkey)""",
    ),
    "sql_join_range": Query(
        "orders lineitem",
        """select o_orderpriority, cast(sum(n) as bigint) as n
           from orders
           join (select l_orderkey, l_shipdate, count(*) as n from lineitem group by l_orderkey, l_shipdate) l
             on l_orderkey = o_orderkey
            and l_shipdate > o_orderdate and l_shipdate <= o_orderdate + interval '30' day
           group by o_orderpriority""",
    ),
    "sql_lateral": Query(
        "nation supplier",
        """select n_name, t.m, t.c
           from nation, lateral (select max(s_acctbal) as m, count(*) as c
                                 from supplier where s_nationkey = n_nationkey) t""",
    ),
    # Aggregation
    "sql_agg": Query(
        "lineitem",
        """select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as q,
                  round(sum(l_extendedprice * (1 - l_discount)), 2) as net,
                  round(avg(l_extendedprice), 4) as a, min(l_tax) as lo, max(l_tax) as hi, count(*) as n
           from lineitem group by l_returnflag, l_linestatus""",
    ),
    "sql_agg_distinct": Query(
        "lineitem",
        "select count(distinct l_partkey) as n, cast(sum(distinct l_linenumber) as bigint) as s from lineitem",
    ),
    "sql_agg_filter": Query(
        "events",
        """select count(*) filter (where value > 50) as n, round(stddev_samp(value), 6) as sd,
                  round(corr(value, user_id), 6) as c
           from events""",
    ),
    "sql_having": Query(
        "orders",
        "select o_custkey, round(sum(o_totalprice), 2) as s from orders group by o_custkey having count(*) > 15",
    ),
    "sql_rollup": Query(
        "region nation customer",
        """select r_name, n_name, count(*) as n, cast(grouping(r_name) as int) as g
           from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
           group by rollup(r_name, n_name)""",
    ),
    "sql_cube": Query(
        "orders",
        """select o_orderstatus, o_orderpriority, count(*) as n
           from orders group by cube(o_orderstatus, o_orderpriority)""",
    ),
    "sql_grouping_sets": Query(
        "orders",
        """select o_orderstatus, o_orderpriority, count(*) as n
           from orders group by grouping sets((o_orderstatus), (o_orderpriority), ())""",
    ),
    "sql_pivot": Query(
        "orders",
        """select * from (select o_orderstatus, o_orderpriority, o_totalprice from orders)
           pivot(count(o_totalprice) for o_orderstatus in ('F' as f, 'O' as o, 'P' as p))""",
        oracle="""select o_orderpriority, count(o_totalprice) filter (where o_orderstatus = 'F') as f,
                         count(o_totalprice) filter (where o_orderstatus = 'O') as o,
                         count(o_totalprice) filter (where o_orderstatus = 'P') as p
                  from orders group by 1""",
    ),
    "sql_approx_distinct": Query(
        "lineitem",
        # 10 % is two standard errors of the default, which some keys exceed. Each aggregate has a scan to itself: in one,
        # Spark makes a sketch for each distinct key first.
        """select abs(max(estimate) - max(n)) < 0.1 * max(n) as ok
           from (select approx_count_distinct(l_partkey, 0.01) as estimate, 0L as n from lineitem
                 union all
                 select 0L, count(distinct l_partkey) from lineitem)""",
        oracle="select count(*) > 0 as ok from lineitem",
    ),
    # Windows, over groups that the calendar bounds
    "sql_window_rows": Query(
        "orders",
        """with months as (
             select o_orderpriority, date_format(o_orderdate, 'yyyy-MM') as mon, count(*) as n,
                    round(sum(o_totalprice), 2) as total
             from orders group by o_orderpriority, date_format(o_orderdate, 'yyyy-MM'))
           select o_orderpriority, mon, n, row_number() over w as rn,
                  rank() over (partition by o_orderpriority order by n desc) as rk,
                  lag(total) over w as previous, lead(n, 2) over w as after_next,
                  cast(sum(n) over (partition by o_orderpriority order by mon
                                    rows between 2 preceding and current row) as bigint) as n3
           from months window w as (partition by o_orderpriority order by mon)""",
        oracle="""with months as (
             select o_orderpriority, strftime(o_orderdate, '%Y-%m') as mon, count(*) as n,
                    round(sum(o_totalprice), 2) as total
             from orders group by 1, 2)
           select o_orderpriority, mon, n, cast(row_number() over w as int) as rn,
                  cast(rank() over (partition by o_orderpriority order by n desc) as int) as rk,
                  lag(total) over w as previous, lead(n, 2) over w as after_next,
                  cast(sum(n) over (partition by o_orderpriority order by mon
                                    rows between 2 preceding and current row) as bigint) as n3
           from months window w as (partition by o_orderpriority order by mon)""",
    ),
    "sql_window_rank": Query(
        "orders",
        """with days as (select o_orderstatus, o_orderdate, count(*) as n from orders group by all)
           select o_orderstatus, o_orderdate, ntile(4) over w as nt, percent_rank() over w as pr,
                  dense_rank() over (partition by o_orderstatus order by n) as dr,
                  first_value(o_orderdate) over w as fv
           from days window w as (partition by o_orderstatus order by n desc, o_orderdate)""",
        oracle="""with days as (select o_orderstatus, o_orderdate, count(*) as n from orders group by all)
           select o_orderstatus, o_orderdate, cast(ntile(4) over w as int) as nt, percent_rank() over w as pr,
                  cast(dense_rank() over (partition by o_orderstatus order by n) as int) as dr,
                  first_value(o_orderdate) over w as fv
           from days window w as (partition by o_orderstatus order by n desc, o_orderdate)""",
    ),
    "sql_window_range": Query(
        "events",
        """with hours as (
             select event_type, cast(date_trunc('hour', ts) as timestamp_ntz) as h, count(*) as n
             from events group by all)
           select event_type, h, cast(sum(n) over (partition by event_type order by h
               range between interval '6' hour preceding and current row) as bigint) as n6
           from hours""",
        oracle="""with hours as (
             select event_type, cast(date_trunc('hour', ts) as timestamp) as h, count(*) as n from events group by all)
           select event_type, h, cast(sum(n) over (partition by event_type order by h
               range between interval '6' hour preceding and current row) as bigint) as n6
           from hours""",
    ),
    # Sort, limit, set operations
    "sql_topk": Query(
        "orders",
        "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10 offset 5",
    ),
    "sql_union": Query(
        "customer orders", "select o_custkey as k from orders union select c_custkey from customer"
    ),
    "sql_union_all": Query(
        "orders lineitem",
        """select o_orderkey as k, 'orders' as src from orders
           union all select l_orderkey, 'lineitem' from lineitem""",
    ),
    "sql_intersect": Query(
        "customer orders",
        "select c_custkey as k from customer intersect select o_custkey from orders group by o_custkey",
    ),
    "sql_except_all": Query(
        "orders lineitem",
        """select o_orderkey as k from orders
           except all (select l_orderkey from lineitem where l_returnflag = 'R' group by l_orderkey)""",
    ),
    # Subqueries and CTEs
    "sql_in_subquery": Query(
        "customer nation",
        """select c_custkey from customer
           where c_nationkey in (select n_nationkey from nation where n_regionkey = 1)""",
    ),
    "sql_correlated": Query(
        "customer orders",
        """select c_custkey from customer c
           where 50 * c.c_acctbal > (select max(o.o_totalprice) from orders o where o.o_custkey = c.c_custkey)""",
    ),
    "sql_cte": Query(
        "orders",
        """with t as (select o_custkey, sum(o_totalprice) as s from orders group by o_custkey)
           select count(*) as n from t where s > (select avg(s) from t)""",
    ),
    "sql_no_relation": Query(
        "lineitem",
        """select l_linenumber * (select 1 + 1 as v) as twice, count(*) as n
           from lineitem group by l_linenumber""",
    ),
    "sql_recursive": Query(
        "orders",
        """with recursive per_year as (select year(o_orderdate) as oy, count(*) as n from orders group by 1),
                sides as (select 0 as side union all select 1 as side),
                spans(lo, hi) as (
             select cast(min(oy) - 1 as int), cast(max(oy) + 1 as int) from per_year
             union all
             select cast(case when side = 0 then lo else floor((lo + hi) / 2.0) + 1 end as int),
                    cast(case when side = 0 then floor((lo + hi) / 2.0) else hi end as int)
             from spans join sides on lo < hi)
           select lo as y, coalesce(n, 0) as n from spans left join per_year on lo = oy where lo = hi""",
    ),
    # Functions
    "sql_string": Query(
        "customer",
        """select c_custkey, upper(c_name) as u, substr(c_name, 1, 8) as s, length(c_name) as l,
                  regexp_replace(c_name, '[0-9]+', '') as r, split_part(c_name, '#', 2) as p,
                  lpad(c_mktsegment, 12, '*') as lp
           from customer""",
        oracle="""select c_custkey, upper(c_name) as u, substr(c_name, 1, 8) as s, cast(length(c_name) as int) as l,
                         regexp_replace(c_name, '[0-9]+', '') as r, split_part(c_name, '#', 2) as p,
                         lpad(c_mktsegment, 12, '*') as lp
                  from customer""",
    ),
    "sql_date": Query(
        "orders",
        """select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m,
                  cast(date_trunc('month', o_orderdate) as timestamp_ntz) as dt,
                  datediff(timestamp '2001-01-01', o_orderdate) as dd
           from orders""",
        oracle="""select o_orderkey, cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m,
                         cast(date_trunc('month', o_orderdate) as timestamp) as dt,
                         cast(date_diff('day', o_orderdate, timestamp '2001-01-01') as int) as dd
                  from orders""",
        conf={"spark.sql.timestampType": "TIMESTAMP_NTZ"},
    ),
    "sql_math": Query(
        "part",
        """select p_partkey, round(p_retailprice / 7, 2) as r, cast(floor(p_retailprice) as bigint) as f,
                  mod(p_partkey, 7) as m, sqrt(p_size) as s
           from part""",
    ),
    "sql_array": Query(
        "embeddings",
        """select vec_id, size(embedding) as n, round(aggregate(embedding, 0d, (a, x) -> a + x), 9) as s
           from embeddings""",
        oracle="""select vec_id, cast(len(embedding) as int) as n,
                         round(list_sum(list_transform(embedding, lambda x: x::double)), 9) as s
                  from embeddings""",
    ),
    "sql_explode": Query(
        "documents",
        """select w, count(*) as n from (select explode(split(text, ' ')) as w from documents)
           where w <> '' group by w""",
        oracle="""select w, count(*) as n from (select unnest(string_split(text, ' ')) as w from documents)
                  where w <> '' group by w""",
    ),
    "sql_url_map": Query(
        "pages",
        """select page_id, m['page'] as pg, m['ref'] as ref
           from (select page_id, str_to_map(parse_url(url, 'QUERY'), '&', '=') as m from pages)""",
        oracle="""select page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') as pg,
                         nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') as ref
                  from pages""",
    ),
    "sql_json": Query(
        "events",
        "select event_id, cast(get_json_object(props, '$.k') as int) as k from events",
        oracle="select event_id, cast(json_extract_string(props, '$.k') as int) as k from events",
    ),
    # Event-time windows
    "sql_tumbling": Query(
        "events",
        """select window.start as ws, event_type, count(*) as n
           from events group by window(ts, '1 hour'), event_type""",
        oracle="""select time_bucket(interval '1 hour', ts) as ws, event_type, count(*) as n
                  from events group by 1, 2""",
    ),
    "sql_sliding": Query(
        "events",
        "select window.start as ws, count(*) as n from events group by window(ts, '2 hours', '1 hour')",
        oracle="""select ws, count(*) as n
                  from (select time_bucket(interval '1 hour', ts) as ws from events
                        union all
                        select time_bucket(interval '1 hour', ts) - interval '1 hour' from events)
                  group by ws""",
    ),
    "sql_session": Query(
        "events",
        # Events of one hour are of one session. They are added up before the shuffle, so that a user's rows are bounded
        # by the calendar, however many events there are.
        """with hours as (select user_id, date_trunc('HOUR', ts) as hour, min(ts) as lo, max(ts) as hi, count(*) as n
                         from events group by 1, 2),
                begun as (select *, case when lo - lag(hi) over (partition by user_id order by hour) < interval '12' hour
                                         then 0 else 1 end as begins from hours),
                numbered as (select *, sum(begins) over (partition by user_id order by hour) as session from begun)
           select user_id, min(lo) as ss, sum(n) as n from numbered group by user_id, session""",
        oracle="""select user_id, min(ts) as ss, count(*) as n
                  from (select *, sum(f) over (partition by user_id order by ts, event_id) as sid
                        from (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id)
                                                  < interval '12 hours' then 0 else 1 end as f
                              from events))
                  group by user_id, sid""",
    ),
    # Bound arguments
    "sql_positional_args": Query(
        "orders",
        "select o_orderkey from orders where o_totalprice > ? and o_orderstatus = ?",
        oracle="select o_orderkey from orders where o_totalprice > 200000.0 and o_orderstatus = 'F'",
        args=[200000.0, "F"],
    ),
    "sql_named_args": Query(
        "orders",
        "select o_orderkey from orders where o_totalprice > :p and o_orderstatus = :s",
        oracle="select o_orderkey from orders where o_totalprice > 200000.0 and o_orderstatus = 'O'",
        args={"p": 200000.0, "s": "O"},
    ),
    # Functions of the engine that programs use
    "rand_in_range": Query(
        "events",
        """select count(*) as n, min(r) >= 0 as lo, max(r) < 1 as hi, round(avg(r), 1) as mean
           from (select random(42) as r from events)""",
        oracle="select count(*) as n, true as lo, true as hi, 0.5::double as mean from events",
    ),
}


# The last click before each purchase of the same user. The table is sorted by user and time and split by Spark's
# sampling (`_part`), so even one user's events are spread: each part looks back within itself, and the last click of
# the parts before is carried in from one row per part and user.
ASOF_SQL = """
with last_clicks as (
  select _part, user_id, max_by(event_id, _pos) filter (where event_type = 'click') as last_click
  from timeline group by _part, user_id),
carried as (
  select _part, user_id, last_value(last_click) ignore nulls over (partition by user_id order by _part
      rows between unbounded preceding and 1 preceding) as earlier
  from last_clicks),
looked_back as (
  select _part, user_id, event_id, event_type,
         last_value(case when event_type = 'click' then event_id end) ignore nulls
           over (partition by _part, user_id order by _pos rows unbounded preceding) as latest
  from timeline)
select event_id, coalesce(latest, earlier) as po
from looked_back join carried using (_part, user_id)
where event_type = 'purchase' and coalesce(latest, earlier) is not null
"""

ASOF_ORACLE = """
select e.event_id, max_by(o.event_id, {'t': o.ts, 'i': o.event_id}) as po
from events e join events o on e.user_id = o.user_id and o.ts < e.ts
where e.event_type = 'purchase' and o.event_type = 'click' group by e.event_id
"""


def sql_join_asof(spark: SparkSession, folder: str) -> DataFrame:
    def setup(session: SparkSession) -> None:
        events = read_table(session, folder, "events").select("event_id", "user_id", "ts", "event_type")
        timeline = events.filter(F.col("event_type").isin("click", "purchase"))
        # At the same instant purchases come first: a click counts only if it is earlier.
        order = [F.col("user_id"), F.col("ts"), F.col("event_type") == "click", F.col("event_id")]
        sorted_table(timeline, order).createOrReplaceTempView("timeline")

    return size_shuffles(run_sql(open_session(spark, setup=setup), ASOF_SQL))
