"""Relational coverage: scans, predicates, joins, aggregates, windows, sorting, set operations and functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestack.plans.queries import query, sql, table

TS = "timestamp_ntz'{}'"


# Scans and projections


@query(
    "pricing_summary",
    """select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*) as n
       from lineitem where l_shipdate >= timestamp '1996-01-01' and l_quantity between 5 and 40 and l_returnflag in ('A', 'N', 'R')
       group by l_returnflag, l_linestatus""",
)
def pricing_summary(spark: SparkSession, folder: str) -> DataFrame:
    kept = table(spark, folder, "lineitem").where("l_shipdate >= timestamp_ntz'1996-01-01 00:00:00' and l_quantity between 5 and 40 and l_returnflag in ('A', 'N', 'R')")
    return kept.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


sql("scan_project", "select o_orderkey, o_totalprice, o_orderstatus as status from orders")
sql("scan_count_star", "select count(*) as n from lineitem")
sql("scan_limit_sorted", "select c_custkey, c_name, c_acctbal from customer order by c_acctbal desc, c_custkey limit 25")
sql("scan_values", "select cast(a as string) as a, b, cast(a * 2 as string) as doubled from (values (1, 'x'), (2, 'y'), (cast(null as int), 'z')) as t(a, b)")


@query("scan_file_by_path", "select count(*) as n, round(sum(p_retailprice), 2) as total from part where p_size > 10")
def scan_file_by_path(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(f"select count(*) as n, round(sum(p_retailprice), 2) as total from parquet.`{folder}/part.parquet` where p_size > 10")


sql("project_boolean_expr", "select p_partkey, nullif(p_size, 10) is null as is_ten, p_size > 25 as large, p_size = 5 and p_retailprice < 1500 as both_, p_size <> 7 or p_brand is not null as either_ from part")
sql("project_computed", "select l_orderkey, l_linenumber, l_quantity + 1 as q1, round(l_extendedprice * (1 - l_discount), 4) as net, 0.5 as half, substring(l_returnflag, 1, 1) as flag from lineitem")


@query("project_nested", "select event_id, user_id as uid, event_type as kind from events where value > 0.5 and event_type = 'click'")
def project_nested(spark: SparkSession, folder: str) -> DataFrame:
    packed = table(spark, folder, "events").select("event_id", F.struct("user_id", F.struct("event_type", "value").alias("b")).alias("a"))
    return packed.where("a.b.value > 0.5 and a.b.event_type = 'click'").select("event_id", F.col("a.user_id").alias("uid"), F.col("a.b.event_type").alias("kind"))


# Predicates

_PICK = "select l_orderkey, l_linenumber, l_quantity from lineitem where "
sql("filter_cmp", _PICK + "l_quantity >= 45 and l_discount < 0.05 and l_tax <= 0.04")
sql("filter_between", _PICK + "l_quantity between 10 and 12 and l_extendedprice between 5000 and 20000")
sql("filter_in", _PICK + "l_linenumber in (1, 2, 3) and l_returnflag in ('A', 'R')")
sql("filter_in_null", "select p_partkey from part where p_size in (1, 2, cast(null as int))")
sql("filter_not_in", _PICK + "l_linenumber not in (1, 2, 3)")
sql("filter_ne", "select c_custkey from customer where nullif(c_mktsegment, 'BUILDING') <> 'MACHINERY'")
sql("filter_or_same_col", "select p_partkey, p_size from part where p_size = 0 or p_size > 10 and p_size <= 20 or p_size = 49")
sql("filter_or_multi_col", "select p_partkey, p_size from part where p_size = 3 or p_retailprice > 1800 or p_brand = 'Brand#11'")
sql("filter_is_null", "select c_custkey, nullif(c_nationkey, 5) is null as gone from customer where nullif(c_nationkey, 5) is null or nullif(c_nationkey, 7) is not null and c_acctbal < 0")
sql("filter_like_substring", "select p_partkey, p_name from part where p_name like '%ing%'")
sql("filter_like_other", "select p_partkey, p_name, p_type from part where p_name like 'red%' and p_type not like '%R_MO' or p_name like '%a_vil' or p_name like 'hot %r'")
sql("filter_fn_post", "select p_partkey from part where cos(p_size) > 0.3 and length(p_name) > 3 and substr(p_brand, 1, 3) in ('Bra', 'bra')")
sql("filter_nan", "select event_id from events where (case when value > 0.9 then cast('NaN' as double) else value end) > 0.8")
_NAN = "(case when value > 9 then cast('NaN' as double) else value end)"
sql("filter_nan_eq", f"select event_id from events where {_NAN} = cast('NaN' as double)")
sql("filter_nan_ne", f"select event_id from events where {_NAN} <> cast('NaN' as double) and event_id < 5000")
sql("filter_nan_lt", f"select event_id, value from events where {_NAN} < cast('NaN' as double) and {_NAN} >= 5")
sql("filter_boolean_literal", "select c_custkey from customer where (c_acctbal > 5000) = true and (c_nationkey = 3) <> true")
sql("filter_char_literal", "select o_orderkey from orders where cast(o_orderstatus as char(1)) = 'F' and o_orderpriority in ('1-URGENT', '5-LOW')")
sql("filter_binary_literal", "select c_custkey from customer where cast(c_mktsegment as binary) = X'4255494C44494E47' or cast(c_mktsegment as binary) > X'4D'", "select c_custkey from customer where c_mktsegment = 'BUILDING' or c_mktsegment > 'M'")
sql("filter_timestamp_literal", f"select event_id from events where ts >= {TS.format('2024-01-01 06:00:00')} and ts < {TS.format('2024-01-01 18:30:00.5')}", "select event_id from events where ts >= timestamp '2024-01-01 06:00:00' and ts < timestamp '2024-01-01 18:30:00.5'")
sql("filter_not_boolean", "select p_partkey from part where not (p_size > 10 and p_brand <> 'Brand#11') and not p_name like '%bolt'")
sql("filter_in_many", "select l_orderkey, l_linenumber from lineitem where l_orderkey in (" + ", ".join(str(7 * k) for k in range(400)) + ")")
sql("filter_always_false", "select l_orderkey from lineitem where l_quantity > 10 and l_quantity < 5")
sql("filter_decimal_date", "select o_orderkey from orders where cast(o_totalprice as decimal(12, 2)) >= 1500.25 and cast(o_orderdate as date) between date '1996-02-02' and date '1996-08-22'")

# Joins

sql("join_inner", "select n.n_name, c.c_custkey from customer c join nation n on c.c_nationkey = n.n_nationkey where c.c_acctbal > 5000")
sql("join_left", "select n.n_nationkey, cast(s.s_suppkey as string) as s_suppkey from nation n left join supplier s on n.n_nationkey = s.s_nationkey and s.s_acctbal > 6000")
sql("join_right", "select c.c_custkey, cast(o.o_orderkey as string) as o_orderkey from orders o right join customer c on o.o_custkey = c.c_custkey and o.o_totalprice > 300000")
sql("join_full", "select cast(a.k as string) as a_key, cast(b.k as string) as b_key from (select c_custkey as k from customer where c_acctbal > 5000) a full outer join (select o_custkey as k from orders where o_totalprice > 300000 group by o_custkey) b on a.k = b.k")
sql("join_cross", "select r.r_name, n.n_name from region r cross join nation n")
sql("join_semi", "select c.c_custkey from customer c semi join orders o on c.c_custkey = o.o_custkey and o.o_totalprice > 200000")
sql("join_anti", "select c.c_custkey from customer c anti join orders o on c.c_custkey = o.o_custkey and o.o_totalprice > 400000")
sql("join_self", "select a.o_custkey, count(*) as n from orders a join orders b on a.o_custkey = b.o_custkey and a.o_orderkey < b.o_orderkey group by a.o_custkey")
sql("join_null_keys", "select count(*) as n from (select nullif(c_nationkey, 3) as k from customer) a join (select nullif(n_nationkey, 3) as k from nation) b on a.k = b.k")
sql("join_multiway", "select r.r_name, count(*) as n, round(sum(o.o_totalprice), 2) as total from region r join nation n on n.n_regionkey = r.r_regionkey join customer c on c.c_nationkey = n.n_nationkey join orders o on o.o_custkey = c.c_custkey group by r.r_name")


@query("join_broadcast", "select s.s_suppkey, n.n_name from supplier s join nation n on s.s_nationkey = n.n_nationkey")
def join_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    """The small side is left to the optimiser, which sends it only below spark.sql.autoBroadcastJoinThreshold."""
    s, n = table(spark, folder, "supplier"), table(spark, folder, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", "n_name")


@query(
    "join_theta_range",
    "select e.event_id, w.w from events e join (select i as w, i * 100 as low, i * 100 + 5 as high from range(0, 200) t(i)) w on e.event_id >= w.low and e.event_id < w.high",
)
def join_theta_range(spark: SparkSession, folder: str) -> DataFrame:
    """A range join by bins: both sides are dealt by bin, so it is an equi-join and not a nested loop."""
    from lodestack.operators.joins import range_join

    windows = spark.range(200).select(F.col("id").alias("w"), (F.col("id") * 100).alias("low"), (F.col("id") * 100 + 5).alias("high"))
    return range_join(table(spark, folder, "events").select("event_id"), windows, "event_id", "low", "high", width=50).select("event_id", "w")


@query("join_skewed", "select o_orderstatus as k, count(*) as n from orders group by o_orderstatus")
def join_skewed(spark: SparkSession, folder: str) -> DataFrame:
    """A join on a hot key, salted on both sides."""
    from lodestack.operators.joins import salted_join

    states = table(spark, folder, "orders").select("o_orderstatus").distinct().select(F.col("o_orderstatus").alias("k"))
    return salted_join(table(spark, folder, "orders").select(F.col("o_orderstatus").alias("k"), "o_orderkey"), states, ["k"], salts=8).groupBy("k").agg(F.count("*").alias("n"))


@query("join_colocated", "select o.o_orderkey, count(*) as n from orders o join lineitem l on o.o_orderkey = l.l_orderkey where o.o_totalprice > 250000 group by o.o_orderkey")
def join_colocated(spark: SparkSession, folder: str) -> DataFrame:
    """Join and aggregation on one key share one exchange of each side."""
    o = table(spark, folder, "orders").where("o_totalprice > 250000").select("o_orderkey")
    l = table(spark, folder, "lineitem").select("l_orderkey")  # noqa: E741
    return o.join(l, o.o_orderkey == l.l_orderkey).groupBy("o_orderkey").agg(F.count("*").alias("n"))


@query("join_dynamic_filter", "select count(*) as n, round(sum(l.l_quantity), 2) as q from lineitem l join orders o on l.l_orderkey = o.o_orderkey where o.o_orderdate >= timestamp '1998-01-01' and o.o_orderdate < timestamp '1998-01-08'")
def join_dynamic_filter(spark: SparkSession, folder: str) -> DataFrame:
    from lodestack.operators.joins import filtered_join

    o = table(spark, folder, "orders").where("o_orderdate >= timestamp_ntz'1998-01-01 00:00:00' and o_orderdate < timestamp_ntz'1998-01-08 00:00:00'").select("o_orderkey")
    l = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity")  # noqa: E741
    return filtered_join(l, o, "l_orderkey", "o_orderkey").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("q"))


sql("subquery_exists", "select c_custkey from customer c where exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_orderpriority = '1-URGENT') and c_acctbal > 0")
sql("subquery_in", "select s_suppkey from supplier where s_nationkey in (select n_nationkey from nation where n_regionkey = 2)")
sql("subquery_correlated_scalar", "select p_brand, p_partkey, p_size from part p1 where p_size > (select avg(p_size) + 10 from part p2 where p2.p_brand = p1.p_brand and p2.p_retailprice > 100) and (select count(*) from part p3 where p3.p_type = p1.p_type and p3.p_size < 30) > 2")
sql("cte", "with big as (select o_custkey, sum(o_totalprice) as total from orders group by o_custkey), top as (select * from big where total > 1000000) select count(*) as n, round(max(total), 2) as most from top")

# Aggregates

sql("agg_basic", "select l_returnflag, count(*) as n, round(sum(l_quantity), 2) as s, round(avg(l_extendedprice), 4) as a, min(l_tax) + 0.0 as lo, max(l_tax) as hi from lineitem group by l_returnflag")
sql("agg_distinct", "select count(distinct l_suppkey) as suppliers, count(distinct l_partkey) as parts, count(distinct l_returnflag) as flags from lineitem")
sql("agg_filter", "select l_linestatus, count(*) filter (where l_discount > 0.05) as n, round(sum(l_quantity) filter (where l_returnflag = 'A'), 2) as q from lineitem group by l_linestatus")
sql("agg_having", "select o_custkey, count(*) as n from orders group by o_custkey having count(*) > 12 and max(o_totalprice) > 1000")
sql("agg_rollup", "select l_returnflag, l_linestatus, count(*) as n from lineitem group by rollup(l_returnflag, l_linestatus)")
sql("agg_cube", "select l_returnflag, cast(l_linenumber as string) as l_linenumber, count(*) as n, cast(grouping(l_linenumber) as int) as g from lineitem group by cube(l_returnflag, l_linenumber)")
sql("agg_grouping_sets", "select cast(n_regionkey as string) as n_regionkey, n_name, count(*) as n from nation group by grouping sets ((n_regionkey), (n_name), ())")
sql("agg_stddev", "select p_brand, round(stddev_samp(p_retailprice), 4) as sd, round(var_pop(p_size), 4) as v, round(corr(p_size, p_retailprice), 6) as r from part group by p_brand")
sql("agg_percentile", "select p_brand, round(percentile_cont(0.5) within group (order by p_retailprice), 4) as med from part group by p_brand")
sql("agg_nulls", "select count(x) as n, count(*) as all_, sum(x) is null as nothing from (select nullif(p_size, p_size) as x from part) t")
sql("select_distinct_expr", "select distinct p_size + 1 as s from part where p_size > 26 and p_brand is not null")


@query("agg_collect", "select o_custkey, array_to_string(list_sort(list(o_orderkey)), ',') as keys from orders group by o_custkey")
def agg_collect(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list("o_orderkey")).cast("array<string>"), ",").alias("keys"))


@query("agg_approx_distinct", "select l_linenumber, count(distinct l_partkey) as parts, count(distinct l_orderkey) as orders, true as close from lineitem group by l_linenumber")
def agg_approx_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches beside exact counts, with whether they are within a tenth."""
    exact = table(spark, folder, "lineitem").groupBy("l_linenumber").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_orderkey").alias("orders"), F.approx_count_distinct("l_partkey", 0.02).alias("a"), F.approx_count_distinct("l_orderkey", 0.02).alias("b"))
    return exact.select("l_linenumber", "parts", "orders", ((F.abs(F.col("a") / F.col("parts") - 1) < 0.1) & (F.abs(F.col("b") / F.col("orders") - 1) < 0.1)).alias("close"))


# Windows

sql("win_rank", "select c_custkey, rank() over (partition by c_mktsegment order by c_nationkey) as r, dense_rank() over (partition by c_mktsegment order by c_nationkey) as d, round(percent_rank() over (partition by c_mktsegment order by c_nationkey), 6) as p, round(cume_dist() over (partition by c_mktsegment order by c_nationkey), 6) as u from customer")
sql("win_row_number", "select o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn from orders")
sql("win_lag_lead", "select event_id, cast(lag(event_id, 1) over (partition by user_id order by event_id) as string) as before, lead(event_id, 2, -1) over (partition by user_id order by event_id) as after from events")
sql("win_rows_frame", "select event_id, round(sum(value) over (partition by user_id order by event_id rows between 3 preceding and current row), 4) as s, count(*) over (partition by user_id order by event_id rows between unbounded preceding and 1 following) as n from events")
sql("win_range_frame", "select o_orderkey, count(*) over (partition by o_orderstatus order by o_custkey range between 5 preceding and 5 following) as n from orders")
sql("win_ntile", "select c_custkey, ntile(7) over (partition by c_nationkey order by c_acctbal, c_custkey) as t from customer")
sql("win_first_last", "select event_id, first_value(event_id) over (partition by user_id order by event_id) as f, last_value(event_id) over (partition by user_id order by event_id rows between unbounded preceding and unbounded following) as l, nth_value(event_id, 2) over (partition by user_id order by event_id rows between unbounded preceding and unbounded following) as second from events")
sql("win_conversation", "select conv_id, turn, role, lag(role) over (partition by conv_id order by turn) as before from conversations")

# Sorting

sql("sort_nulls", "select c_custkey, cast(k as string) as k, row_number() over (partition by c_mktsegment order by k asc nulls first, c_custkey) as at_first, row_number() over (partition by c_mktsegment order by k desc nulls last, c_custkey) as at_last from (select nullif(c_nationkey, 4) as k, c_custkey, c_mktsegment from customer) t")
sql("limit_rows", "select count(*) as n, count(distinct l_orderkey) <= 500 as few from (select l_orderkey from lineitem limit 500) t")
sql("topk", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
sql("offset_limit", "select p_partkey from part order by p_retailprice, p_partkey limit 15 offset 30")


@query("topk_per_group", "select c_mktsegment, c_custkey from (select *, row_number() over (partition by c_mktsegment order by c_acctbal desc, c_custkey) as rn from customer) where rn <= 3")
def topk_per_group(spark: SparkSession, folder: str) -> DataFrame:
    """Rank limits are pushed below the exchange (window group limit)."""
    ranked = table(spark, folder, "customer").withColumn("rn", F.row_number().over(Window.partitionBy("c_mktsegment").orderBy(F.desc("c_acctbal"), "c_custkey")))
    return ranked.where("rn <= 3").select("c_mktsegment", "c_custkey")


# Set operations

_A, _B = "select c_nationkey as k from customer where c_acctbal > 9000", "select s_nationkey as k from supplier where s_acctbal > 5000"
sql("set_union", f"{_A} union {_B}")
sql("set_union_all", f"{_A} union all {_B}")
sql("set_intersect", f"{_A} intersect {_B}")
sql("set_intersect_all", f"{_A} intersect all {_B}")
sql("set_except", f"{_A} except {_B}")
sql("set_except_all", f"{_A} except all {_B}")

# Scalar functions

sql(
    "fn_string",
    """select p_partkey, upper(p_name) as u, lower(p_brand) as l, trim(concat('  ', p_type, ' ')) as t, lpad(p_brand, 12, '*') as lp, rpad(p_brand, 12, '-') as rp,
       concat_ws('|', p_brand, p_type) as cw, replace(p_name, 'a', 'A') as rep, instr(p_type, 'A') as ins, regexp_replace(p_brand, '[0-9]', '#') as rr,
       reverse(p_brand) as rev, translate(p_brand, 'Band', 'bAND') as tr, substring(p_name, 2, 3) as sub, length(p_type) as len, split_part(p_name, ' ', 1) as sp, contains(p_name, '1') as has, starts_with(p_name, 'p') as st, left(p_name, 2) as le, right(p_name, 2) as ri from part""".replace("starts_with(", "startswith(").replace("regexp_replace(p_brand, '[0-9]', '#')", "regexp_replace(p_brand, '[0-9]', '#')"),
    """select p_partkey, upper(p_name) as u, lower(p_brand) as l, trim(concat('  ', p_type, ' ')) as t, lpad(p_brand, 12, '*') as lp, rpad(p_brand, 12, '-') as rp,
       concat_ws('|', p_brand, p_type) as cw, replace(p_name, 'a', 'A') as rep, cast(instr(p_type, 'A') as int) as ins, regexp_replace(p_brand, '[0-9]', '#', 'g') as rr,
       reverse(p_brand) as rev, translate(p_brand, 'Band', 'bAND') as tr, substring(p_name, 2, 3) as sub, cast(length(p_type) as int) as len, split_part(p_name, ' ', 1) as sp, contains(p_name, '1') as has, starts_with(p_name, 'p') as st, left(p_name, 2) as le, right(p_name, 2) as ri from part""",
)
sql(
    "fn_date",
    "select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m, day(o_orderdate) as d, hour(o_orderdate) as h, quarter(o_orderdate) as q, cast(cast(o_orderdate as date) as string) as dt, datediff(date '2000-01-01', cast(o_orderdate as date)) as diff, date_format(o_orderdate, 'yyyy-MM') as ym, cast(cast(trunc(o_orderdate, 'MM') as date) as string) as first_, cast(last_day(o_orderdate) as string) as last_, cast(add_months(cast(o_orderdate as date), 2) as string) as am from orders",
    "select o_orderkey, cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m, cast(day(o_orderdate) as int) as d, cast(hour(o_orderdate) as int) as h, cast(quarter(o_orderdate) as int) as q, cast(cast(o_orderdate as date) as string) as dt, cast(date_diff('day', cast(o_orderdate as date), date '2000-01-01') as int) as diff, strftime(o_orderdate, '%Y-%m') as ym, cast(cast(date_trunc('month', o_orderdate) as date) as string) as first_, cast(last_day(o_orderdate) as string) as last_, cast(cast(cast(o_orderdate as date) + interval 2 month as date) as string) as am from orders",
)
sql(
    "fn_math",
    "select p_partkey, abs(p_size - 25) as a, round(sqrt(p_retailprice), 6) as sq, round(ln(p_retailprice), 6) as l, round(log10(p_retailprice), 6) as lt, cast(floor(p_retailprice) as bigint) as f, cast(ceil(p_retailprice) as bigint) as c, round(cos(p_size) + sin(p_size), 6) as cs, pmod(p_size - 30, 7) as pm, greatest(p_size, 20) as g, least(p_size, 20) as le, cast(sign(p_size - 25) as int) as s, round(power(p_size, 2), 2) as pw, round(exp(p_size / 50.0), 6) as ex, p_size % 7 as mo from part",
    "select p_partkey, abs(p_size - 25) as a, round(sqrt(p_retailprice), 6) as sq, round(ln(p_retailprice), 6) as l, round(log10(p_retailprice), 6) as lt, cast(floor(p_retailprice) as bigint) as f, cast(ceil(p_retailprice) as bigint) as c, round(cos(p_size) + sin(p_size), 6) as cs, ((p_size - 30) % 7 + 7) % 7 as pm, greatest(p_size, 20) as g, least(p_size, 20) as le, cast(sign(p_size - 25) as int) as s, round(power(p_size, 2), 2) as pw, round(exp(p_size / 50.0), 6) as ex, p_size % 7 as mo from part",
)
sql("fn_conditional", "select c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') as seg, case when c_acctbal < 0 then 'debt' when c_acctbal < 5000 then 'some' else 'rich' end as class, if(c_nationkey > 10, 1, 0) as flag, cast(nullif(c_nationkey, 3) as string) as nn from customer")
sql("fn_cast", "select o_orderkey, cast(o_orderkey as string) as s, cast(cast(o_totalprice as decimal(12, 2)) as string) as d, cast(floor(o_totalprice) as bigint) as b, try_cast(o_orderpriority as int) as bad, cast(cast(o_orderdate as date) as string) as dt from orders")
sql(
    "fn_array",
    "select vec_id, size(embedding) as n, round(cast(element_at(embedding, 1) as double), 5) as e1, round(cast(array_max(embedding) as double), 5) as mx, size(filter(embedding, x -> x > 0)) as pos, round(aggregate(transform(embedding, x -> cast(x as double) * x), 0D, (a, b) -> a + b), 4) as norm, size(slice(embedding, 2, 5)) as sl, array_contains(array(label, 3), 3) as has, array_join(sort_array(array(label, 2, 1)), '-') as so, arrays_overlap(array(label), array(1, 2)) as ov from embeddings",
    "select vec_id, cast(len(embedding) as int) as n, round(cast(embedding[1] as double), 5) as e1, round(cast(list_max(embedding) as double), 5) as mx, cast(len(list_filter(embedding, lambda x: x > 0)) as int) as pos, round(list_sum(list_transform(embedding, lambda x: cast(x as double) * x)), 4) as norm, cast(len(embedding[2:6]) as int) as sl, list_contains([label, 3], 3) as has, array_to_string(list_sort([label, 2, 1]), '-') as so, list_has_any([label], [1, 2]) as ov from embeddings",
)
sql("fn_explode", "select vec_id, pos, round(cast(x as double), 5) + 0.0D as x from embeddings lateral view posexplode(embedding) as pos, x", "select vec_id, cast(i - 1 as int) as pos, round(cast(embedding[i] as double), 5) + 0.0 as x from embeddings cross join (select unnest(range(1, 65)) as i) where i <= len(embedding)")
sql(
    "fn_map",
    "select event_id, map_from_arrays(array('t', 'u'), array(event_type, cast(user_id as string)))['u'] as u, array_join(array_sort(map_keys(map('b', 1, 'a', 2))), ',') as ks, size(map_filter(map('b', 1, 'a', 2), (k, v) -> v > 1)) as n from events",
    "select event_id, map(['t', 'u'], [event_type, cast(user_id as varchar)])['u'] as u, 'a,b' as ks, 1 as n from events",
)
sql("fn_struct", "select event_id, named_struct('a', user_id, 'b', event_type).b as b, struct(value, ts).value as v from events", "select event_id, struct_pack(a := user_id, b := event_type).b as b, struct_pack(value := value, ts := ts).value as v from events")
sql("fn_json", "select event_id, cast(get_json_object(props, '$.k') as int) as k, from_json(props, 'k int').k + 1 as k1 from events", "select event_id, cast(json_extract_string(props, '$.k') as int) as k, cast(json_extract_string(props, '$.k') as int) + 1 as k1 from events")
sql("fn_session", "select r_regionkey, length(current_timezone()) > 0 as zoned, current_date() = cast(now() as date) as today, length(current_user()) > 0 as someone, cast(cast(date '2024-03-01' - interval 1 month as date) as string) as back from region", "select r_regionkey, true as zoned, true as today, true as someone, '2024-02-01' as back from region")
sql("text_search", "select doc_id, lang, n_chars from documents where text like '%tion%' and lang = 'en' and n_chars > 3000")
sql(
    "fn_regex",
    "select p_partkey, regexp_extract(p_brand, '([0-9]+)', 1) as num, p_brand rlike '1.$' as rl, regexp_count(p_name, 'a') as cnt, locate('a', p_name) as loc, nvl(nullif(p_brand, 'Brand#11'), '-') as nv, initcap(p_type) as ic, ascii(p_brand) as asc_, repeat('x', p_size % 4) as rep, substring_index(p_brand, '#', 1) as si from part",
    "select p_partkey, regexp_extract(p_brand, '([0-9]+)', 1) as num, regexp_matches(p_brand, '1.$') as rl, cast(len(regexp_extract_all(p_name, 'a')) as int) as cnt, cast(instr(p_name, 'a') as int) as loc, coalesce(nullif(p_brand, 'Brand#11'), '-') as nv, array_to_string(list_transform(string_split(p_type, ' '), lambda w: upper(left(w, 1)) || lower(substring(w, 2))), ' ') as ic, cast(ascii(p_brand) as int) as asc_, repeat('x', p_size % 4) as rep, split_part(p_brand, '#', 1) as si from part",
)
sql(
    "fn_time",
    "select event_id, cast(date_trunc('hour', ts) as string) as h, cast(to_date(ts) as string) as d, unix_micros(cast(ts as timestamp)) as us, weekday(ts) as wd, dayofyear(ts) as dy, minute(ts) as mi, cast(date_sub(cast(ts as date), 3) as string) as ds, cast(ts + interval 90 minutes as string) as later, cast(months_between(date '2024-06-01', date '2024-01-01') as int) as mb from events",
    "select event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as h, strftime(ts, '%Y-%m-%d') as d, epoch_us(ts) as us, cast(isodow(ts) - 1 as int) as wd, cast(dayofyear(ts) as int) as dy, cast(minute(ts) as int) as mi, strftime(cast(ts as date) - interval 3 day, '%Y-%m-%d') as ds, cast(ts + interval 90 minute as varchar) as later, 5 as mb from events",
)
sql(
    "fn_collections",
    "select event_id, array_join(zip_with(array(1, 2), array(user_id, 3), (a, b) -> a + b), ',') as z, exists(array(user_id), x -> x > 10) as e, forall(array(1, user_id), x -> x < 100) as f, array_join(array_distinct(array(1, 1, 2)), '') as d, array_position(array(5, 7, 9), 7) as p, array_join(array_union(array(1), array(2)), '') as u, cardinality(map_values(map('a', 1, 'b', 2))) as mv, to_json(named_struct('k', user_id)) as j, array_join(flatten(array(array(1), array(2, 3))), '') as fl, array_join(reverse(sequence(1, 3)), '') as sq from events",
    "select event_id, (1 + user_id) || ',5' as z, user_id > 10 as e, user_id < 100 as f, '12' as d, cast(2 as bigint) as p, '12' as u, 2 as mv, '{\"k\":' || user_id || '}' as j, '123' as fl, '321' as sq from events",
)
sql("agg_bool_arg", "select o_orderstatus, bool_and(o_totalprice > 0) as every_, bool_or(o_custkey = 7) as some_, max_by(o_orderkey, struct(o_totalprice, o_orderkey)) as top, min_by(o_orderkey, struct(o_totalprice, o_orderkey)) as low, count_if(o_custkey % 2 = 0) as even from orders group by o_orderstatus", "select o_orderstatus, bool_and(o_totalprice > 0) as every_, bool_or(o_custkey = 7) as some_, max_by(o_orderkey, row(o_totalprice, o_orderkey)) as top, min_by(o_orderkey, row(o_totalprice, o_orderkey)) as low, cast(count_if(o_custkey % 2 = 0) as bigint) as even from orders group by o_orderstatus")
sql("pivot", "select * from (select l_returnflag, l_linestatus, l_quantity from lineitem) pivot (count(l_quantity) for l_linestatus in ('O' as o, 'F' as f))", "select l_returnflag, count(l_quantity) filter (where l_linestatus = 'O') as o, count(l_quantity) filter (where l_linestatus = 'F') as f from lineitem group by l_returnflag")
