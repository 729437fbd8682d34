"""Queries over the engine's own tables: transforms, partitions, changes, statistics, security, views and the SQL API."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestack.engine import Engine, Policies, Policy
from lodestack.functions.transforms import Transform, apply, parse
from lodestack.operators.table import Table, WhenMatched, WhenNotMatched, create_as
from lodestack.plans.predicates import read
from lodestack.plans.queries import query, table
from lodestack.plans.statistics import Estimator, analyze
from lodestack.sources.catalog import Catalog
from lodestack.sources.scratch import scratch


def _engine(spark: SparkSession, user: str = "", policies: Policies | None = None) -> Engine:
    out = Engine(spark, scratch(spark, "catalog"), user, policies)
    out.catalog.create_namespace("lake.main")
    return out


def _key(spark: SparkSession, folder: str, name: str, column: str, transform: str, *others: str) -> DataFrame:
    rows, t = table(spark, folder, name), parse(transform)
    return rows.select(*others, apply(t, F.col(column), rows.schema[column].dataType).alias("k"))


# Transforms


@query("transform_year", "select o_orderkey, cast(year(o_orderdate) - 1970 as int) as k from orders")
def transform_year(spark, folder):
    return _key(spark, folder, "orders", "o_orderdate", "year(o_orderdate)", "o_orderkey")


@query("transform_month", "select o_orderkey, cast((year(o_orderdate) - 1970) * 12 + month(o_orderdate) - 1 as int) as k from orders")
def transform_month(spark, folder):
    return _key(spark, folder, "orders", "o_orderdate", "months(o_orderdate)", "o_orderkey")


@query("transform_day", "select event_id, cast(floor(epoch_us(ts) / 86400000000) as int) as k from events")
def transform_day(spark, folder):
    return _key(spark, folder, "events", "ts", "day(ts)", "event_id")


@query("transform_hour", "select event_id, cast(floor(epoch_us(ts) / 3600000000) as int) as k from events")
def transform_hour(spark, folder):
    return _key(spark, folder, "events", "ts", "hour(ts)", "event_id")


@query("transform_truncate_int", "select c_custkey, c_custkey - 700 - (((c_custkey - 700) % 9) + 9) % 9 as k from customer")
def transform_truncate_int(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", (F.col("c_custkey") - 700).alias("v"))
    return rows.select("c_custkey", apply(Transform("v", "truncate", 9), F.col("v"), T.LongType()).alias("k"))


@query("transform_truncate_string", "select p_partkey, substring(p_type, 1, 4) as k from part")
def transform_truncate_string(spark, folder):
    return _key(spark, folder, "part", "p_type", "truncate(4, p_type)", "p_partkey")


@query("transform_truncate_decimal", "select c_custkey, cast(cast(v - ((v % 50) + 50) % 50 as decimal(18, 2)) / 100 as double) as k from (select c_custkey, cast(round(c_acctbal * 100) as bigint) as v from customer)")
def transform_truncate_decimal(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", (F.round(F.col("c_acctbal") * 100).cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("v"))
    return rows.select("c_custkey", apply(Transform("v", "truncate", 50), F.col("v"), T.DecimalType(18, 2)).cast("double").alias("k"))


def _murmur_sql(source: str, key: str, value: str, buckets: int) -> str:
    """The bucket of a non-negative whole number, step by step in SQL."""
    mask = 4294967295

    def times(a: str, c: int) -> str:
        return f"((({a} & 65535) * {c} + ((({a} >> 16) * {c}) & 65535) * 65536) & {mask})"

    def turn(a: str, n: int) -> str:
        return f"((({a} & {(1 << 32 - n) - 1}) * {1 << n}) + ({a} >> {32 - n}))"

    steps = [f"select {key}, {value} & {mask} as lo, {value} >> 32 as hi, cast(0 as bigint) as h from {source}"]
    for word in ("lo", "hi"):
        steps += [f"select *, {times(word, 0xCC9E2D51)} as k1 from ({{}})", f"select *, {turn('k1', 15)} as k2 from ({{}})", f"select *, {times('k2', 0x1B873593)} as k3 from ({{}})", "select *, xor(h, k3) as x from ({})", f"select {key}, lo, hi, ({turn('x', 13)} * 5 + 3864292196) & {mask} as h from ({{}})"]
    steps += ["select *, xor(h, 8) as a from ({})", "select *, xor(a, a >> 16) as b from ({})", f"select *, {times('b', 0x85EBCA6B)} as c from ({{}})", "select *, xor(c, c >> 13) as d from ({})", f"select *, {times('d', 0xC2B2AE35)} as e from ({{}})", "select *, xor(e, e >> 16) as f from ({})", f"select {key}, cast((f & 2147483647) % {buckets} as int) as k from ({{}})"]
    out = steps[0]
    for s in steps[1:]:
        out = s.format(out)
    return out


@query("transform_bucket", _murmur_sql("orders", "o_orderkey", "o_custkey", 16))
def transform_bucket(spark, folder):
    return _key(spark, folder, "orders", "o_custkey", "bucket(16, o_custkey)", "o_orderkey")


# Partitioned tables


def _orders(spark: SparkSession, folder: str) -> Table:
    e = _engine(spark)
    return create_as(e.catalog, "lake.main.orders", table(spark, folder, "orders"), ["year(o_orderdate)", "bucket(4, o_custkey)"], ["o_orderkey"])


@query("partitions_table", f"select cast(year(o_orderdate) - 1970 as int) as o_orderdate_year, b.k as o_custkey_bucket, count(*) as est_row_count from orders o join ({_murmur_sql('orders', 'o_orderkey', 'o_custkey', 4)}) b on o.o_orderkey = b.o_orderkey group by all")
def partitions_table(spark, folder):
    return _orders(spark, folder).partitions().select("o_orderdate_year", "o_custkey_bucket", "est_row_count")


@query("partition_prune_year", "select o_orderkey, o_totalprice from orders where o_orderdate >= timestamp '1997-03-01' and o_orderdate < timestamp '1998-02-01'")
def partition_prune_year(spark, folder):
    return _orders(spark, folder).scan("o_orderdate >= timestamp '1997-03-01' and o_orderdate < timestamp '1998-02-01'", ["o_orderkey", "o_totalprice"])


@query("partition_prune_bucket", "select o_orderkey from orders where o_custkey in (7, 11, 500)")
def partition_prune_bucket(spark, folder):
    return _orders(spark, folder).scan("o_custkey in (7, 11, 500)", ["o_orderkey"])


@query("scan_only_ordered", "select o_orderkey, o_custkey from orders where o_orderkey between 100 and 5000 and o_totalprice > 200000 and o_orderstatus in ('F', 'O')")
def scan_only_ordered(spark, folder):
    """Only conditions on the sort key reach the reader."""
    return _orders(spark, folder).scan("o_orderkey between 100 and 5000 and o_totalprice > 200000 and o_orderstatus in ('F', 'O')", only_ordered=True).select("o_orderkey", "o_custkey")


@query("drop_partitions", "select o_orderkey from orders where year(o_orderdate) <> 1996")
def drop_partitions(spark, folder):
    t = _orders(spark, folder)
    t.drop_partitions("o_orderdate_year = 26", allow_non_acid=True)
    return t.scan(columns=["o_orderkey"])


@query("partition_identity_nulls", "select nullif(c_mktsegment, 'BUILDING') as c_seg, count(*) as est_row_count from customer group by 1")
def partition_identity_nulls(spark, folder):
    e = _engine(spark)
    rows = table(spark, folder, "customer").select("c_custkey", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("c_seg"))
    return create_as(e.catalog, "lake.main.c", rows, ["c_seg"]).partitions().select("c_seg", "est_row_count")


# Changes


@query("dml_insert_missing_cols", "select s_suppkey, s_name, s_acctbal from supplier union all select s_suppkey + 1000000, null, null from supplier where s_acctbal > 8000")
def dml_insert_missing_cols(spark, folder):
    e, s = _engine(spark), table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    t = create_as(e.catalog, "lake.main.supplier", s)
    t.append(s.where("s_acctbal > 8000").select((F.col("s_suppkey") + 1000000).alias("s_suppkey")))
    return t.scan()


@query("dml_delete", "select o_orderkey from orders where not (o_orderstatus = 'F' and o_totalprice > 100000)")
def dml_delete(spark, folder):
    t = _orders(spark, folder)
    t.delete("o_orderstatus = 'F' and o_totalprice > 100000")
    return t.scan(columns=["o_orderkey"])


@query("dml_update", "select o_orderkey, case when o_orderpriority = '5-LOW' and o_custkey < 200 then 'X' else o_orderstatus end as o_orderstatus, round(case when o_orderpriority = '5-LOW' and o_custkey < 200 then o_totalprice * 2 else o_totalprice end, 2) as o_totalprice from orders")
def dml_update(spark, folder):
    t = _orders(spark, folder)
    t.update({"o_orderstatus": "'X'", "o_totalprice": "o_totalprice * 2"}, "o_orderpriority = '5-LOW' and o_custkey < 200")
    return t.scan().select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"))


@query(
    "dml_merge",
    """select o_orderkey, round(case when o_totalprice > 400000 then o_totalprice + 1 else o_totalprice end, 2) as o_totalprice from orders where not (o_totalprice > 400000 and o_orderstatus = 'F')
       union all select o_orderkey + 100000000, round(o_totalprice, 2) from orders where o_totalprice > 400000""",
)
def dml_merge(spark, folder):
    t = _orders(spark, folder)
    some = table(spark, folder, "orders").where("o_totalprice > 400000")
    source = some.unionByName(some.withColumn("o_orderkey", F.col("o_orderkey") + 100000000))
    t.merge(source, "t.o_orderkey = s.o_orderkey", [WhenMatched("delete", condition="t.o_orderstatus = 'F'"), WhenMatched("update", {"o_totalprice": "s.o_totalprice + 1"})], [WhenNotMatched()])
    return t.scan().select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))


@query("import_files", "select r_regionkey, r_name, 'a' as batch from region union all select r_regionkey, r_name, 'b' from region")
def import_files(spark, folder):
    e = _engine(spark)
    e.catalog.create_table("lake.main.r", T.StructType([*table(spark, folder, "region").schema.fields, T.StructField("batch", T.StringType())]), ["batch"])
    rows = spark.createDataFrame([("a", f"{folder}/region.parquet"), ("b", f"{folder}/region.parquet")], "batch string, `$parquet_file_path` string")
    e.insert("lake.main.`r import_data(batch)`", rows)
    return Table(e.catalog, "lake.main.r").scan()


@query("ctas", "select o_custkey, count(*) as n from orders group by o_custkey")
def ctas(spark, folder):
    e = _engine(spark)
    return create_as(e.catalog, "lake.main.counts", table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")), [], ["o_custkey"]).scan()


@query("transactions", "select c_custkey from customer where c_mktsegment in ('BUILDING', 'MACHINERY')")
def transactions(spark, folder):
    """A rollback leaves nothing; a commit changes two tables at once."""
    e, c = _engine(spark), table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    t, log = create_as(e.catalog, "lake.main.c", c.where("c_mktsegment = 'BUILDING'")), create_as(e.catalog, "lake.main.log", c.limit(0))
    e.begin()
    t.append(c.where("c_mktsegment = 'HOUSEHOLD'"))
    e.rollback()
    e.begin()
    t.append(c.where("c_mktsegment = 'MACHINERY'"))
    log.append(c.limit(1))
    e.commit()
    assert log.scan().count() == 1
    return t.scan(columns=["c_custkey"])


@query("schema_evolution", "select n_nationkey, n_name as name, cast(null as varchar) as note from nation where n_regionkey < 3 union all select n_nationkey, n_name, 'new' from nation where n_regionkey >= 3")
def schema_evolution(spark, folder):
    e, n = _engine(spark), table(spark, folder, "nation")
    t = create_as(e.catalog, "lake.main.n", n.where("n_regionkey < 3"))
    e.catalog.add_column("lake.main.n", "note", T.StringType())
    e.catalog.drop_column("lake.main.n", "n_regionkey")
    e.catalog.rename_column("lake.main.n", "n_name", "name")
    t.append(n.where("n_regionkey >= 3").select("n_nationkey", F.col("n_name").alias("name"), F.lit("new").alias("note")))
    return t.scan()


@query("row_get", "select n_name from nation where n_name = 'nation_7' or n_nationkey = 7 limit 1")
def row_get(spark, folder):
    e = _engine(spark)
    t = create_as(e.catalog, "lake.main.n", table(spark, folder, "nation"))
    found = t.scan("n_nationkey = 7", hidden=True).first()["_row_id"]
    return e.get("lake.main.n", found, ["n_name"])


@query("delete_by_ids", "select n_nationkey from nation where n_nationkey not in (3, 4)")
def delete_by_ids(spark, folder):
    e = _engine(spark)
    t = create_as(e.catalog, "lake.main.n", table(spark, folder, "nation"))
    t.delete_by_ids([r["_row_id"] for r in t.scan("n_nationkey in (3, 4)", hidden=True).collect()])
    return t.scan(columns=["n_nationkey"])


@query("colocated_bucket_join", "select o.o_custkey, count(*) as n from orders o join customer c on o.o_custkey = c.c_custkey group by o.o_custkey")
def colocated_bucket_join(spark, folder):
    from lodestack.sources.bucketed import bucketed_pair

    o, c = bucketed_pair(table(spark, folder, "orders").select("o_custkey", "o_orderkey"), "o_custkey", table(spark, folder, "customer").select("c_custkey"), "c_custkey", buckets=8)
    return o.join(c, o.o_custkey == c.c_custkey).groupBy("o_custkey").agg(F.count("*").alias("n"))


# Statistics


@query(
    "stats_columns",
    """select column_name, cast(nulls as bigint) as nulls, cast(low as double) as low, cast(high as double) as high from (select 'l_quantity' as column_name, count(*) - count(l_quantity) as nulls, min(l_quantity) + 0.0 as low, max(l_quantity) as high from lineitem
       union all select 'l_linenumber', count(*) - count(l_linenumber), min(l_linenumber), max(l_linenumber) from lineitem
       union all select 'l_partkey', sum(case when l_partkey % 10 = 0 then 1 else 0 end), min(case when l_partkey % 10 <> 0 then l_partkey end), max(case when l_partkey % 10 <> 0 then l_partkey end) from lineitem) t""",
)
def stats_columns(spark, folder):
    rows = table(spark, folder, "lineitem").withColumn("l_partkey", F.expr("if(l_partkey % 10 = 0, null, l_partkey)"))
    found = analyze(rows, ["l_quantity", "l_linenumber", "l_partkey"])
    return spark.createDataFrame([(c, s.nulls, float(s.low) + 0.0, float(s.high)) for c, s in found.columns.items()], "column_name string, nulls long, low double, high double")


_TESTS = {"range": "l_quantity > 10 and l_quantity <= 30", "equal": "l_quantity = 7", "both": "l_quantity < 20 and l_orderkey > 5000", "either": "l_quantity < 5 or l_quantity > 45", "null": "l_quantity is null", "none": "l_quantity > 1000"}


@query("selectivity_estimate", " union all ".join(f"select '{k}' as what, count(*) filter (where {c}) as rows, true as near from lineitem" for k, c in _TESTS.items()))
def selectivity_estimate(spark, folder):
    """Rows that meet each condition, and whether the estimate's share is within five hundredths of theirs."""
    rows = table(spark, folder, "lineitem")
    estimator = Estimator(analyze(rows, ["l_quantity", "l_linenumber", "l_orderkey"]))
    counted = rows.agg(*(F.count_if(F.expr(c)).alias(k) for k, c in _TESTS.items()), F.count("*").alias("all_rows")).unpivot(["all_rows"], list(_TESTS), "what", "rows")
    estimates = spark.createDataFrame([(k, float(estimator.selectivity(read(c)))) for k, c in _TESTS.items()], "what string, share double")
    return counted.join(estimates, "what").select("what", "rows", (F.abs(F.col("share") - F.col("rows") / F.col("all_rows")) < 0.05).alias("near"))


# Security, views and the SQL API


@query("security_filter_mask", "select c_custkey, regexp_replace(c_name, '[0-9]', '*', 'g') as c_name, c_mktsegment from customer where c_nationkey < 10 and length(c_name) > 3 and c_acctbal > 0")
def security_filter_mask(spark, folder):
    policies = Policies()
    policies.set("lake/main/customer", "ann", Policy(("c_nationkey < 10", "length(c_name) > 3", "c_acctbal > 0"), frozenset(), frozenset({"c_acctbal", "c_nationkey"}), {"c_name": "regexp_replace(c_name, '[0-9]', '*')"}))
    e = _engine(spark, "ann", policies)
    create_as(e.catalog, "lake.main.customer", table(spark, folder, "customer"))
    return e.sql("select c_custkey, c_name, c_mktsegment from lake.main.customer")


@query("security_delete", "select c_custkey from customer where not (c_nationkey < 10 and c_acctbal < 0)")
def security_delete(spark, folder):
    """Rows that a filter hides can't be deleted."""
    policies = Policies()
    policies.set("lake/main/customer", "bob", Policy(("c_nationkey < 10",)))
    e = _engine(spark, "bob", policies)
    create_as(e.catalog, "lake.main.customer", table(spark, folder, "customer"))
    e.delete("lake.main.customer", "c_acctbal < 0")
    return e.as_user("root").table("lake.main.customer", columns=["c_custkey"])


@query("view_alias", "select n_name as nation_name, count(*) as customers from nation join customer on n_nationkey = c_nationkey group by n_name")
def view_alias(spark, folder):
    e = _engine(spark)
    create_as(e.catalog, "lake.main.nation", table(spark, folder, "nation"))
    create_as(e.catalog, "lake.main.customer", table(spark, folder, "customer"))
    e.create_view("lake.main.v", "select n.n_name, count(*) from lake.main.nation n join lake.main.customer c on n.n_nationkey = c.c_nationkey group by n.n_name", ["nation_name", "customers"], {"customers": "how many"})
    return e.sql("select * from lake.main.v")


@query("execute_json", "select '{\"r_regionkey\":' || r_regionkey || ',\"name\":' || case when r_regionkey = 1 then 'null' else '\"' || r_name || '\"' end || '}' as records from region where r_name <> ''")
def execute_json(spark, folder):
    e = _engine(spark)
    create_as(e.catalog, "lake.main.region", table(spark, folder, "region"))
    return e.execute("select r_regionkey, if(r_regionkey = 1, null, r_name) as name from lake.main.region where 'g1' in (<groups>)", ["g1", "g2"], enforce_identity=True)


@query("select_restricted", "select p_partkey, p_brand from part where (p_size = 3 or p_size in (7, 9)) and p_brand not in ('Brand#11', 'Brand#12') and p_name is not null order by p_partkey desc limit 20")
def select_restricted(spark, folder):
    e = _engine(spark)
    create_as(e.catalog, "lake.main.part", table(spark, folder, "part"))
    return e.select("select p_partkey, p_brand from lake.main.part where (p_size = 3 or p_size in (7, 9)) and p_brand not in ('Brand#11', 'Brand#12') and p_name is not null order by p_partkey desc limit 20")


@query("system_release", "select '1' as version, '' as hash")
def system_release(spark, folder):
    return _engine(spark).release()


def catalog(spark: SparkSession, root: str) -> Catalog:
    return Catalog(spark, root)


@query("sql_statements", "select c_custkey, case when c_acctbal > 9000 then 'rich' when c_mktsegment = 'BUILDING' then 'B' else c_mktsegment end as segment from customer where c_nationkey <> 3 union all select 1000000000, 'new'")
def sql_statements(spark, folder):
    """A table's life in SQL: created from a query, changed, merged into and read through a view."""
    e = _engine(spark)
    run = e.run
    create_as(e.catalog, "lake.main.source", table(spark, folder, "customer"))
    run("CREATE TABLE lake.main.c PARTITIONED BY (bucket(4, c_custkey)) AS SELECT c_custkey, c_nationkey, c_mktsegment AS segment FROM lake.main.source")
    run("DELETE FROM lake.main.c WHERE c_nationkey = 3")
    run("UPDATE lake.main.c SET segment = 'B' WHERE segment = 'BUILDING'")
    run("MERGE INTO lake.main.c AS t USING (SELECT c_custkey AS k FROM lake.main.source WHERE c_acctbal > 9000 UNION ALL SELECT 1000000000) AS s ON t.c_custkey = s.k WHEN MATCHED THEN UPDATE SET segment = 'rich' WHEN NOT MATCHED AND s.k >= 1000000000 THEN INSERT (c_custkey, segment) VALUES (s.k, 'new')")
    run("CREATE VIEW lake.main.v AS SELECT c_custkey, segment FROM lake.main.c")
    return run("SELECT * FROM lake.main.v")


@query("scan_by_option", "select s_suppkey, s_name from supplier where s_nationkey in (3, 4, 5)")
def scan_by_option(spark, folder):
    from lodestack.sources import datasource

    e = _engine(spark)
    create_as(e.catalog, "lake.main.s", table(spark, folder, "supplier"), ["s_nationkey"])
    datasource.register(spark)
    root = e.catalog.root
    return spark.read.format("lodestack").option("root", root).option("table", "lake.main.s").load().where("s_nationkey in (3, 4, 5)").select("s_suppkey", "s_name")


@query("fn_transforms_sql", "select o_orderkey, cast(year(o_orderdate) - 1970 as int) as y, o_custkey - o_custkey % 10 as t, b.k as b from orders o join (" + _murmur_sql("orders", "o_orderkey as ok", "o_custkey", 8).replace("select o_orderkey as ok, lo", "select ok, lo").replace("select o_orderkey as ok, cast", "select ok, cast") + ") b on b.ok = o.o_orderkey")
def fn_transforms_sql(spark, folder):
    from lodestack.functions.sql import register

    register(spark)
    return table(spark, folder, "orders").selectExpr("o_orderkey", "ls_years(o_orderdate) as y", "ls_truncate(10, o_custkey) as t", "ls_bucket(8, o_custkey) as b")


@query("information_schema", "select * from (values ('nation', 'n_name', 1, 'string'), ('nation', 'n_nationkey', 0, 'int'), ('region', 'r_name', 1, 'string'), ('region', 'r_regionkey', 0, 'int')) t(table_name, column_name, place, data_type)")
def information_schema(spark, folder):
    """Columns as a user sees them: one column of a table is hidden, and a whole table is."""
    policies = Policies()
    policies.set("lake/main/nation", "ann", Policy(denied=frozenset({"n_regionkey"})))
    policies.set("lake/main/secret", "ann", Policy(denied=frozenset({"r_regionkey", "r_name"})))
    e = _engine(spark, "ann", policies)
    for name, source in (("nation", "nation"), ("secret", "region"), ("region", "region")):
        create_as(e.catalog, f"lake.main.{name}", table(spark, folder, source))
    return e.sql("select c.table_name, c.column_name, c.ordinal_position - 1 as place, c.data_type from information_schema.columns c join information_schema.tables t on c.table_name = t.table_name where c.table_schema = 'lake.main'")


# Names in SQL


def _named(spark: SparkSession, folder: str) -> Engine:
    e = _engine(spark)
    for name in ("nation", "region", "orders"):
        create_as(e.catalog, f"lake.main.{name}", table(spark, folder, name))
    return e


@query("sql_literal_from", "select n_name, 'taken from lake.main.region, join lake.main.x' as said from nation where n_name <> 'from lake.main.nation x' -- from lake.main.y")
def sql_literal_from(spark, folder):
    return _named(spark, folder).sql("select n_name, 'taken from lake.main.region, join lake.main.x' as said from lake.main.nation where n_name <> 'from lake.main.nation x' -- from lake.main.y")


@query("sql_comma_join", "select n.n_name, r.r_name from nation n, region r where n.n_regionkey = r.r_regionkey")
def sql_comma_join(spark, folder):
    return _named(spark, folder).sql("select n.n_name, r.r_name from lake.main.nation n, lake.main.region r where n.n_regionkey = r.r_regionkey")


@query("sql_qualified_columns", "select nation.n_name, region.r_name from nation join region on nation.n_regionkey = region.r_regionkey where region.r_regionkey > 0")
def sql_qualified_columns(spark, folder):
    return _named(spark, folder).sql("select lake.main.nation.n_name, main.region.r_name from lake.main.nation join lake.main.region on lake.main.nation.n_regionkey = region.r_regionkey where lake.main.region.r_regionkey > 0")


@query("sql_functions_with_from", "select o_orderkey, cast(year(o_orderdate) as int) as y from orders where o_orderkey in (select o_orderkey from orders where o_totalprice > 300000) and o_orderstatus = 'F'")
def sql_functions_with_from(spark, folder):
    text = "with lake as (select o_orderkey from lake.main.orders where o_totalprice > 300000) select o_orderkey, extract(year from lake.main.orders.o_orderdate) as y from lake.main.orders where o_orderkey in (select o_orderkey from lake) and trim(both ' ' from o_orderstatus) = 'F'"
    return _named(spark, folder).sql(text)


# Statements, one by one: each answers with what it left behind


def _said(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    return spark.createDataFrame(rows, columns)


def _refuses(run, text: str) -> bool:
    from lodestack.sources.catalog import CatalogError

    try:
        run(text)
    except (CatalogError, PermissionError):
        return True
    return False


@query("ddl_schema", "select * from (values ('lake.main'), ('lake.new')) t(namespace)")
def ddl_schema(spark, folder):
    """Schemas are made, renamed and dropped; SHOW lists them."""
    run = _engine(spark).run
    run("CREATE SCHEMA lake.other")
    run("CREATE SCHEMA IF NOT EXISTS lake.other")
    run("CREATE SCHEMA lake.gone")
    run("DROP SCHEMA lake.gone")
    run("DROP SCHEMA IF EXISTS lake.gone")
    run("ALTER SCHEMA lake.other RENAME TO lake.new")
    return run("SHOW SCHEMAS")


@query("ddl_describe", "select * from (values ('k', 'bigint', 'the key'), ('d', 'date', null), ('v', 'decimal(12,2)', null)) t(col_name, data_type, comment)")
def ddl_describe(spark, folder):
    run = _engine(spark).run
    run("CREATE TABLE lake.main.made (k BIGINT COMMENT 'the key', d DATE, v DECIMAL(12, 2)) PARTITIONED BY (year(d))")
    return run("DESCRIBE lake.main.made")


@query("ddl_if_not_exists", "select n_nationkey, true as refused from nation")
def ddl_if_not_exists(spark, folder):
    """IF NOT EXISTS leaves a table as it is; without it, and for OR REPLACE, there is an error."""
    e = _named(spark, folder)
    e.run("CREATE TABLE IF NOT EXISTS lake.main.nation AS SELECT 1 AS x")
    refused = _refuses(e.run, "CREATE TABLE lake.main.nation (x INT)") and _refuses(e.run, "CREATE OR REPLACE TABLE lake.main.nation AS SELECT 1 AS x")
    return e.sql("select n_nationkey from lake.main.nation").withColumn("refused", F.lit(refused))


@query("ddl_drop_rename_table", "select * from (values ('lake.main', 'land', false), ('lake.main', 'orders', false)) t(namespace, tableName, isTemporary)")
def ddl_drop_rename_table(spark, folder):
    run = _named(spark, folder).run
    run("DROP TABLE lake.main.region")
    run("DROP TABLE IF EXISTS lake.main.region")
    run("ALTER TABLE lake.main.nation RENAME TO lake.main.land")
    return run("SHOW TABLES IN lake.main")


@query("ddl_properties", "select * from (values ('owner', 'ops'), ('tier', 'cold')) t(k, v)")
def ddl_properties(spark, folder):
    e = _named(spark, folder)
    e.run("ALTER TABLE lake.main.nation SET TBLPROPERTIES ('tier'='cold', 'owner'='ops')")
    found = e.catalog.manifest("lake.main.nation")[2].properties
    return _said(spark, [(k, found[k]) for k in ("owner", "tier")], "k string, v string")


@query("ddl_show_stats", "select 'n_nationkey' as column_name, count(distinct n_nationkey) as distinct_values, cast(min(n_nationkey) as varchar) as low_value, cast(max(n_nationkey) as varchar) as high_value, count(*) - count(n_nationkey) as nulls, cast(null as bigint) as row_count from nation union all select null, null, null, null, null, count(*) from nation")
def ddl_show_stats(spark, folder):
    run = _named(spark, folder).run
    run("ANALYZE TABLE lake.main.nation COMPUTE STATISTICS FOR COLUMNS n_nationkey")
    return run("SHOW STATS FOR lake.main.nation")


@query("ddl_columns", "select n_nationkey as id, n_name, cast(null as varchar) as note from nation")
def ddl_columns(spark, folder):
    run = _named(spark, folder).run
    run("ALTER TABLE lake.main.nation ADD COLUMN note STRING")
    run("ALTER TABLE lake.main.nation DROP COLUMN n_regionkey")
    run("ALTER TABLE lake.main.nation RENAME COLUMN n_nationkey TO id")
    return run("SELECT * FROM lake.main.nation")


@query("view_alter_rename", "select n_name as name, n_nationkey + 1 as k from nation where n_regionkey = 1")
def view_alter_rename(spark, folder):
    run = _named(spark, folder).run
    run("CREATE VIEW lake.main.v (name COMMENT 'of a nation', k) AS SELECT n_name, n_nationkey FROM lake.main.nation")
    run("ALTER VIEW lake.main.v AS SELECT n_name AS name, n_nationkey + 1 AS k FROM lake.main.nation WHERE n_regionkey = 1")
    run("ALTER VIEW lake.main.v RENAME TO lake.main.w")
    return run("SELECT * FROM lake.main.w")


@query("view_drop_show", "select * from (values ('lake/main', 'kept', false)) t(namespace, \"viewName\", \"isTemporary\")")
def view_drop_show(spark, folder):
    run = _named(spark, folder).run
    run("CREATE VIEW lake.main.kept AS SELECT 1 AS x")
    run("CREATE OR REPLACE VIEW lake.main.kept AS SELECT 2 AS y")
    run("CREATE VIEW lake.main.lost AS SELECT 1 AS x")
    run("DROP VIEW lake.main.lost")
    return run("SHOW VIEWS IN lake.main")


@query("view_delete_refused", "select n_nationkey, true as refused from nation")
def view_delete_refused(spark, folder):
    e = _named(spark, folder)
    e.run("CREATE VIEW lake.main.v AS SELECT n_nationkey FROM lake.main.nation")
    refused = _refuses(e.run, "DELETE FROM lake.main.v WHERE n_nationkey = 1")
    return e.sql("select * from lake.main.v").withColumn("refused", F.lit(refused))


@query("dml_put", "select n_nationkey, n_name from nation union all select 100, 'NEW'")
def dml_put(spark, folder):
    e = _named(spark, folder)
    assert e.put("lake.main.nation", spark.sql("select 100 as n_nationkey, 'NEW' as n_name, 1 as n_regionkey")).count() == 1
    return e.table("lake.main.nation", columns=["n_nationkey", "n_name"])


@query("dml_non_updatable", "select o_orderkey, true as refused from orders where o_custkey = 7")
def dml_non_updatable(spark, folder):
    """Partition and sort columns can't be updated, nor row ids."""
    e = _engine(spark)
    t = create_as(e.catalog, "lake.main.orders", table(spark, folder, "orders"), ["bucket(4, o_custkey)"], ["o_orderkey"])
    refused = all(_refuses(e.run, f"UPDATE lake.main.orders SET {c} = 1") for c in ("o_custkey", "o_orderkey", "_row_id"))
    return t.scan("o_custkey = 7", ["o_orderkey"]).withColumn("refused", F.lit(refused))


@query("partition_list", "select cast(year(o_orderdate) - 1970 as int) as o_orderdate_year, count(*) as est_row_count from orders where year(o_orderdate) = 1997 group by 1")
def partition_list(spark, folder):
    e = _engine(spark)
    t = create_as(e.catalog, "lake.main.orders", table(spark, folder, "orders"), ["year(o_orderdate)"])
    return t.list_partitions({"o_orderdate_year": 27}).select("o_orderdate_year", "est_row_count")


@query("partition_truncate_prune", "select c_custkey from customer where c_name >= 'Customer#000000100' and c_name < 'Customer#000000120'")
def partition_truncate_prune(spark, folder):
    e = _engine(spark)
    t = create_as(e.catalog, "lake.main.c", table(spark, folder, "customer"), ["truncate(16, c_name)"])
    return t.scan("c_name >= 'Customer#000000100' and c_name < 'Customer#000000120'", ["c_custkey"])


@query("partition_strict_bound", "select count(*) as n, 1 as files from orders where o_orderdate < timestamp '1997-01-01' and o_orderdate >= timestamp '1996-01-01'")
def partition_strict_bound(spark, folder):
    """The year that a strict bound begins with is not opened."""
    e = _engine(spark)
    t = create_as(e.catalog, "lake.main.orders", table(spark, folder, "orders"), ["year(o_orderdate)"])
    where = "o_orderdate < timestamp '1997-01-01' and o_orderdate >= timestamp '1996-01-01'"
    _, _, manifest = e.catalog.manifest("lake.main.orders")
    years = len({tuple(f.keys) for f in t._kept_files(manifest, read(where))})
    return t.scan(where).agg(F.count("*").alias("n")).withColumn("files", F.lit(years))


@query("partition_dynamic_filter", "select o.o_orderkey, c.c_custkey from orders o join customer c on o.o_custkey = c.c_custkey where c.c_acctbal > 9950")
def partition_dynamic_filter(spark, folder):
    """The keys of a join's small side choose the files of the other, by its partition transform."""
    from lodestack.operators.joins import table_join

    some = table(spark, folder, "customer").where("c_acctbal > 9950").select("c_custkey")
    return table_join(_orders(spark, folder), some, "o_custkey", "c_custkey", ["o_orderkey", "o_custkey"]).select("o_orderkey", "c_custkey")


@query("nested_pushdown", "select event_id, user_id as uid, event_type as kind from events where value > 9 and event_type = 'click'")
def nested_pushdown(spark, folder):
    """Fields of a stored struct: only those that are asked for are read, and conditions on them reach the reader."""
    e = _engine(spark)
    packed = table(spark, folder, "events").select("event_id", F.struct("user_id", F.struct("event_type", "value", "props").alias("b")).alias("a"))
    create_as(e.catalog, "lake.main.packed", packed)
    return e.sql("select event_id, a.user_id as uid, a.b.event_type as kind from lake.main.packed where a.b.value > 9 and a.b.event_type = 'click'")


@query("write_by_option", "select s_suppkey, s_name, s_nationkey from supplier union all select s_suppkey + 100000, null, s_nationkey from supplier where s_nationkey < 5")
def write_by_option(spark, folder):
    from lodestack.sources import datasource

    e, s = _engine(spark), table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    create_as(e.catalog, "lake.main.s", s, ["s_nationkey"])
    datasource.register(spark)
    root = e.catalog.root
    more = s.where("s_nationkey < 5").select((F.col("s_suppkey") + 100000).alias("s_suppkey"), "s_nationkey")
    if "://" in root and not root.startswith("file:"):
        datasource.append(more, root, "lake.main.s")
    else:
        more.write.format("lodestack").option("root", root).option("table", "lake.main.s").mode("append").save()
    return e.table("lake.main.s")


@query("execute_json_nested", "select '{\"k\":' || n_nationkey || ',\"b\":\"' || to_base64(encode(n_name)) || '\",\"s\":{\"r\":' || n_regionkey || '},\"m\":[{\"key\":\"' || n_name || '\",\"value\":1}]}' as records from nation")
def execute_json_nested(spark, folder):
    return _named(spark, folder).execute("select n_nationkey as k, cast(n_name as binary) as b, named_struct('r', n_regionkey) as s, map(n_name, 1) as m from lake.main.nation")


# More of security


def _guarded(spark: SparkSession, folder: str, policy: Policy, name: str = "nation", partitioning: tuple = ()) -> Engine:
    policies = Policies()
    policies.set(f"lake/main/{name}", "ann", policy)
    e = _engine(spark, "ann", policies)
    create_as(e.catalog, f"lake.main.{name}", table(spark, folder, name), partitioning)
    return e


def _all(e: Engine, columns: str, refused: bool, name: str = "nation") -> DataFrame:
    return e.as_user("root").sql(f"select {columns} from lake.main.{name}").withColumn("refused", F.lit(refused))


@query("security_drop_partition", "select n_nationkey, true as refused from nation")
def security_drop_partition(spark, folder):
    """Partitions may hold rows that a filter hides, so its user can't drop them, either way."""
    e = _guarded(spark, folder, Policy(("n_nationkey < 5",)), partitioning=("n_regionkey",))
    refused = _refuses(e.run, "ALTER TABLE lake.main.`nation allow_non_acid` DROP PARTITION (n_regionkey = 4)")
    try:
        e.delete("lake.main.`nation$partitions allow_non_acid`", "n_regionkey = 4")
        refused = False
    except PermissionError:
        pass
    return _all(e, "n_nationkey", refused)


@query("security_select_denied", "select n_nationkey, true as refused from nation")
def security_select_denied(spark, folder):
    e = _guarded(spark, folder, Policy(denied=frozenset({"n_name"})))
    try:
        e.table("lake.main.nation", columns=["n_name"])
        refused = False
    except PermissionError:
        refused = True
    return _all(e, "n_nationkey", refused)


@query("security_allowed_columns", "select n_nationkey, n_regionkey from nation")
def security_allowed_columns(spark, folder):
    return _guarded(spark, folder, Policy(allowed=frozenset({"n_nationkey", "n_regionkey"}))).sql("select * from lake.main.nation")


@query("security_partitions_denied", "select n_nationkey, true as refused from nation")
def security_partitions_denied(spark, folder):
    e = _guarded(spark, folder, Policy(("n_nationkey < 5",)), partitioning=("n_regionkey",))
    return _all(e, "n_nationkey", _refuses(e.sql, "select * from lake.main.nation$partitions"))


@query("security_update_denied", "select n_nationkey, n_name, true as refused from nation")
def security_update_denied(spark, folder):
    e = _guarded(spark, folder, Policy(masks={"n_name": "'x'"}))
    refused = _refuses(e.run, "UPDATE lake.main.nation SET n_regionkey = 0") and _refuses(e.run, "DELETE FROM lake.main.nation WHERE n_nationkey = 0")
    return _all(e, "n_nationkey, n_name", refused)


@query("security_view_policy", "select n_name, '***' as region from nation where n_regionkey = 2")
def security_view_policy(spark, folder):
    """A policy on a view holds for its reader; the view itself reads with its owner's rights."""
    policies = Policies()
    policies.set("lake/main/v", "bob", Policy(("n_regionkey_of = 2",), masks={"region": "'***'"}, denied=frozenset({"n_regionkey_of"})))
    policies.set("lake/main/nation", "bob", Policy(denied=frozenset({"n_name", "n_regionkey", "n_nationkey"})))
    e = _engine(spark, "owner", policies)
    create_as(e.catalog, "lake.main.nation", table(spark, folder, "nation"))
    e.run("CREATE VIEW lake.main.v AS SELECT n_name, cast(n_regionkey AS STRING) AS region, n_regionkey AS n_regionkey_of FROM lake.main.nation")
    return e.as_user("bob").sql("select * from lake.main.v")


@query("security_lookup_fails", "select n_nationkey, true as refused from nation")
def security_lookup_fails(spark, folder):
    """A policy that can't be read denies."""

    class Broken(Policies):
        def of(self, name, user):
            if user == "ann":
                raise PermissionError("access denied: no policy can be read")
            return Policy()

    e = _engine(spark, "ann", Broken())
    create_as(e.catalog, "lake.main.nation", table(spark, folder, "nation"))
    return _all(e, "n_nationkey", _refuses(e.sql, "select * from lake.main.nation"))


@query("security_current_user", "select n_nationkey, 'ann' as n_name from nation where n_nationkey < 3")
def security_current_user(spark, folder):
    return _guarded(spark, folder, Policy(("n_nationkey < length(current_user())",), masks={"n_name": "current_user()"}, denied=frozenset({"n_regionkey"}))).sql("select * from lake.main.nation")


@query("security_read_by_option", "select n_nationkey, true as refused from nation")
def security_read_by_option(spark, folder):
    """Readers by option can't filter or mask, so they refuse tables with a policy."""
    from lodestack.sources import datasource

    e = _guarded(spark, folder, Policy(("n_nationkey < 5",)))
    datasource.register(spark, e.policies, "ann")
    try:
        spark.read.format("lodestack").option("root", e.catalog.root).option("table", "lake.main.nation").load().count()
        refused = False
    except Exception as error:  # Spark wraps what the source raises
        refused = "access denied" in str(error)
    finally:
        datasource.register(spark)
    return _all(e, "n_nationkey", refused)
