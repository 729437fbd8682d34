"""Every query of the library against DuckDB, as the driver does, and the shape of some plans."""

import duckdb
import pytest

from lodestack.plans import queries

queries.load()
OWN = sorted(queries.QUERIES)


@pytest.fixture(scope="module")
def duck(folder):
    out = duckdb.connect()
    out.execute("SET TimeZone = 'UTC'")
    for t in queries.TABLES:
        out.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return out


def values(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(float(v)) if isinstance(v, float) else str(v) for v in (r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, folder, name):
    got = queries.QUERIES[name](spark, folder)
    want = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert values(got.collect(), got.columns) == values(want.fetchall(), columns)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark, folder):
    p = plan(queries.QUERIES["filter_or_multi_col"](spark, folder))
    assert "PushedFilters: [Or(" in p and "p_comment" not in p
    assert "StringContains" in plan(queries.QUERIES["filter_like_substring"](spark, folder))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double" in plan(queries.QUERIES["filter_between"](spark, folder))


def test_no_nested_loops(spark, folder):
    for name in ("join_theta_range", "join_skewed", "join_colocated", "subquery_exists", "subquery_correlated_scalar", "join_dynamic_filter"):
        p = plan(queries.QUERIES[name](spark, folder))
        assert "NestedLoop" not in p and "Cartesian" not in p, name


def test_fields_of_stored_structs_are_pruned(spark, folder):
    p = plan(queries.QUERIES["nested_pushdown"](spark, folder))
    assert "props" not in p.split("ReadSchema")[1] and "b.value" in p.split("PushedFilters")[1]


def test_only_conditions_on_the_sort_key_are_pushed(spark, folder):
    pushed = plan(queries.QUERIES["scan_only_ordered"](spark, folder)).split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual" in pushed and "200000" not in pushed


def test_bucket_function_is_part_of_the_plan(spark, folder):
    assert "Python" not in plan(queries.QUERIES["fn_transforms_sql"](spark, folder))


def test_bucketed_join_has_no_exchange_of_its_inputs(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(queries.QUERIES["colocated_bucket_join"](spark, folder))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in p


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
