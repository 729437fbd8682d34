import json
import pytest
from pyspark.sql import functions as F

from lodestack.engine import Engine, Policies, Policy
from lodestack.operators.joins import filtered_join, range_join, salted_join
from lodestack.operators.table import create_as
from lodestack.plans.predicates import Unsupported, read
from lodestack.plans.statistics import Bin, ColumnStats, Estimator, StatisticsStore, TableStats, analyze, split_counts
from lodestack.sources.catalog import AlreadyExists, CatalogError, NoSuchView


@pytest.fixture
def engine(spark, tmp_path):
    out = Engine(spark, str(tmp_path), "ann")
    out.catalog.create_namespace("b.s")
    create_as(out.catalog, "b.s.t", spark.createDataFrame([(1, "a1", 10), (2, "b22", 20), (3, None, 30)], "x int, s string, y int"))
    return out


def policy(engine, **options):
    engine.policies = Policies({("b/s/t", "ann"): Policy(**options)})


def test_sql(engine):
    assert engine.sql("with q as (select x from b.s.t where y > 10) select count(*) as n from q").first().n == 2
    assert engine.sql("select a.x from b.s.t a join b.s.t as c on a.x + 1 = c.x where c.s is not null").first().x == 1
    assert engine.sql("select 1 as one").first().one == 1
    assert engine.sql("select '{x}' as b, x from b.s.t where x = 1").first().b == "{x}"
    assert engine.sql("select * from b.s.t order by x").columns == ["x", "s", "y"]


def test_parquet_paths_still_resolve(engine, spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/p")
    assert engine.sql(f"select count(*) as n from parquet.`{tmp_path}/p`").first().n == 3


def test_filters_and_masks(engine):
    policy(engine, row_filters=("length(s) > 2", "y < 100"), masks={"s": "regexp_replace(s, '[0-9]', '*')"})
    assert [tuple(r) for r in engine.sql("select x, s from b.s.t").collect()] == [(2, "b**")]
    assert engine.table("b.s.t", "s = 'b**'").count() == 1 and engine.table("b.s.t", "s = 'b22'").count() == 0
    with pytest.raises(PermissionError):
        engine.delete("b.s.t", "x = 1")
    with pytest.raises(PermissionError):
        engine.update("b.s.t", {"y": "1"})
    with pytest.raises(PermissionError):
        engine.get("b.s.t", 0)


def test_delete_adds_the_filter(engine):
    policy(engine, row_filters=("y >= 20",))
    assert engine.delete("b.s.t", "x <= 2") == 1
    assert sorted(r.x for r in engine.as_user("root").table("b.s.t").collect()) == [1, 3]


def test_denied_and_allowed_columns(engine):
    policy(engine, denied=frozenset({"y"}))
    assert engine.table("b.s.t").columns == ["x", "s"]
    with pytest.raises(PermissionError):
        engine.table("b.s.t", columns=["y"])
    policy(engine, allowed=frozenset({"x"}), masks={"s": "'?'"})
    assert engine.table("b.s.t").columns == ["x", "s"]
    policy(engine, denied=frozenset({"x", "y", "s"}))
    with pytest.raises(PermissionError):
        engine.table("b.s.t")


def test_current_user_and_failing_lookup(engine):
    policy(engine, row_filters=("concat(current_user(), x) = 'ann2'",))
    assert [r.x for r in engine.table("b.s.t").collect()] == [2]

    class Broken(dict):
        def get(self, *_):
            raise OSError

    engine.policies.known = Broken()
    with pytest.raises(PermissionError):
        engine.table("b.s.t")


def test_partitions_are_denied_with_filters(engine, spark):
    create_as(engine.catalog, "b.s.p", spark.range(4).withColumn("k", F.col("id") % 2), ["k"])
    assert engine.sql("select k, est_row_count from b.s.p.partitions").count() == 2
    engine.policies = Policies({("b/s/p", "ann"): Policy(("id > 1",))})
    with pytest.raises(PermissionError):
        engine.table("b.s.p.partitions")


def test_views(engine):
    engine.create_view("b.s.v", "select x, y * 2 as z from b.s.t", ["key", "twice"], {"twice": "y * 2"}, comment="c", properties={"p": "1"})
    assert engine.sql("select twice from b.s.v where key = 1").first().twice == 20
    for bad in (lambda: engine.create_view("b.s.v", "select 1"), lambda: engine.create_view("b.s.t", "select 1", replace=True)):
        with pytest.raises(AlreadyExists):
            bad()
    with pytest.raises(CatalogError):
        engine.create_view("b.s.w", "select 1 as a, 2 as b", ["one"])
    with pytest.raises(CatalogError):
        engine.delete("b.s.v")
    engine.alter_view("b.s.v", "select x, y * 3 as z from b.s.t")
    assert engine.sql("select * from b.s.v").columns == ["key", "twice"]
    engine.alter_view("b.s.v", "select s from b.s.t")
    assert engine.view("b.s.v")["columns"] == ["s"] and engine.view("b.s.v")["comments"] == {} and engine.view("b.s.v")["comment"] == "c"
    engine.rename_view("b.s.v", "b.s.w")
    with pytest.raises(CatalogError):
        engine.rename_view("b.s.w", "b.other.w")
    assert [tuple(r) for r in engine.views("b.s").collect()] == [("b/s", "w", False)]
    engine.policies = Policies({("b/s/w", "ann"): Policy(("s is not null",), masks={"s": "substring(s, 1, 1)"})})
    assert sorted(r.s for r in engine.sql("select s from b.s.w").collect()) == ["a", "b"]
    assert engine.drop_view("b.s.w") and not engine.drop_view("b.s.w", if_exists=True)
    with pytest.raises(NoSuchView):
        engine.drop_view("b.s.w")


def test_execute(engine):
    got = engine.execute("select x, s from b.s.t where x >= 2 and 'g''1' in (<groups>) order by x", ["g'1"], enforce_identity=True)
    assert [r.records for r in got.collect()] == ['{"x":2,"s":"b22"}', '{"x":3,"s":null}']
    for text, groups in (("select 1 as a", ["g"]), ("select <groups>", [])):
        with pytest.raises(PermissionError):
            engine.execute(text, groups, enforce_identity=True)
    text = "select map(1, array(map('a', cast('x' as binary)))) as m, named_struct('t', map('k', 2), 'n', null) as s, cast(null as map<int, int>) as e, array(1, null) as l"
    assert json.loads(engine.execute(text).first().records) == {"m": [{"key": 1, "value": [[{"key": "a", "value": "eA=="}]]}], "s": {"t": [{"key": "k", "value": 2}], "n": None}, "e": None, "l": [1, None]}


def test_select_restricted(engine):
    assert [tuple(r) for r in engine.select("select s, x from b.s.t where x not in (2, 7) order by x desc limit 5;").collect()] == [(None, 3), ("a1", 1)]
    assert engine.select("select * from b.s.t where s is null or y = 10").count() == 2
    for bad in ("select x + 1 from b.s.t", "select x from b.s.t where abs(x) = 1", "select x from b.s.t group by x", "select x from b.s.t where x <> 1"):
        with pytest.raises(Unsupported):
            engine.select(bad)


def test_put(engine, spark):
    ids = [r[0] for r in engine.put("b.s.t", spark.createDataFrame([(8, "q")], "x int, s string")).collect()]
    assert len(ids) == 1 and engine.get("b.s.t", ids[0], ["x"]).first().x == 8
    assert len(list(engine.batches("select x from b.s.t"))) == 4


# Statistics


def test_shares_of_ranges_and_bins():
    low, high, distinct = 20, 70, 40
    even = Estimator(TableStats(500, 4000, {"x": ColumnStats(distinct, low, high)}))
    assert even.selectivity(read("x = 33")) == pytest.approx(1 / distinct)
    for v in (25, 47, 69):
        assert even.selectivity(read(f"x < {v}")) == pytest.approx((v - low) / (high - low))
    assert even.selectivity(read("x = 71")) == 0 and even.selectivity(read("x > 70")) == 0
    bins = (Bin(0, 4, 5), Bin(5, 30, 8), Bin(31, 40, 3), Bin(41, 90, 20))  # as many rows in each
    uneven = Estimator(TableStats(500, 4000, {"x": ColumnStats(36, 0, 90, histogram=bins)}))
    for b in bins:
        assert uneven.selectivity(read(f"x = {b.high - 1}")) == pytest.approx(1 / len(bins) / b.ndv)


def test_selectivity_rules():
    e = Estimator(TableStats(100, 100, {"a": ColumnStats(10, 0, 9, nulls=20), "b": ColumnStats(4, 0, 3)}))
    assert e.selectivity(read("a is null")) == pytest.approx(0.2) and e.selectivity(read("a is not null")) == pytest.approx(0.8)
    x, y = e.selectivity(read("a = 1")), e.selectivity(read("b = 1"))
    assert e.selectivity(read("a = 1 and b = 1")) == pytest.approx(x * y)
    from lodestack.plans.predicates import parse

    assert e.selectivity(parse("a = 1 or b = 1")) == pytest.approx(x + y - x * y)
    assert e.selectivity(read("c = 1")) == 1 and e.selectivity(read("cos(a) > 1")) == 1
    after = e.after(read("b >= 2")).columns["b"]
    assert after.low == 2 and after.high == 3
    assert e.worth_pushing([parse("a is not null"), parse("c = 1")]) == [parse("a is not null")]


def test_split_counts():
    assert split_counts(100, 0.5, 1000) == (1, 1)
    assert split_counts(10 << 20, None, 1000)[0] == 256
    few, many = split_counts(100 << 20, 0.0001, 4 << 20), split_counts(100 << 20, 1.0, 4 << 20)
    assert few[0] <= many[0] and few[1] >= many[1]


def test_statistics_store(engine, spark):
    store = StatisticsStore(engine.catalog)
    assert store.get("b.s.t").rows == 3 and not store.get("b.s.t").columns
    store.analyze("b.s.t", ["x"])
    got = store.analyze("b.s.t", ["s"])
    assert got.columns["x"].high == 3 and got.columns["s"].nulls == 1 and got.columns["s"].max_len == 3
    engine.catalog.rename_table("b.s.t", "b.s.u")
    assert StatisticsStore(engine.catalog).get("b.s.u").columns["x"].low == 1


def test_analyze_kinds(spark):
    found = analyze(spark.sql("select * from values (date'2020-01-01', 1.5d, true, array(1)), (null, null, null, null) as t(d, f, b, a)"), ["d", "f", "b", "a"]).columns
    assert found["d"].nulls == 1 and found["f"].low == 1.5 and found["a"].ndv is None
    assert analyze(spark.range(0).withColumn("x", F.col("id")), ["x"]).rows == 0


# Joins


def test_range_join(spark):
    points = spark.createDataFrame([(i,) for i in (0, 5, 9, 10, 99, None)], "v int")
    ranges = spark.createDataFrame([(1, 0, 10), (2, 5, 6), (3, 90, 200), (4, None, 3)], "r int, lo int, hi int")
    got = sorted((r.v, r.r) for r in range_join(points, ranges, "v", "lo", "hi", 4).collect())
    assert got == [(0, 1), (5, 1), (5, 2), (9, 1), (99, 3)]


def test_range_join_of_very_long_ranges(spark):
    points = spark.range(0, 100_000, 997).withColumnRenamed("id", "v")
    made = [(i, i * 1000, i * 1000 + 10**k) for k in range(0, 13, 2) for i in range(4)] + [(9, 5, 5), (9, 7, 6), (9, None, 3), (9, -(10**9), 10**9)]
    ranges = spark.createDataFrame(made, "r int, lo long, hi long")
    got = sorted((r.v, r.lo, r.hi) for r in range_join(points, ranges, "v", "lo", "hi", 4).collect())
    assert got == sorted((v, lo, hi) for v in range(0, 100_000, 997) for _, lo, hi in made if lo is not None and lo <= v < hi)


def test_table_join_opens_few_files(spark, catalog):
    from lodestack.operators.joins import table_join
    from lodestack.operators.table import create_as

    t = create_as(catalog, "b.s.t", spark.range(400).selectExpr("id as k", "date_add(date'2020-01-01', cast(id * 7 as int)) as d"), ["year(d)"])
    other = spark.sql("select date'2020-01-08' as day, 'a' as x union all select date'2021-05-05', 'b' union all select null, 'c'")
    got = table_join(t, other, "d", "day")
    assert sorted((r.k, r.x) for r in got.collect()) == [(1, "a"), (70, "b")]
    assert got.count() == table_join(t, other, "d", "day", most_values=1).count()
    assert len(got.select(F.input_file_name()).distinct().collect()) <= 2
    assert table_join(t, other.where("day is null"), "d", "day").count() == 0


def test_salted_join(spark):
    hot = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), ("c", 2)], "k string, i int")
    other = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, n string")
    assert salted_join(hot, other, ["k"]).count() == 51 and salted_join(hot, other, ["k"], "left").count() == 52
    assert salted_join(hot, other, ["k"], "left_anti").count() == 1
    with pytest.raises(ValueError):
        salted_join(hot, other, ["k"], "full")


@pytest.mark.parametrize("most", [1, 10_000])
def test_filtered_join(spark, most):
    large, small = spark.range(1000), spark.createDataFrame([(5,), (7,), (7,), (None,)], "k long")
    assert sorted(r.id for r in filtered_join(large, small, "id", "k", most).collect()) == [5, 7, 7]
    assert filtered_join(large, small.where("k > 100"), "id", "k").count() == 0
