import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestack.operators.table import MergeError, Table, WhenMatched, WhenNotMatched, create_as
from lodestack.sources.catalog import AlreadyExists, Catalog, CatalogError, Conflict, NoSuchTable
from lodestack.sources.specifiers import split


def small(spark):
    return spark.createDataFrame([(1, 4, "a"), (2, 6, "b"), (3, 7, "c"), (None, 8, None)], "c1 int, c2 int, c3 string")


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_partition_pruning(spark, catalog):
    t = create_as(catalog, "b.s.t", small(spark), ["c1", "bucket(4, c2)"])
    assert rows(t.scan("c2 = 6", ["c1"])) == [(2,)]
    assert t.files_for("c2 = 6") < len(catalog.manifest("b.s.t")[2].files)
    assert t.files_for("c1 is null") == 1 and rows(t.scan("c1 is null", ["c2"])) == [(8,)]
    assert t.files_for("c1 > 1 and c1 < 3") == 1
    assert t.partitions().count() == 4


@pytest.mark.parametrize("transform", ["k", "year(d)", "month(d)", "day(d)", "hour(ts)", "bucket(4, k)", "truncate(2, s)"])
def test_transform_partitions(spark, catalog, transform):
    frame = spark.range(73 * 4).select((F.col("id") % 4).cast("int").alias("k"), F.expr("date_add(date'1969-12-30', cast(id % 4 as int) * 40)").alias("d"), F.expr("timestamp_ntz'1969-12-31 22:30:00' + make_interval(0,0,0,0,cast(id % 4 as int))").alias("ts"), F.format_string("%dab", F.col("id") % 4).alias("s"))
    t = create_as(catalog, "b.s.t", frame, [transform])
    found = t.partitions()
    assert found.agg(F.sum("est_row_count")).first()[0] == 73 * 4
    assert t.scan().count() == 73 * 4
    assert 1 <= found.count() <= 4


def test_keys_with_odd_characters(spark, catalog):
    odd = ["a b", "a/b", "a=b", "ż+ó%20", "x:y", ""]
    t = create_as(catalog, "b.s.t", spark.createDataFrame([(s, i) for i, s in enumerate(odd)], "s string, i int"), ["s"])
    assert sorted(r.i for r in t.scan().collect()) == list(range(6))
    for i, s in enumerate(odd[:-1]):
        assert [r.i for r in t.scan(F_eq(s)).collect()] == [i]
    t.delete("i = 3")
    assert sorted(r.i for r in t.scan().collect()) == [0, 1, 2, 4, 5]


def F_eq(s):
    return "s = '" + s + "'"


def test_delete_keeps_unknown_and_untouched_files(spark, catalog):
    t = create_as(catalog, "b.s.t", small(spark), ["c1"])
    before = {f.path for f in catalog.manifest("b.s.t")[2].files}
    assert t.delete("c3 = 'a'") == 1
    assert rows(t.scan(columns=["c2"])) == [(6,), (7,), (8,)]
    assert len(before & {f.path for f in catalog.manifest("b.s.t")[2].files}) == 3
    assert t.delete("c3 <> 'b'") == 1  # a null is neither
    assert t.delete("c2 > 100") == 0


def test_update(spark, catalog):
    t = create_as(catalog, "b.s.t", small(spark), ["c1"])
    ids = rows(t.row_ids())
    t.update({"c3": "concat(c3, '!')", "c2": "c2 + 1"}, "c2 <= 6")
    assert rows(t.scan(columns=["c2", "c3"])) == [(5, "a!"), (7, "b!"), (7, "c"), (8, None)]
    assert rows(t.row_ids()) == ids
    for bad in ({"c1": "1"}, {"_row_id": "1"}, {"nope": "1"}):
        with pytest.raises(CatalogError):
            t.update(bad)


def test_merge(spark, catalog):
    t = create_as(catalog, "b.s.t", small(spark))
    source = spark.createDataFrame([(1, 40, "A"), (2, 60, "B"), (9, 90, "Z")], "c1 int, c2 int, c3 string")
    t.merge(source, "t.c1 = s.c1", [WhenMatched("delete", condition="s.c1 = 1"), WhenMatched("update", {"c3": "s.c3"})], [WhenNotMatched({"c1": "s.c1", "c3": "s.c3"}, "s.c2 > 50")])
    assert rows(t.scan()) == [(2, 6, "B"), (3, 7, "c"), (9, None, "Z"), (None, 8, None)]
    with pytest.raises(MergeError):
        t.merge(source.union(source), "t.c1 = s.c1", [WhenMatched("update", "*")])
    assert t.row_ids().distinct().count() == 4


def test_insert_checks(spark, catalog):
    t = create_as(catalog, "b.s.t", small(spark))
    assert t.append(spark.createDataFrame([(5,)], "c2 int")) == 1
    assert rows(t.scan("c2 = 5")) == [(None, 5, None)]
    with pytest.raises(CatalogError):
        t.append(spark.createDataFrame([(5,)], "zz int"))
    assert t.row_ids().distinct().count() == 5


def test_import(spark, catalog, tmp_path):
    spark.createDataFrame([(1,), (2,)], "i int").write.parquet(f"{tmp_path}/x")
    catalog.create_table("b.s.t", T.StructType([T.StructField("b", T.BooleanType()), T.StructField("i", T.IntegerType())]))
    t = Table(catalog, "b.s.t")
    assert t.import_files([(f"{tmp_path}/x", {"b": True}), (f"{tmp_path}/x", {"b": None}), (f"{tmp_path}/x", {"b": False, "i": 7})]) == 6
    assert rows(t.scan("b", ["i"])) == [(1,), (2,)] and rows(t.scan("not b", ["i"])) == [(7,), (7,)]
    with pytest.raises(CatalogError):
        t.import_files([(f"{tmp_path}/x", {"i": 1})])


def test_drop_partitions(spark, catalog):
    t = create_as(catalog, "b.s.t", small(spark), ["c1", "bucket(4, c2)"])
    with pytest.raises(CatalogError, match="allow_non_acid"):
        t.drop_partitions("c1 = 1")
    with pytest.raises(CatalogError):
        t.drop_partitions("c3 = 'a'", allow_non_acid=True)
    with pytest.raises(CatalogError):
        t.drop_partitions("cos(c1) > 0", allow_non_acid=True)
    assert t.drop_partitions("c1 is null or c1 = 1", allow_non_acid=True) == 2
    assert rows(t.scan(columns=["c1"])) == [(2,), (3,)]
    assert t.list_partitions({"c1": 2}).count() == 1
    with pytest.raises(NotImplementedError):
        t.create_partition({})


def test_transactions(spark, catalog):
    t = create_as(catalog, "b.s.t", small(spark))
    catalog.begin()
    with pytest.raises(CatalogError, match="active transaction"):
        catalog.begin()
    t.delete()
    assert t.scan().count() == 0
    other = Table(Catalog(spark, catalog.root), "b.s.t")
    assert other.scan().count() == 4
    catalog.rollback()
    assert t.scan().count() == 4
    catalog.begin()
    t.delete("c1 = 1")
    other.delete("c1 = 2")
    with pytest.raises(Conflict):
        catalog.commit()
    for end in (catalog.commit, catalog.rollback):
        with pytest.raises(CatalogError):
            end()
    assert rows(t.scan(columns=["c1"])) == [(1,), (3,), (None,)]


def test_two_writers(spark, catalog):
    t = create_as(catalog, "b.s.t", small(spark))
    second = Catalog(spark, catalog.root)
    _, ident, manifest = catalog.manifest("b.s.t")
    Table(second, "b.s.t").append(small(spark))
    with pytest.raises(Conflict):
        catalog.replace_manifest("b.s.t", ident, manifest)
    second.create_namespace("b.other")
    assert t.append(small(spark)) == 4 and t.scan().count() == 12


def test_ddl(spark, catalog):
    t = create_as(catalog, "b.s.t", small(spark), [], ["c1"])
    catalog.add_column("b.s.t", "d", T.DateType())
    catalog.rename_column("b.s.t", "c3", "z")
    catalog.drop_column("b.s.t", "c2")
    catalog.drop_column("b.s.t", "nope", if_exists=True)
    catalog.add_column("b.s.t", "c2", T.IntegerType())
    assert t.scan().columns == ["c1", "z", "d", "c2"]
    assert t.scan("c2 is not null").count() == 0  # a new column is not the old one
    for bad in (lambda: catalog.drop_column("b.s.t", "c1"), lambda: catalog.add_column("b.s.t", "z", T.StringType()), lambda: catalog.set_properties("b.s.t", {"sorted_by": "z"}), lambda: catalog.add_column("b.s.t", "_row_id", T.LongType()), lambda: catalog.change_column_type("b.s.t", "z", T.LongType()), lambda: catalog.add_column("b.s.t", "i", T.DayTimeIntervalType())):
        with pytest.raises((CatalogError, AlreadyExists)):
            bad()
    catalog.set_properties("b.s.t", {"owner": "x", "sorted_by": "c1"})
    assert "sorted_by" in catalog.create_statement("b.s.t")
    catalog.create_namespace("b.s2")
    catalog.rename_table("b.s.t", "b.s2.u")
    assert catalog.tables("b.s") == [] and Table(catalog, "b.s2.u").scan().count() == 4
    with pytest.raises(CatalogError):
        catalog.rename_table("b.s2.u", "c.s.u")
    with pytest.raises(CatalogError):
        catalog.drop_namespace("b.s2")
    assert catalog.drop_table("b.s2.u") and not catalog.drop_table("b.s2.u", if_exists=True)
    with pytest.raises(NoSuchTable):
        catalog.drop_table("b.s2.u")
    catalog.drop_namespace("b.s2")
    with pytest.raises(CatalogError):
        catalog.create_namespace("single")


def test_create_checks(catalog):
    i = T.StructField("i", T.IntegerType())
    for schema, parts, sort in [([i, i], [], []), ([i], ["nope"], []), ([i], ["i"] * 5, []), ([i], [], ["nope"]), ([i], [], ["i", "i"]), ([T.StructField("n", T.NullType())], [], []), ([T.StructField("a", T.ArrayType(T.YearMonthIntervalType()))], [], []), ([i], ["year(i)"], [])]:
        with pytest.raises((CatalogError, TypeError)):
            catalog.create_table("b.s.x", T.StructType(schema), parts, sort)
    assert catalog.create_table("b.s.x", T.StructType([i])) and not catalog.create_table("b.s.x", T.StructType([i]), if_not_exists=True)
    with pytest.raises(AlreadyExists):
        catalog.create_table("b.s.x", T.StructType([i]))


def test_nested_types(spark, catalog):
    frame = spark.sql("select true as b, 1 as i, map('k', 1) as m, named_struct('a', 1, 'b', 'x') as r, array(named_struct('a', 1S, 'd', 'q')) as n, timestamp_ntz'2024-11-16 12:34:56' as t, cast(1.5 as decimal(12,2)) as d, X'00ff' as x, 1.5f as f")
    t = create_as(catalog, "b.s.t", frame)
    assert t.scan().first() == frame.first() and t.scan("r.a = 1", ["r.b"]).first()[0] == "x"
    assert t.append(frame.limit(0)) == 0


def test_sort_key_orders_files(spark, catalog):
    t = create_as(catalog, "b.s.t", spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")), [], ["k"])
    plan = t.scan("k < 10")._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "LessThan" in plan
    per_file = t.scan().groupBy(F.spark_partition_id()).agg(F.min("k"), F.max("k")).count()
    assert per_file >= 1 and t.scan().count() == 1000


def test_rows_by_id(spark, catalog):
    t = create_as(catalog, "b.s.t", small(spark))
    found = t.scan("c1 = 2", hidden=True).first()["_row_id"]
    assert t.get(found, ["c3"]).first()[0] == "b" and "_row_id" in t.get(found).columns
    assert t.get(-5).count() == 0
    assert t.delete_by_ids([found]) == 1 and t.get(found).count() == 0
    assert t.delete_by_ids([]) == 0


def test_timestamp_keys(spark, catalog):
    frame = spark.createDataFrame([(dt.datetime(2020, 1, 1, 5, 30), 1), (dt.datetime(2020, 1, 1, 6, 30), 2), (None, 3)], "ts timestamp_ntz, i int")
    t = create_as(catalog, "b.s.t", frame, ["ts"])
    assert rows(t.scan("ts = timestamp '2020-01-01 05:30:00'", ["i"])) == [(1,)]
    assert t.files_for("ts = timestamp '2020-01-01 05:30:00'") == 1


@pytest.mark.parametrize(("name", "want"), [("a.b.t", ("a.b.t", None)), ("a.b.t.partitions", ("a.b.t", ("partitions",))), ("a.b.`t x.allow_non_acid`", ("a.b.t", ("allow_non_acid",))), ("a.b.`t import_data(c, d)`", ("a.b.t", ("import_data", ("c", "d")))), ("a.b.t$partitions allow_non_acid", ("a.b.t", ("allow_non_acid", "partitions")))])
def test_specifiers(name, want):
    assert split(name) == want
