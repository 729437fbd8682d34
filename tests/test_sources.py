import pytest
from pyspark.sql import functions as F

from lodestack.engine import Engine
from lodestack.functions import sql
from lodestack.operators.table import create_as
from lodestack.sources import datasource
from lodestack.sources.bucketed import bucketed
from lodestack.sources.catalog import NoSuchTable


def test_functions(spark):
    assert len(sql.register(spark)) == 8
    row = spark.sql("select ls_years(timestamp_ntz'1969-12-31 23:30:00') y, ls_months(timestamp_ntz'1970-02-01 00:00:00') m, ls_days(timestamp_ntz'1969-12-31 00:00:00') d, ls_hours(timestamp_ntz'1969-12-31 23:30:00') h, ls_truncate(10, -7) t, ls_truncate_text(2, 'abc') s, ls_bucket(16, 34) b, ls_bucket(16, cast(null as bigint)) n, ls_bucket_text(16, 'abc') x").first()
    assert tuple(row)[:8] == (-1, 1, -1, -1, -10, "ab", 3, None) and 0 <= row.x < 16
    got = spark.sql("select id, ls_bucket(7, id) as b from range(100)").collect()
    from pyspark.sql import types as T

    from lodestack.functions.transforms import Transform, apply_value

    assert all(r.b == apply_value(Transform("v", "bucket", 7), r.id, T.LongType()) for r in got)


def test_read_by_option(spark, catalog):
    rows = spark.range(40).select("id", (F.col("id") % 4).cast("int").alias("k"), F.when(F.col("id") > 3, F.concat(F.lit("x"), "id")).alias("s"))
    create_as(catalog, "b.s.t", rows, ["k"])
    catalog.rename_column("b.s.t", "s", "text")
    from pyspark.sql import types as T

    catalog.add_column("b.s.t", "more", T.DoubleType())
    datasource.register(spark)
    got = spark.read.format("lodestack").option("root", catalog.root).option("table", "b.s.t").load()
    assert got.columns == ["id", "k", "text", "more"] and got.count() == 40
    assert got.where("k = 2 and id > 5").count() == 9 and got.where("more is null").count() == 40
    assert datasource.append(spark.range(100, 103), catalog.root, "b.s.t") == 3
    assert spark.read.format("lodestack").option("root", catalog.root).option("table", "b.s.t").load().where("k is null").count() == 3
    reader = datasource.TableReader(catalog.root, "b.s.t", got.schema)
    before = len(reader.partitions())
    list(reader.pushFilters([datasource.EqualTo(("k",), 2)]))
    assert len(reader.partitions()) < before
    with pytest.raises(NoSuchTable):
        datasource.load(catalog.root, "b.s.nope")


def test_system_tables(spark, catalog):
    engine = Engine(spark, catalog.root)
    create_as(catalog, "b.s.t", spark.range(3))
    engine.create_view("b.s.v", "select id as x from b.s.t")
    assert engine.sql("select version from system_schema.release").count() == 1
    assert [tuple(r) for r in engine.sql("select * from information_schema.tables order by table_name").collect()] == [("b.s", "t", "BASE TABLE"), ("b.s", "v", "VIEW")]
    assert engine.sql("select column_name from information_schema.columns where table_name = 'v'").first()[0] == "x"
    assert engine.sql("select * from information_schema.schemata").count() == 1


def test_bucketed(spark, tmp_path):
    out = bucketed(spark.range(100), "id", 4, path=f"{tmp_path}/b")
    assert out.count() == 100
    plan = out.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_bucket_of_texts(spark):
    from pyspark.sql import types as T

    from lodestack.functions.transforms import Transform, apply_value

    sql.register(spark)
    got = spark.sql("select s, ls_bucket_text(5, s) as b from values ('a'), ('éß'), (''), (null), ('a') as t(s)").collect()
    assert [r.b for r in got] == [None if r.s is None else apply_value(Transform("v", "bucket", 5), r.s, T.StringType()) for r in got]


def test_write_by_option(spark, catalog):
    from lodestack.sources.catalog import Conflict

    rows = spark.range(30).select("id", F.expr("timestamp'2020-01-01 10:00:00' + make_interval(0, cast(id % 3 as int))").alias("ts"), F.concat(F.lit("n"), F.col("id") % 4).alias("s"))
    t = create_as(catalog, "b.s.t", rows, ["month(ts)", "bucket(4, id)", "s"], ["id"])
    datasource.register(spark)
    more = spark.range(100, 140).select(F.col("id"), F.expr("if(id % 5 = 0, null, timestamp'2021-03-01 00:00:00')").alias("ts"))
    options = {"root": catalog.root, "table": "b.s.t"}
    more.write.format("lodestack").options(**options).mode("append").save()
    assert t.scan().count() == 70 and t.row_ids().distinct().count() == 70
    assert t.scan("id = 117").count() == 1 and t.scan("ts >= timestamp '2021-02-01' and s is null").count() == 32
    assert t.files_for("id = 117") < t.files_for("id > 0")
    t.delete("id >= 120")
    t.append(rows.where("id < 5"))
    assert t.scan().count() == 55 and t.row_ids().distinct().count() == 55
    with pytest.raises(Exception, match="append"):
        more.write.format("lodestack").options(**options).mode("overwrite").save()
    with pytest.raises(Exception, match="no column"):
        spark.range(2).withColumnRenamed("id", "nope").write.format("lodestack").options(**options).mode("append").save()
    stale = datasource.TableWriter(catalog.root, "b.s.t", more.schema)
    t.append(rows.where("id < 2"))
    with pytest.raises(Conflict):
        stale.commit([datasource.Written([["x", 1, 1, [None, "0", None]]], 10**6)])
    assert t.scan().count() == 57
    more.write.format("lodestack").options(**(options | {"root": f"file://{catalog.root}"})).mode("append").save()
    assert t.scan().count() == 97
    with pytest.raises(ValueError, match="mounted"):
        datasource.TableWriter("s3://bucket/lake", "b.s.t", more.schema)


def test_a_hot_key_is_written_by_several_tasks(spark, catalog):
    rows = spark.range(300_000).select("id", F.expr("if(id % 20 = 0, cast(id % 400 as int), 7)").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("s"))
    saved = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        t = create_as(catalog, "b.s.t", rows, ["k"])
    finally:
        for c, v in saved.items():
            spark.conf.set(c, v)
    _, _, manifest = catalog.manifest("b.s.t")
    hot = [f for f in manifest.files if f.keys == ["7"]]
    assert len(hot) > 3 and max(f.rows for f in hot) < 150_000 and t.scan().count() == 300_000
