import pytest

from lodestack.engine import Engine
from lodestack.sources.catalog import AlreadyExists, CatalogError, NoSuchTable
from lodestack.statements import BadStatement, split_list


@pytest.fixture
def run(spark, tmp_path):
    engine = Engine(spark, str(tmp_path))
    engine.run("CREATE SCHEMA b.s")
    return engine.run


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_tables(run):
    run("CREATE TABLE b.s.t (site INT, unit INT COMMENT 'two', note STRING) USING parquet PARTITIONED BY (site, bucket(6, unit)) TBLPROPERTIES ('sorted_by'='unit', 'x'='y')")
    assert run("INSERT INTO b.s.t VALUES (10, 40, 'oak'), (20, 41, 'elm'), (30, 55, 'ash'), (30, 12, 'fir')").first()[0] == 4
    run("INSERT INTO b.s.t (note, unit) SELECT concat('young ', note), unit + 1 FROM b.s.t WHERE site = 30")
    assert rows(run("SELECT site, note FROM b.s.t WHERE unit >= 41")) == [(20, "elm"), (30, "ash"), (None, "young ash")]
    assert rows(run("SELECT sum(est_row_count) FROM b.s.t.partitions")) == [(6,)]
    assert "bucket(unit, 6)" in run("SHOW CREATE TABLE b.s.t").first()[0]
    assert ("unit", "int", "two") in rows(run("DESCRIBE b.s.t"))
    assert rows(run("SHOW COLUMNS IN b.s.t")) == [("note",), ("site",), ("unit",)]
    assert rows(run("SHOW TABLES IN b.s")) == [("b.s", "t", False)] and rows(run("show schemas")) == [("b.s",)]
    run("UPDATE b.s.t SET note = replace(note, 'WHERE', 'x') WHERE unit = 41")
    with pytest.raises(CatalogError):
        run("UPDATE b.s.t SET site = 4")
    assert run("DELETE FROM b.s.t AS q WHERE q.unit = 40").first()[0] == 1
    with pytest.raises(CatalogError, match="allow_non_acid"):
        run("ALTER TABLE b.s.t DROP PARTITION (site = 20)")
    run("ALTER TABLE b.s.`t allow_non_acid` DROP PARTITION (site = 20)")
    assert run("SELECT * FROM b.s.t").count() == 4
    assert run("DELETE FROM b.s.t").first()[0] == 4
    with pytest.raises(AlreadyExists):
        run("CREATE TABLE b.s.t (x INT)")
    assert run("CREATE TABLE IF NOT EXISTS b.s.t (x INT)").first()[0] is False
    for bad in ("CREATE OR REPLACE TABLE b.s.t (x INT)", "CREATE TABLE b.s.u (x INT NOT NULL)", "CREATE TABLE b.s.u (x INTERVAL YEAR)", "ALTER TABLE b.s.t ALTER COLUMN site TYPE LONG", "DROP SCHEMA b.s", "DROP SCHEMA b.s CASCADE", "CREATE TABLE b.s.u", "ALTER TABLE b.s.t FROB", "INSERT INTO b.s.t (site) VALUES (1, 2)"):
        with pytest.raises((CatalogError, BadStatement)):
            run(bad)
    run("DROP TABLE b.s.t; ")
    with pytest.raises(NoSuchTable):
        run("DROP TABLE b.s.t")
    run("DROP TABLE IF EXISTS b.s.t")
    run("DROP SCHEMA b.s")


def test_other_spelling(run):
    run("CREATE TABLE b.s.t WITH (partitioning = ARRAY['kind', 'bucket(weight, 3)'], sorted_by = ARRAY['day']) AS SELECT concat('k', id % 2) AS kind, id * 10 AS weight, date_add(date'2020-02-01', cast(id AS INT)) AS day FROM range(9)")
    assert rows(run("SELECT kind, weight FROM b.s.t WHERE weight >= 60 AND kind = 'k0'")) == [("k0", 60), ("k0", 80)]
    assert rows(run("SELECT sum(est_row_count) FROM b.s.t.partitions")) == [(9,)] and run("SHOW PARTITIONS b.s.t").count() <= 6


def test_alter(run):
    run("CREATE TABLE b.s.t (a INT, b STRING)")
    run("ALTER TABLE b.s.t ADD COLUMNS (d DATE COMMENT 'day', e DECIMAL(12, 2))")
    run("ALTER TABLE b.s.t RENAME COLUMN b TO bb")
    run("ALTER TABLE b.s.t DROP COLUMN IF EXISTS nope")
    run("ALTER TABLE b.s.t DROP COLUMN e")
    run("ALTER TABLE b.s.t SET TBLPROPERTIES ('sorted_by'='a')")
    with pytest.raises(CatalogError):
        run("ALTER TABLE b.s.t SET TBLPROPERTIES ('sorted_by'='d')")
    run("ALTER TABLE b.s.t RENAME TO b.s.u")
    assert run("SELECT * FROM b.s.u").columns == ["a", "bb", "d"]
    run("ALTER TABLE b.s.u REPLACE COLUMNS (z STRING)")
    assert run("SELECT * FROM b.s.u").columns == ["a", "z"]
    run("ALTER SCHEMA b.s RENAME TO b.q")
    assert run("SELECT count(*) FROM b.q.u").first()[0] == 0


def test_merge(run):
    run("CREATE TABLE b.s.t AS SELECT id AS k, 'old' AS v FROM range(5)")
    run("CREATE TABLE b.s.u AS SELECT id AS k, concat('n', id) AS v FROM range(3, 8)")
    run("MERGE INTO b.s.t AS tgt USING b.s.u AS src ON tgt.k = src.k WHEN MATCHED AND src.k = 3 THEN DELETE WHEN MATCHED THEN UPDATE SET v = concat(tgt.v, '+', src.v) WHEN NOT MATCHED AND src.k < 7 THEN INSERT (k, v) VALUES (src.k, 'new')")
    assert rows(run("SELECT * FROM b.s.t")) == [(0, "old"), (1, "old"), (2, "old"), (4, "old+n4"), (5, "new"), (6, "new")]
    run("MERGE INTO b.s.t USING (SELECT * FROM b.s.u WHERE k = 7) x ON t.k = x.k WHEN NOT MATCHED THEN INSERT *")
    assert (7, "n7") in rows(run("SELECT * FROM b.s.t"))


def test_views_and_ctes(run):
    run("CREATE TABLE b.s.t AS SELECT id AS k FROM range(5)")
    run("CREATE OR REPLACE VIEW b.s.v (twice COMMENT 'k, doubled', b) COMMENT 'c' TBLPROPERTIES ('p'='1') AS WITH q AS (SELECT k FROM b.s.t) SELECT k * 2, k FROM q")
    assert rows(run("SELECT twice FROM b.s.v WHERE b = 2")) == [(4,)]
    assert rows(run("SHOW VIEWS IN b.s")) == [("b/s", "v", False)] and rows(run("DESCRIBE b.s.v"))[1][2] == "k, doubled"
    run("ALTER VIEW b.s.v AS SELECT k FROM b.s.t")
    run("ALTER VIEW b.s.v RENAME TO b.s.w")
    assert run("SELECT * FROM b.s.w").columns == ["k"] and run("DROP VIEW b.s.w").first()[0]
    assert run("DROP VIEW IF EXISTS b.s.w").first()[0] is False


def test_transactions_and_statistics(run):
    run("CREATE TABLE b.s.t AS SELECT id AS k FROM range(5)")
    assert run("SELECT create_tx()").first()[0] is True
    run("DELETE FROM b.s.t")
    run("SELECT rollback_tx()")
    run("START TRANSACTION")
    run("DELETE FROM b.s.t WHERE k = 0")
    run("COMMIT")
    with pytest.raises(CatalogError):
        run("ROLLBACK")
    run("ANALYZE TABLE b.s.t COMPUTE STATISTICS FOR COLUMNS k")
    got = {r.column_name: r for r in run("SHOW STATS FOR b.s.t").collect()}
    assert got["k"].low_value == "1" and got[None].row_count == 4
    run("ANALYZE TABLE b.s.t COMPUTE STATISTICS FOR ALL COLUMNS")
    assert run("SELECT records FROM TABLE(x.execute('select k from b.s.t where k = 1 and ''a'' = ''a'''))").first()[0] == '{"k":1}'


def test_import(run, spark, tmp_path):
    spark.range(3).selectExpr("cast(id as int) as i").write.parquet(f"{tmp_path}/f")
    run("CREATE TABLE b.s.t (b BOOLEAN, i INT)")
    run(f"INSERT INTO b.s.`t import_data(b)` (b, `$parquet_file_path`) VALUES (true, '{tmp_path}/f')")
    assert rows(run("SELECT * FROM b.s.t")) == [(True, 0), (True, 1), (True, 2)]


def test_lists():
    assert split_list("a, f(b, c), 'x, y', d[1, 2]") == ["a", "f(b, c)", "'x, y'", "d[1, 2]"]
    with pytest.raises(BadStatement):
        split_list("f(a")
