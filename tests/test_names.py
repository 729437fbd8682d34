import pytest

from lodestack.engine import Engine
from lodestack.sources.names import run, with_dollars_quoted


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    e = Engine(spark, str(tmp_path_factory.mktemp("names")))
    e.run("CREATE SCHEMA sea.one")
    e.run("CREATE SCHEMA sea.two")
    e.run("CREATE TABLE sea.one.fish AS SELECT id AS k, date_add(date'2021-05-01', cast(400 * id AS int)) AS d, named_struct('k', -id) AS fish FROM range(5)")
    e.run("CREATE TABLE sea.two.fish AS SELECT id * 2 AS k, 'two' AS w FROM range(5)")
    e.run("CREATE TABLE sea.one.boat AS SELECT id AS k, concat('b', id) AS w FROM range(4)")
    return e


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


CASES = {
    "select 'taken from sea.one.fish today' as x": [("taken from sea.one.fish today",)],
    "select 1 as x -- from sea.one.nothing\n": [(1,)],
    "select /* join sea.one.nothing */ count(*) from sea.one.fish": [(5,)],
    'select "from sea.one.fish x" as x, "{t0}" as y from sea.one.boat where k = 0': [("from sea.one.fish x", "{t0}")],
    "select x.k, y.w from sea.one.fish x, sea.one.boat y where x.k = y.k": [(0, "b0"), (1, "b1"), (2, "b2"), (3, "b3")],
    "select fish.k from sea.one.fish, sea.one.boat where fish.k = boat.k and boat.w = 'b2'": [(2,)],
    "select sea.one.boat.k, one.boat.w, boat.k from sea.one.boat where sea.one.boat.k > 2": [(3, "b3", 3)],
    "select sea.one.boat.* from sea.one.boat join sea.two.fish on sea.one.boat.k = sea.two.fish.k": [(0, "b0"), (2, "b2")],
    "select sea.one.fish.k, sea.two.fish.w from sea.one.fish, sea.two.fish where sea.one.fish.k = sea.two.fish.k": [(0, "two"), (2, "two"), (4, "two")],
    "select extract(year from sea.one.fish.d) as y from sea.one.fish where k < 2": [(2021,), (2022,)],
    "with b as (select k from sea.one.boat), fish as (select k + 1 as k from b) select max(k) from fish": [(4,)],
    "select count(*) from sea.one.fish f where exists (select 1 from sea.two.fish g where g.k = f.k) and f.k in (select k from sea.one.boat)": [(2,)],
    "select (select max(k) from sea.two.fish) as m, trim(both 'b' from w) as t from sea.one.boat where k = 1": [(8, "1")],
    "select l.k from sea.one.boat b, lateral (select b.k + f.k as k from sea.two.fish f where f.k = b.k) l": [(0,), (4,)],
    "select k from sea.one.boat union all (select k from sea.two.fish where k > 4) except select 8": [(0,), (1,), (2,), (3,), (6,)],
    "table sea.one.boat": [(0, "b0"), (1, "b1"), (2, "b2"), (3, "b3")],
    "select boat.k from sea.one.boat tablesample (100 percent) where boat.k = 1": [(1,)],
    "select '🙂' as s, `sea`.`one`.`boat`.`w` from `sea`.`one`.`boat` where w = 'b1' and '🙂🙂' <> 'from'": [("🙂", "b1")],
    "select fish.k from sea.one.fish as f where f.k = 3": [(-3,)],
    "select x.k from sea.one.boat x join sea.one.boat y using (k) where y.w = 'b3'": [(3,)],
}


@pytest.mark.parametrize("text", CASES)
def test_names(engine, text):
    assert rows(engine.sql(text)) == sorted(CASES[text])


def test_names_in_views(engine):
    engine.create_view("sea.one.told", "select 'from sea.one.boat' as said, sea.one.boat.k from sea.one.boat")
    assert rows(engine.sql("select said, k from sea.one.told where k = 1")) == [("from sea.one.boat", 1)]


def test_errors_are_the_parsers(engine):
    from pyspark.errors import ParseException

    with pytest.raises(ParseException):
        engine.sql("select ) from sea.one.boat")


def test_dollars():
    assert with_dollars_quoted("select 'a$b', x from c.d.t$partitions -- e$f") == "select 'a$b', x from c.d.`t$partitions` -- e$f"


def test_other_relations_stay(spark):
    asked = []
    assert run(spark, "select id from range(3) where id in (select * from values (1), (2))", lambda parts: asked.append(parts), None).count() == 2
    assert asked == []
