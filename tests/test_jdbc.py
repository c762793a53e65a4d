"""The SQL text sent to a database; no database is started, DuckDB reads the same text in process."""

import duckdb
import pytest
from pyspark.sql import types as T

from tableport.functions.types import field
from tableport.plans import chunking as ch, order_stats as os_
from tableport.session import small_frame
from tableport.sources.jdbc import JdbcDatabase, quoted_name
from tableport.sources.targets import JdbcTarget

KEYS = [None, -9, -9, -9, -9, 0, 1, 1, 2, 5, 8, 13, 21, 21, 21, 34]
FQN = '[main].[odd "name"]'


@pytest.fixture
def duck():
    con = duckdb.connect()
    con.sql(f'CREATE TABLE {quoted_name(FQN)} ("the ""key" BIGINT)')
    con.executemany(f"INSERT INTO {quoted_name(FQN)} VALUES (?)", [(k,) for k in KEYS])
    return con


@pytest.fixture
def database(duck, monkeypatch):
    monkeypatch.setattr(JdbcDatabase, "_query", lambda self, spark, sql: duck.sql(sql).fetchall())
    return JdbcDatabase("jdbc:none")


@pytest.mark.parametrize("strategy", ["range", "ntile", "modulo"])
def test_plans_equal_those_over_a_frame(spark, duck, database, strategy):
    key = 'the "key'
    df = small_frame(spark, [(k,) for k in KEYS], "k bigint")
    local = {"range": lambda: ch.range_plan(df, "k", 4), "ntile": lambda: ch.ntile_plan(df, "k", 4),
             "modulo": lambda: ch.modulo_plan("k", 4)}[strategy]()
    plan = database.plan(spark, FQN, strategy, key, 4)
    assert (plan.strategy, plan.ranges, plan.divisor) == (local.strategy, local.ranges, local.divisor)
    counts = [duck.sql(f"SELECT count(*) FROM {quoted_name(FQN)} WHERE {p}").fetchall()[0][0] for p in plan.predicates()]
    assert sum(counts) == len(KEYS)
    by_part = {r["part"]: r["rows"] for r in ch.part_counts(df, local).collect()}
    assert counts == [by_part.get(i, 0) for i in range(plan.parts)]


def test_single_plans(spark, duck, database):
    duck.sql(f"DELETE FROM {quoted_name(FQN)}")
    for strategy in ("range", "ntile", "single"):
        assert database.plan(spark, FQN, strategy, 'the "key', 4) == ch.SINGLE
    assert ch.SINGLE.predicates() == ["1 = 1"]


def test_names_cannot_break_out():
    assert quoted_name('[a"b].[c]') == '"a""b"."c"'
    with pytest.raises(ValueError):
        quoted_name("[a].[b]; DROP TABLE x")
    assert os_.bucket_sizes(10, 4) == [3, 3, 2, 2]


def test_existence_is_read_from_the_catalog(spark, duck, database):
    assert database.exists(spark, FQN)
    assert not database.exists(spark, "[main].[it's not there]") and not database.exists(spark, FQN.replace("main", "other"))


def test_failure_to_ask_is_an_error(spark, monkeypatch):
    def broken(self, spark, sql):
        raise ConnectionError("no route")

    monkeypatch.setattr(JdbcDatabase, "_query", broken)
    with pytest.raises(ConnectionError):
        JdbcTarget("jdbc:none").exists(spark, FQN)


def test_columns_a_source_casts_and_leaves_out(duck):
    schema = T.StructType([field('the "key', "bigint"), field("x", "xml"), field("r", "rowversion"), field("m", "money"),
                           field("h", "hierarchyid"), field("c", "int", computed=True), field("v", "int", hidden=True)])
    text = JdbcDatabase("jdbc:none").source_sql("[s].[t]", schema)
    assert text == ('(SELECT "the ""key", CAST("x" AS NVARCHAR(MAX)) AS "x", CAST("r" AS VARBINARY(8)) AS "r", '
                    'CAST("m" AS DECIMAL(19,4)) AS "m", "h".ToString() AS "h" FROM "s"."t") source')
    plain = T.StructType([field('the "key', "bigint")])
    assert len(duck.sql(f"SELECT * FROM {JdbcDatabase('jdbc:none').source_sql(FQN, plain)}").fetchall()) == len(KEYS)
