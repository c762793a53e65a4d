import pytest
from pyspark.sql import functions as F

from tableport.operators import constraints as con
from tableport.plans import dictionary as dd, inventory as inv
from tableport.session import small_frame


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_primary_and_unique_keys(spark):
    df = small_frame(spark, [(1, "a"), (1, "a"), (2, None), (None, None), (None, None), (3, "b")], "k int, v string")
    assert rows(con.key_violations(df, ["k", "v"])) == rows(
        small_frame(spark, [(1, "a", 2), (2, None, 1), (None, None, 2)], "k int, v string, n bigint"))
    # NULLs compare equal for UNIQUE: one is allowed, two are not
    assert rows(con.key_violations(df, ["k", "v"], primary=False)) == rows(
        small_frame(spark, [(1, "a", 2), (None, None, 2)], "k int, v string, n bigint"))


def test_foreign_key_null_rule_and_composite(spark):
    child = small_frame(spark, [(1, 1), (1, 2), (1, None), (None, 9), (9, 9), (9, 9)], "a int, b int")
    parent = small_frame(spark, [(1, 1), (2, 2)], "x int, y int")
    assert rows(con.orphan_keys(child, ("a", "b"), parent, ("x", "y"))) == [(1, 2, 1), (9, 9, 2)]
    assert rows(con.orphan_keys(parent, ("x",), parent, ("x",))) == []


def test_hot_foreign_key_is_counted_whole(spark):
    child = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    parent = spark.range(0, 9000, 2).select(F.col("id").alias("p"))
    found = {r["k"]: r["child_rows"] for r in con.orphan_keys(child, ("k",), parent, ("p",)).collect()}
    assert found[-1] == 3000 and sum(found.values()) == 3000 + sum(1 for i in range(9000) if i % 3 and i % 2)


def test_checks_pass_on_unknown(spark):
    df = small_frame(spark, [(1,), (-1,), (None,)], "v int")
    assert rows(con.check_violations(df, "v > 0")) == [(-1,)]
    assert rows(con.check_counts(df, {"p": "v > 0", "n": "v < 0", "t": "v IS NOT NULL"})) == [("n", 1), ("p", 1), ("t", 1)]


def test_finite_guard(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "v double")
    assert con.check_counts(df, {"f": con.finite_condition("v")}).first()["violations"] == 3


def test_report_order_and_skips(spark):
    t = small_frame(spark, [(1, 1), (1, None)], "k int, v int")
    c = con.Constraints(
        keys=(con.Key("t", ("k",), "pk"), con.Key("t", ("v",), "uq", primary=False)),
        foreign_keys=(con.ForeignKey("fk", "t", ("v",), "t", ("k",)), con.ForeignKey("fk_off", "t", ("v",), "t", ("k",), disabled=True)),
        checks=(con.Check("ck", "t", "v > 5"), con.Check("ck_old", "t", "v > 5", untrusted=True)),
        not_null={"t": ("v",)})
    got = [tuple(r) for r in con.constraint_report({"t": t}, c).orderBy("seq", "constraint_name").select(
        "kind", "constraint_name", "status", "violations").collect()]
    assert got == [
        ("PRIMARY KEY", "pk", "VIOLATED", 1), ("UNIQUE", "uq", "OK", 0), ("CHECK", "ck", "VIOLATED", 1),
        ("CHECK", "ck_old", "SKIPPED", None), ("NOT NULL", "v", "VIOLATED", 1), ("FOREIGN KEY", "fk", "OK", 0),
        ("FOREIGN KEY", "fk_off", "SKIPPED", None)]
    with pytest.raises(ValueError):
        con.constraint_report({"t": t}, con.Constraints())


def test_retained(spark):
    edges = small_frame(spark, [("a", "b"), ("b", "c"), ("c", "a")], "child string, parent string")
    kept = small_frame(spark, [("a",), ("b",)], "name string")
    assert rows(con.retained(edges, kept)) == [("a", "b")]
    listed = small_frame(spark, [("a", 1), ("x", 2)], "table_name string, n int")
    assert rows(con.retained_constraints(listed, kept)) == [("a", 1)]


def test_computed_columns_keep_nulls(spark):
    df = small_frame(spark, [(2, 3), (None, 1)], "a int, b int")
    assert rows(con.with_computed(df, {"c": "a * b"})) == [(2, 3, 6), (None, 1, None)]


def test_plan_rules(spark):
    text = F.repeat(F.lit("x"), 9000)
    tables = {
        "unique_big": spark.range(100).select("id"),
        "heap": spark.range(100).select((F.col("id") % 7).alias("id")),
        "lob_heap": spark.range(100).select((F.col("id") % 7).alias("id"), text.alias("t")),
        "lob_keyed": spark.range(100).select("id", text.alias("t")),
        "small": spark.range(3).select("id"),
        "no_key": spark.range(100).select(F.col("id").cast("string").alias("s")),
        "null_key": spark.range(100).select(F.when(F.col("id") > 1, F.col("id")).alias("id")),
        "empty": spark.range(0).select("id"),
    }
    got = {r["table_name"]: (r["strategy"], r["chunks"], r["lob_range"]) for r in inv.plan_tables(tables, 4, 50).collect()}
    assert got == {
        "unique_big": ("range", 4, False), "heap": ("modulo", 4, False), "lob_heap": ("ntile", 4, True),
        "lob_keyed": ("range", 4, True), "small": ("single", 1, False), "no_key": ("single", 1, False),
        "null_key": ("single", 1, False), "empty": ("single", 1, False)}
    assert {r["strategy"] for r in inv.plan_tables(tables, 1, 0).collect()} == {"single"}
    order = [r["table_name"] for r in inv.export_order(inv.plan_tables(tables, 4, 50)).collect()]
    assert order[-2:] == ["no_key", "null_key"] and order[:2] == ["unique_big", "heap"]


def test_key_choice(spark):
    df = spark.range(50).select(
        (F.col("id") % 5).alias("small"), F.when(F.col("id") != 3, F.col("id")).alias("holes"),
        (F.col("id") * 1000).alias("sparse"), F.lit(1).cast("double").alias("not_int"))
    ranked = {r["column_name"]: (r["key_rank"], r["is_unique"]) for r in inv.key_profile({"t": df}).collect()}
    assert ranked == {"sparse": (1, True), "small": (2, False), "holes": (3, False)}


def test_largest_table(spark):
    listing = inv.inventory({"a": spark.range(0), "b": spark.range(5), "c": spark.range(5)})
    assert inv.largest_table(listing).first()["table_name"] == "b"
    assert inv.largest_table(inv.inventory({"x": spark.range(0), "y": spark.range(0)})).first()["table_name"] == "x"
    totals = inv.inventory_totals(listing, 4).first()
    assert tuple(totals) == (3, 1, 10, 2)
    assert [r[0] for r in inv.schema_names(listing).collect()] == ["main"]


def test_dictionary_joins(spark):
    c = con.Constraints(
        keys=(con.Key("t", ("a", "b"), "pk", descending=("b",)), con.Key("p", ("x",), "pk_p")),
        foreign_keys=(con.ForeignKey("fk", "t", ("a",), "p", ("x",), on_delete="SET_NULL"),),
        checks=(con.Check("ck", "t", "a > 0"), con.Check("other", "gone", "1 = 1")))
    tables = {"t": small_frame(spark, [(1, 2)], "a int, b int"), "p": small_frame(spark, [(1,)], "x int")}
    keys, fks = dd.key_columns(spark, c), dd.foreign_key_columns(spark, c)
    described = {(r["table_name"], r["column_name"]): (r["key_position"], r["referenced"])
                 for r in dd.describe(inv.dictionary(tables), keys, fks).collect()}
    assert described == {("t", "a"): (0, "p.x"), ("t", "b"): (1, None), ("p", "x"): (0, None)}
    listing = inv.inventory(tables)
    assert {r["table_name"]: r["key_columns"] for r in dd.key_listing(keys, listing).collect()} == {"t": "a ASC, b DESC", "p": "x ASC"}
    assert [r["table_name"] for r in dd.single_column_keys(keys).collect()] == ["p"]
    fk = dd.foreign_key_listing(fks).first()
    assert (fk["column_pairs"], fk["on_delete"], fk["on_update"]) == ("a=x", "SET NULL", "")
    assert [r["name"] for r in dd.check_listing(dd.check_rows(spark, c), listing).collect()] == ["ck"]
