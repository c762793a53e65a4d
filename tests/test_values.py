import datetime as dt
import random
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as hs
from pyspark.sql import functions as F, types as T

from tableport.functions import literals as lit, names, types as ty
from tableport.functions.metrics import latest_average, parse_metrics
from tableport.functions.text import snippet, statement_text
from tableport.operators.reconcile import stem_collisions
from tableport.plans.inventory import exclude, excluded_names, sample
from tableport.session import small_frame


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


@pytest.mark.parametrize("sql_type, expected", [
    ("BigInt", "bigint"), ("int", "int"), ("smallint", "smallint"), ("tinyint", "smallint"), ("bit", "boolean"),
    ("float", "double"), ("real", "float"), ("money", "decimal(19,4)"), ("smallmoney", "decimal(10,4)"),
    ("nvarchar", "string"), ("text", "string"), ("image", "binary"), ("rowversion", "binary"),
    ("datetime2", "timestamp"), ("datetimeoffset", "timestamp"), ("date", "date"), ("time", "bigint"),
    ("uniqueidentifier", "binary"), ("xml", "string"), ("hierarchyid", "string"), ("geometry", "binary"),
    ("something_new", "string"),
])
def test_spark_type(sql_type, expected):
    assert ty.spark_type(sql_type).simpleString() == expected


def test_build_schema_keeps_order_nullability_and_precision():
    schema = ty.build_schema([
        {"name": "id", "sql_type": "int", "nullable": False, "identity": True},
        {"name": "d", "sql_type": "decimal", "precision": 38, "scale": 38},
        {"name": "v", "sql_type": "rowversion"}])
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [
        ("id", "int", False), ("d", "decimal(38,38)", True), ("v", "binary", True)]
    assert schema["v"].metadata["generated"] and schema["id"].metadata["identity"]


def test_normalise_is_strict_and_names_the_column(spark):
    schema = T.StructType([ty.field("a", "int"), ty.field("b", "tinyint")])
    good = small_frame(spark, [("1", "255"), (None, None)], "a string, b string")
    assert [tuple(r) for r in ty.normalise(good, schema).collect()] == [(1, 255), (None, None)]
    for row, column in ((("x", "1"), "column a"), (("1", "256"), "column b"), (("1", "-1"), "column b")):
        bad = small_frame(spark, [row], "a string, b string")
        with pytest.raises(Exception, match=column):
            ty.normalise(bad, schema).collect()
    with pytest.raises(ValueError, match="'b'"):
        ty.normalise(good.drop("b"), schema)


def test_normalise_overflow_is_an_error(spark):
    df = spark.range(1).select(F.lit(12345).alias("m"))
    with pytest.raises(Exception):
        ty.normalise(df, T.StructType([ty.field("m", "decimal", precision=4, scale=2)])).collect()


def test_timestamps_are_utc_instants(spark):
    text = small_frame(spark, [("2024-03-01T12:00:00.1234567+02:00",), ("1969-12-31T23:59:58.500000Z",)], "t string")
    out = ty.normalise(text, T.StructType([ty.field("t", "datetimeoffset")]))
    micros = sorted(r[0] for r in out.select(F.unix_micros("t")).collect())
    assert micros == [-1_500_000, 1_709_287_200_123_456]


def test_guid_keeps_text_order(spark):
    import uuid

    for seed in range(5):
        value = uuid.UUID(int=random.Random(seed).getrandbits(128))
        assert one(spark, F.hex(ty.guid_bytes(F.lit(str(value))))) == value.hex.upper()
        assert one(spark, ty.guid_text(ty.guid_bytes(F.lit(str(value))))) == str(value)
    for bad in ("1234", "", str(value) + "00"):
        assert one(spark, ty.guid_bytes(F.lit(bad))) is None
        with pytest.raises(Exception, match="column g"):
            ty.normalise(spark.createDataFrame([(bad,)], "g string"), T.StructType([ty.field("g", "uniqueidentifier")])).collect()
    assert one(spark, ty.guid_text(F.unhex(F.lit("0102")))) is None


def test_time_of_day_is_read_in_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.range(1).select(F.timestamp_micros(F.lit(5_000_001)).alias("t"))
        assert ty.normalise(df, T.StructType([ty.field("t", "time")])).first()[0] == 5_000_001
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_strict_casts_name_the_column_for_every_source(spark):
    cases = [(5_000_000_000, "bigint", "int"), (1e300, "double", "bigint"), (40_000, "int", "smallint"), (Decimal("99999.5"), "decimal(10,1)", "smallint")]
    for value, source, target in cases:
        df = spark.createDataFrame([(value,)], f"`odd``name` {source}")
        with pytest.raises(Exception, match="column odd"):
            ty.normalise(df, T.StructType([ty.field("odd`name", target)])).collect()


def test_small_frame_refuses_values_of_another_type(spark):
    with pytest.raises(Exception):
        small_frame(spark, [("x",)], "a int").collect()


def test_declared_length(spark):
    rows = [("nvarchar", 100, None, None, "nvarchar(50)"), ("varchar", -1, None, None, "varchar(MAX)"),
            ("varbinary", 16, None, None, "varbinary(16)"), ("decimal", 9, 18, 4, "decimal(18,4)"),
            ("time", 5, 0, 0, "time(0)"), ("int", 4, 10, 0, "int"), ("char", 3, None, None, "char(3)")]
    df = small_frame(spark, rows, "t string, n int, p int, s int, want string")
    got = df.select(ty.declared_length(F.col("t"), F.col("n"), F.col("p"), F.col("s")).alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in got)


@pytest.mark.parametrize("value, dtype, expected", [
    (True, "boolean", "1"), (False, "boolean", "0"), (None, "boolean", "NULL"), (-128, "smallint", "-128"),
    ((1 << 63) - 1, "bigint", "9223372036854775807"), (Decimal("-0.05"), "decimal(4,2)", "-0.05"),
    (Decimal("0E-10"), "decimal(38,10)", "0.0000000000"), (Decimal("5"), "decimal(38,0)", "5"),
    ("a'b'", "string", "N'a''b'''"), (" ", "string", "N' '"), (None, "string", "NULL"),
    (bytes(range(3, 9)), "binary", "0x030405060708"), (b"\x00", "binary", "0x00"),
    (dt.date(1, 1, 1), "date", "'0001-01-01'"), (dt.date(9999, 12, 31), "date", "'9999-12-31'"),
    (dt.datetime(1931, 2, 3, 4, 5, 6, 70), "timestamp_ntz", "'1931-02-03T04:05:06.000070Z'"),
])
def test_literals(spark, value, dtype, expected):
    df = spark.createDataFrame([(value,)], f"c {dtype}")
    assert df.select(lit.sql_literal(F.col("c"), df.schema["c"].dataType)).first()[0] == expected


def test_time_literals(spark):
    render = lambda n: one(spark, lit.sql_literal(F.lit(n).cast("bigint"), T.LongType(), True))
    rng = random.Random(13)
    for micros in [0, 86_399_999_999, *(rng.randrange(86_400_000_000) for _ in range(6))]:
        assert render(micros) == (dt.datetime(2000, 1, 1) + dt.timedelta(microseconds=micros)).strftime("'%H:%M:%S.%f'")
    for bad in (-1, 86_400_000_000):
        with pytest.raises(Exception, match="time of day"):
            render(bad)


def test_unrepresentable_literals(spark):
    for bad in (float("nan"), float("inf"), float("-inf")):
        with pytest.raises(Exception, match="non-finite"):
            one(spark, lit.sql_literal(F.lit(bad), T.DoubleType()))
    with pytest.raises(TypeError, match="array"):
        lit.sql_literal(F.lit(1), T.ArrayType(T.IntegerType()))


def test_float_text_has_no_exponent_and_reads_back(spark):
    values = [0.0, -0.0, 1.0, -1.5, 1e7, 1.23456789e15, 1e22, 1.7976931348623157e308, 5e-324, 1e-3, 9.99e-5, -3.25e-9, 123456.789]

    @settings(max_examples=20, deadline=None)
    @given(hs.lists(hs.floats(allow_nan=False, allow_infinity=False), min_size=20, max_size=60))
    def check(drawn):
        df = spark.createDataFrame([(v,) for v in values + drawn], "v double")
        for r in df.select("v", lit.float_text(F.col("v")).alias("t")).collect():
            assert "E" not in r["t"] and float(r["t"]) == r["v"], r
            assert not r["t"].endswith(".0")

    check()


def test_row_tuple(spark):
    df = spark.createDataFrame([(1, None, "a'b")], "a int, b string, `c d` string")
    assert df.select(lit.row_tuple(df)).first()[0] == "(1, NULL, N'a''b')"


def test_names(spark):
    assert one(spark, names.qualified_name(F.lit("a]b"), F.lit("c"))) == "[a]]b].[c]"
    assert one(spark, names.file_stem(F.lit("[dbo].[Orders]"))) == "dbo_Orders"
    assert one(spark, names.part_path(F.lit("[dbo].[Orders]"), F.lit(3))) == "data/dbo_Orders.part3.parquet"


def test_fqn_validity(spark):
    rng, alphabet = random.Random(14), "ab Z_9-$.é'\""
    word = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 6)))
    good = [f"[{word()}].[{word()}]" for _ in range(20)]
    spoiled = [f(g) for g in good[:6] for f in (
        lambda g: g[1:], lambda g: g[:-1], lambda g: g + g, lambda g: g + "\n", lambda g: g + "--", lambda g: g.replace("].[", "][", 1),
        lambda g: "[]" + g[g.index("]") + 1:], lambda g: g[:-1] + "]]", lambda g: g.replace("[", "[\x07", 1))]
    df = small_frame(spark, [(g,) for g in good + spoiled], "f string")
    assert [r[0] for r in df.filter(names.is_valid_fqn("f")).collect()] == good


def test_stem_collisions_and_folders(spark):
    listed = ["[a_b].[c]", "[a].[b_c]", "[x].[y]", "[x].[y]"]
    found = stem_collisions(small_frame(spark, [(f,) for f in listed], "table_fqn string")).collect()
    assert [tuple(r) for r in found] == [("a_b_c", "[a].[b_c]", "[a_b].[c]", 2)]
    folders = {names.table_dir(f) for f in listed + ["[a].[b.c]", "[a.b].[c]", "[_h].[.x]", "[a/b].[c]", "[a~2Fb].[c]"]}
    assert len(folders) == 8 and not any("/" in f or f.startswith(("_", ".")) for f in folders)


def test_globs(spark):
    import fnmatch

    rng, pairs = random.Random(15), [("s1", "log_a"), ("s1", "alog"), ("s2", "log_b2"), ("s2", "LOG_a"), ("log", "s1"), ("s1", "x.y")]
    piece = lambda: rng.choice(["log", "_", "a", "s1", ".", "*", "?", "[ab]", "[!a-k]", "b2", "x", "y"])
    patterns = ["".join(piece() for _ in range(rng.randint(1, 4))) for _ in range(60)] + ["s2.*", "*", "log_?"]
    df = small_frame(spark, pairs, "schema_name string, table_name string")
    for pattern in patterns[:12] + patterns[-3:]:
        want = [p for p in pairs if not (fnmatch.fnmatchcase(p[1], pattern) or fnmatch.fnmatchcase(".".join(p), pattern))]
        assert [tuple(r) for r in exclude(df, [pattern]).collect()] == want
    for pattern in patterns:
        for schema, table in pairs:
            hit = fnmatch.fnmatchcase(table, pattern) or fnmatch.fnmatchcase(f"{schema}.{table}", pattern)
            assert excluded_names([table], [pattern], schema) == ({table} if hit else set())


def test_bad_glob_is_an_error(spark):
    with pytest.raises(ValueError, match="glob"):
        names.glob_to_regex("a[b")


def test_database_guard():
    assert names.check_database_name("sales_1") == "sales_1"
    for bad in ("default", "master", "a b", "a;b", "", "x" * 129, "a`b"):
        with pytest.raises(ValueError):
            names.check_database_name(bad)


def test_statement_text(spark):
    raw = " \n SELECT a\r\nFROM t " + "x" * 400
    text = one(spark, statement_text(F.lit(raw)))
    assert text.startswith("SELECT a FROM t x") and len(text) <= 300 and "\n" not in text
    assert one(spark, snippet(F.lit("y" * 99))) == "y" * 55


def test_latest_average(spark):
    doc = ('{"value":[{"name":{"value":"cpu"},"timeseries":[{"data":[{"average":1},{"average":2.5},{"average":null},{}]},'
           '{"data":[{"average":9}]}]},{"name":{"value":"empty"},"timeseries":[]}]}')
    parsed = parse_metrics(F.lit(doc))
    assert one(spark, latest_average(parsed, "cpu")) == 2.5
    assert one(spark, latest_average(parsed, "empty")) == 0.0
    assert one(spark, latest_average(parsed, "absent")) == 0.0
    assert one(spark, latest_average(parse_metrics(F.lit("not json")), "cpu")) == 0.0


def test_sample(spark):
    df = spark.range(20).select(*[(F.col("id") + i).alias(f"C{i}") for i in range(7)])
    assert sample(df).columns == ["C0", "C1", "C2", "C3", "C4"]
    assert sample(df, "all").columns == df.columns and sample(df, "c6, c1").columns == ["C6", "C1"]
    assert sample(df, max_rows=3, key="C0", key_range=(5, 9)).count() == 3
    assert sample(df, key="C0", key_range=(5, 9)).count() == 5
    with pytest.raises(ValueError, match="nope"):
        sample(df, ["nope"])
    with pytest.raises(ValueError, match="chunk key"):
        sample(df, key_range=(1, 2))
