import datetime as dt
import glob
import json
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from tableport.functions import types as ty
from tableport.operators import reconcile as rec
from tableport.operators.constraints import Constraints, ForeignKey, Key
from tableport.plans.chunking import ChunkPlan, modulo_plan
from tableport.plans.export import export_tables
from tableport.plans.restore import restore_tables
from tableport.session import shared_dir, small_frame
from tableport.sources import bundle as bd, targets
from tableport.sources.targets import CatalogTarget, PathTarget

ALL_TYPES = T.StructType([
    ty.field("i", "int"), ty.field("bi", "bigint"), ty.field("si", "smallint"), ty.field("ti", "tinyint"),
    ty.field("b", "bit"), ty.field("f", "float"), ty.field("r", "real"),
    ty.field("d", "decimal", precision=38, scale=10), ty.field("nvc", "nvarchar"), ty.field("bin", "varbinary"),
    ty.field("dt", "datetime2"), ty.field("g", "uniqueidentifier"), ty.field("dte", "date"), ty.field("tm", "time"),
])
ROWS = [
    (-2**31, -2**63, -2**15, 0, False, -1.7976931348623157e308, -1.5, Decimal("-9999999999999999999999999999.9999999999"),
     "", b"", dt.datetime(1, 1, 1, tzinfo=dt.timezone.utc), bytes(16), dt.date(1, 1, 1), 0),
    (None,) * 14,
    (2**31 - 1, 2**63 - 1, 2**15 - 1, 255, True, 5e-324, 1.5, Decimal("9999999999999999999999999999.9999999999"),
     "nul\0 bom﻿ \U0010ffff ' \r\n", bytes(range(256)), dt.datetime(9999, 12, 31, 23, 59, 59, 999999, tzinfo=dt.timezone.utc),
     bytes(range(16)), dt.date(9999, 12, 31), 86_399_999_999),
]


def same_bag(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture
def tables(spark):
    big = spark.range(1000).select(
        (F.col("id") % 50 - 10).alias("k"), "id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    return {"all_types": spark.createDataFrame(ROWS, ALL_TYPES), "big": big,
            "empty": spark.createDataFrame([], "a int, b string")}


def edit_manifest(root, change):
    path = f"{root}/manifest.json"
    doc = json.load(open(path))
    change(doc)
    import os
    os.unlink(path)
    crc = f"{root}/.manifest.json.crc"
    if os.path.exists(crc):
        os.unlink(crc)
    json.dump(doc, open(path, "w"))


@pytest.mark.parametrize("layout", ["scan", "key"])
def test_roundtrip(spark, tables, tmp_path, layout):
    cuts = {"chunks": 4, "chunk_threshold": 100} if layout == "key" else {}
    stats = export_tables(spark, tables, f"{tmp_path}/b", layout=layout, validate=True, **cuts)
    parts = {r["table_fqn"]: 0 for r in stats.collect()}
    for r in stats.collect():
        parts[r["table_fqn"]] += 1
    assert parts["[main].[big]"] == (4 if layout == "key" else 1)
    target = PathTarget(f"{tmp_path}/t")
    done = {r[0]: (r[1], r[2]) for r in restore_tables(spark, f"{tmp_path}/b", target).collect()}
    assert done == {"[main].[all_types]": (3, 3), "[main].[big]": (1000, 1000), "[main].[empty]": (0, 0)}
    for name, df in tables.items():
        back = target.read(spark, f"[main].[{name}]")
        assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
        assert same_bag(back, df)
    assert target.read(spark, "[main].[all_types]").schema["ti"].metadata["sql_type"] == "tinyint"


@pytest.mark.parametrize("layout", ["scan", "key"])
def test_columns_named_like_the_export_s_own(spark, tmp_path, layout):
    df = spark.range(1000).select("id", F.lit(7).alias("_part"), F.lit("x").alias("_PART_"), F.col("id").alias("a`b"), F.col("id").alias("part"))
    cuts = {"chunks": 4, "chunk_threshold": 100} if layout == "key" else {}
    export_tables(spark, {"t": df}, f"{tmp_path}/b", layout=layout, validate=True, **cuts)
    target = PathTarget(f"{tmp_path}/t")
    restore_tables(spark, f"{tmp_path}/b", target)
    assert same_bag(target.read(spark, "[main].[t]", df.schema), df)


def test_cuts_need_the_key_layout(spark, tables, tmp_path):
    for cuts in ({"chunks": 8}, {"chunk_threshold": 10}):
        with pytest.raises(ValueError, match="key layout"):
            export_tables(spark, tables, f"{tmp_path}/b", **cuts)


def test_two_schemas_and_an_excluded_parent(spark, tmp_path):
    from tableport.operators.constraints import Constraints, ForeignKey, Key

    a, b, p = spark.range(5), spark.range(7), spark.range(2)
    export_tables(spark, {"t": a, ("old", "t"): b, "p": p}, f"{tmp_path}/b", exclude=["p"], validate=True)
    rules = Constraints((Key("main.t", ("id",)), Key("p", ("id",))), (ForeignKey("f", "main.t", ("id",), "p", ("id",)),))
    done = {r[0]: r[2] for r in restore_tables(spark, f"{tmp_path}/b", PathTarget(f"{tmp_path}/t"), constraints=rules).collect()}
    assert done == {"[main].[t]": 5, "[old].[t]": 7}
    broken = Constraints(foreign_keys=(ForeignKey("f1", "old.t", ("id",), "main.t", ("id",)), ForeignKey("f2", "main.t", ("id",), "old.t", ("id",))))
    with pytest.raises(ValueError, match="f1: 2 violation"):
        restore_tables(spark, f"{tmp_path}/b", PathTarget(f"{tmp_path}/t2"), constraints=broken)


def test_parents_load_first_and_computed_columns_are_rebuilt(spark, tmp_path):
    from tableport.operators.constraints import Constraints, ForeignKey
    from tableport.plans.restore import load_rounds

    assert load_rounds("abcdz", [("a", "b"), ("b", "c"), ("c", "c"), ("d", "a"), ("z", "d")]) == [["c"], ["b"], ["a"], ["d"], ["z"]]
    assert load_rounds("abc", [("a", "b"), ("b", "a")]) == [["c"], ["a", "b"]]
    export_tables(spark, {"child": spark.range(6), "parent": spark.range(9)}, f"{tmp_path}/b")
    order = []

    class Watched(PathTarget):
        def append(self, df, fqn):
            order.append(fqn)
            super().append(df, fqn)

    target = Watched(f"{tmp_path}/t")
    restore_tables(spark, f"{tmp_path}/b", target, parents_first=True, computed={"child": {"twice": "id * 2"}},
                   constraints=Constraints(foreign_keys=(ForeignKey("f", "child", ("id",), "parent", ("id",)),)))
    assert order == ["[main].[parent]", "[main].[child]"]
    assert target.read(spark, "[main].[child]").agg(F.sum("twice")).first()[0] == 30


def test_plan_of_tables_with_declared_keys_reads_no_text(spark, lineitem_path, monkeypatch):
    from tableport.operators.constraints import Key
    from tableport.plans import inventory as inv

    asked = []
    profile = inv.column_profile
    monkeypatch.setattr(inv, "column_profile", lambda tables, only: asked.append(profile(tables, only)) or asked[-1])
    orders = spark.read.parquet(lineitem_path.replace("lineitem", "orders"))
    plan = inv.plan_tables({"orders": orders}, 8, 10, (Key("orders", ("o_orderkey",)),), lean=True).first()
    assert (plan["chunk_key"], plan["strategy"], len(asked)) == ("o_orderkey", "range", 1)
    text = asked[0]._jdf.queryExecution().executedPlan().toString()
    assert "o_orderkey" in text and "o_orderstatus" not in text and "o_orderpriority" not in text


def test_key_parts_match_the_plan(spark, tables, tmp_path):
    plan = ChunkPlan("range", "k", ((-10, 9), (10, 39)))
    export_tables(spark, tables, f"{tmp_path}/b", plans={"big": plan})
    opened = bd.open_bundle(spark, f"{tmp_path}/b")
    first, second = opened.parts()["[main].[big]"]
    assert opened.read("[main].[big]", [first]).filter("k >= 10").count() == 0
    assert opened.read("[main].[big]", [second]).filter("k < 10").count() == 0


def test_hot_part_is_kept_whole(spark, tmp_path):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    export_tables(spark, {"hot": hot}, f"{tmp_path}/b", plans={"hot": modulo_plan("k", 4)}, validate=True)
    assert same_bag(bd.open_bundle(spark, f"{tmp_path}/b").read("[main].[hot]"), hot)


def test_sink_options(spark, tmp_path):
    df = spark.range(25_000).coalesce(1)
    export_tables(spark, {"t": df}, f"{tmp_path}/b", level=99, rows_per_group=1000)
    file, = glob.glob(f"{tmp_path}/b/data/main.t/_part=0/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups == 25 and meta.row_group(0).num_rows == 1000
    assert meta.row_group(0).column(0).compression == "ZSTD"


def test_large_values(spark, tmp_path):
    df = spark.range(1).select(F.repeat(F.lit("xé"), 2_000_000).alias("t"), F.encode(F.repeat(F.lit("b"), 4_194_304), "UTF-8").alias("b"))
    export_tables(spark, {"lob": df}, f"{tmp_path}/b")
    assert same_bag(bd.open_bundle(spark, f"{tmp_path}/b").read("[main].[lob]"), df)


def test_schema_only_and_exclude(spark, tables, tmp_path):
    export_tables(spark, tables, f"{tmp_path}/b", schema_only=True, exclude=["emp*", "main.al*"])
    opened = bd.open_bundle(spark, f"{tmp_path}/b")
    assert [tuple(r) for r in opened.tables.select("table_fqn", "row_count").collect()] == [("[main].[big]", 0)]
    restore_tables(spark, f"{tmp_path}/b", PathTarget(f"{tmp_path}/t"))
    assert PathTarget(f"{tmp_path}/t").read(spark, "[main].[big]").count() == 0


def test_export_refusals(spark, tables, tmp_path):
    export_tables(spark, {"big": tables["big"]}, f"{tmp_path}/b")
    with pytest.raises(FileExistsError):
        export_tables(spark, tables, f"{tmp_path}/b")
    with pytest.raises(ValueError, match="share the file stem"):
        export_tables(spark, {"b.c": tables["big"], "b_c": tables["big"]}, f"{tmp_path}/c")
    with pytest.raises(ValueError, match="glob"):
        export_tables(spark, tables, f"{tmp_path}/d", exclude=["a[b"])
    with pytest.raises(ValueError, match="no tables"):
        export_tables(spark, tables, f"{tmp_path}/e", exclude=["*"])


def test_failed_export_leaves_no_manifest(spark, tables, tmp_path):
    bad = tables["big"].withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        export_tables(spark, {"ok": tables["big"], "bad": bad}, f"{tmp_path}/b")
    with pytest.raises(FileNotFoundError, match="not a complete bundle"):
        bd.open_bundle(spark, f"{tmp_path}/b")


def test_identity_and_generated_columns(spark, tmp_path):
    schema = T.StructType([ty.field("id", "int", False, identity=True, seed=1, increment=1), ty.field("v", "rowversion"),
                           ty.field("x", "nvarchar", default="'none'")])
    df = spark.createDataFrame([(1, b"\0" * 8, None), (5, b"\1" * 8, "a"), (900, b"\2" * 8, "b")], schema)
    export_tables(spark, {"t": df}, f"{tmp_path}/b")
    entry = bd.open_bundle(spark, f"{tmp_path}/b").tables.first()
    assert entry["has_identity"] and entry["identity_columns"] == ["id"]
    restore_tables(spark, f"{tmp_path}/b", PathTarget(f"{tmp_path}/t"))
    back = PathTarget(f"{tmp_path}/t").read(spark, "[main].[t]")
    # identity gaps stay, the generated column is left to the target, a NULL does not become the default
    assert [tuple(r) for r in back.orderBy("id").collect()] == [(1, None), (5, "a"), (900, "b")]


def change_table(**values):
    return lambda doc: doc["tables"][0].update(values)


@pytest.mark.parametrize("change, message", [
    (lambda d: d.update(format_version=3), "unsupported format version"),
    (lambda d: d.update(format_version=0), "unsupported format version"),
    (lambda d: d.update(total_rows=7), "total differs"),
    (lambda d: d.pop("total_rows"), "no total"),
    (change_table(table_fqn="[dbo].[t]; DROP TABLE x"), "invalid table name"),
    (change_table(row_count=-1000), "negative row count"),
    (lambda d: d["tables"][0].pop("row_count"), "no row count"),
    (change_table(row_count="many"), "."),
    (change_table(row_count=2**63), "."),
    (change_table(file_names=[]), "rows but no parts"),
    (lambda d: (d["tables"].append(d["tables"][0]), d.update(total_rows=2000)), "more than once"),
    (lambda d: (d["tables"][0].update(row_count=999), d.update(total_rows=999)), "1000 of 999 rows"),
    (change_table(file_names=["data/main.big/_part=0", "data/main.big/_part=9"]), r"1 part\(s\) missing"),
])
def test_restore_refuses_a_bad_manifest(spark, tables, tmp_path, change, message):
    export_tables(spark, {"big": tables["big"]}, f"{tmp_path}/b")
    edit_manifest(f"{tmp_path}/b", change)
    with pytest.raises(Exception, match=message):
        restore_tables(spark, f"{tmp_path}/b", PathTarget(f"{tmp_path}/t"))
    assert not glob.glob(f"{tmp_path}/t/*")


def test_older_manifest_with_one_file(spark, tables, tmp_path):
    export_tables(spark, {"big": tables["big"]}, f"{tmp_path}/b")

    def older(doc):
        entry = doc["tables"][0]
        entry["file_name"] = entry.pop("file_names")[0]
        doc["format_version"] = 1
    edit_manifest(f"{tmp_path}/b", older)
    assert restore_tables(spark, f"{tmp_path}/b", PathTarget(f"{tmp_path}/t")).first()["restored_rows"] == 1000


def test_part_resolution(spark):
    rows = [("a", ["n1", "n2"], "old"), ("b", [], "old"), ("c", None, "old"), ("d", None, None), ("e", [], "")]
    tables = small_frame(spark, [(rows_to_tables(rows),)],
                         "tables array<struct<table_fqn: string, file_names: array<string>, file_name: string, "
                         "row_count: bigint, has_identity: boolean, identity_columns: array<string>>>")
    got = {r["table_fqn"]: r["parts"] for r in bd.manifest_tables(tables).collect()}
    assert got == {"a": ["n1", "n2"], "b": ["old"], "c": ["old"], "d": [], "e": []}


def rows_to_tables(rows):
    return [{"table_fqn": a, "file_names": b, "file_name": c, "row_count": 0} for a, b, c in rows]


def test_data_only_and_replace(spark, tables, tmp_path):
    export_tables(spark, {"big": tables["big"]}, f"{tmp_path}/b")
    target = PathTarget(f"{tmp_path}/t")
    with pytest.raises(ValueError, match="to exist"):
        restore_tables(spark, f"{tmp_path}/b", target, data_only=True)
    restore_tables(spark, f"{tmp_path}/b", target)
    with pytest.raises(FileExistsError):
        restore_tables(spark, f"{tmp_path}/b", target)
    assert restore_tables(spark, f"{tmp_path}/b", target, data_only=True).first()["restored_rows"] == 1000
    assert target.read(spark, "[main].[big]").count() == 2000
    restore_tables(spark, f"{tmp_path}/b", target, replace=True)
    assert target.read(spark, "[main].[big]").count() == 1000
    other = PathTarget(f"{tmp_path}/u")
    tables["big"].withColumnRenamed("v", "w").write.parquet(other.location("[main].[big]"))
    with pytest.raises(ValueError, match="columns differ"):
        restore_tables(spark, f"{tmp_path}/b", other, data_only=True)


def test_a_failed_restore_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    root, path = tmp_path / "restored", str(tmp_path / "bundle")
    old = {"a": spark.range(3), "b": spark.range(4)}
    target = PathTarget(str(root))
    for name, df in old.items():
        target.append(df, f"[main].[{name}]")
    export_tables(spark, {"a": spark.range(10), "b": spark.range(5).selectExpr("id % 2 AS id")}, path)

    def untouched():
        assert {n: target.read(spark, f"[main].[{n}]").count() for n in old} == {"a": 3, "b": 4}

    with pytest.raises(ValueError, match="violation"):
        restore_tables(spark, path, target, replace=True, constraints=Constraints(keys=(Key("b", ("id",)),)))
    untouched()
    append = PathTarget.append

    def broken(self, df, fqn):
        if fqn.endswith("[b]"):
            raise IOError("disk is gone")
        append(self, df, fqn)

    with monkeypatch.context() as patch:
        patch.setattr(PathTarget, "append", broken)
        with pytest.raises(IOError, match="disk is gone"):
            restore_tables(spark, path, target, replace=True)
    untouched()
    assert len(list(root.iterdir())) == 2                # what was staged is gone
    move, calls = targets.move_path, []

    def stuck(session, source, place):
        calls.append(place)
        if len(calls) == 4:                              # the second table's rename, after its old one went aside
            raise IOError("rename refused")
        move(session, source, place)

    with monkeypatch.context() as patch:
        patch.setattr(targets, "move_path", stuck)
        with pytest.raises(IOError, match="rename refused"):
            restore_tables(spark, path, target, replace=True)
    untouched()
    restore_tables(spark, path, target, replace=True)
    assert {n: target.read(spark, f"[main].[{n}]").count() for n in old} == {"a": 10, "b": 5}


def test_catalog_target(spark, tables, tmp_path):
    export_tables(spark, tables, f"{tmp_path}/b")
    target = CatalogTarget("restored_db")
    for _ in range(2):
        restore_tables(spark, f"{tmp_path}/b", target, replace=True)
    assert spark.table("restored_db.big").count() == 1000 and spark.table("restored_db.empty").count() == 0
    with pytest.raises(ValueError, match="refusing"):
        restore_tables(spark, f"{tmp_path}/b", CatalogTarget("default"), replace=True)


def test_catalog_names_that_meet_are_refused(spark, tmp_path):
    one = spark.range(3)
    export_tables(spark, {("a", "b__c"): one, ("a__b", "c"): one}, f"{tmp_path}/b")
    with pytest.raises(ValueError, match="would both become"):
        restore_tables(spark, f"{tmp_path}/b", CatalogTarget("clash_db"), replace=True)
    assert not spark.catalog.databaseExists("clash_db")
    restore_tables(spark, f"{tmp_path}/b", PathTarget(f"{tmp_path}/r"))


def test_declared_keys_spare_an_export_the_look_for_unique_columns(spark, tmp_path, monkeypatch):
    from tableport.plans import inventory

    looked = []
    real = inventory.key_profile
    monkeypatch.setattr(inventory, "key_profile", lambda tables, profile: looked.append(sorted(tables)) or real(tables, profile))
    rows = spark.range(1000).selectExpr("id % 7 AS group_id", "id AS number", "'x' AS v")
    keys = Constraints(keys=(Key("rows", ("number",)), Key("other.rows", ("group_id", "number")), Key("gone", ("x",))))
    source = {"rows": rows, ("other", "rows"): rows}
    with pytest.raises(ValueError, match="key layout"):
        export_tables(spark, source, f"{tmp_path}/x", chunks=4, constraints=keys)
    plain = export_tables(spark, source, f"{tmp_path}/a", layout="key", chunks=4, chunk_threshold=10)
    assert looked == [["[main].[rows]", "[other].[rows]"]]
    looked.clear()
    only = Constraints(keys=(Key("main.rows", ("number",)), Key("other.rows", ("number",))))
    declared = export_tables(spark, source, f"{tmp_path}/b", layout="key", chunks=4, chunk_threshold=10, constraints=only)
    assert looked == [] and sorted(map(tuple, declared.drop("path").collect())) == sorted(map(tuple, plain.drop("path").collect()))
    export_tables(spark, {"rows": rows}, f"{tmp_path}/c", layout="key", chunks=4, chunk_threshold=10, constraints=keys)
    assert looked == []


def test_a_key_layout_shuffles_only_where_files_would_be_small(spark, tmp_path):
    """Tasks that hold enough rows of each part write them as they are, with all parts open and no sort."""
    rows = spark.range(0, 16_000, 1, 4).selectExpr("id % 4000 AS k", "id AS v")
    files = {}
    for group in (1000, 100_000):
        out = f"{tmp_path}/{group}"
        plans = {"t": ChunkPlan("modulo", "k", divisor=4)}
        stats = export_tables(spark, {"t": rows}, out, layout="key", plans=plans, rows_per_group=group, validate=True)
        assert sorted((r["part"], r["rows"]) for r in stats.collect()) == [(i, 4000) for i in range(4)]
        files[group] = glob.glob(f"{out}/data/main.t/_part=*/*.parquet")
        assert spark.read.parquet(out + "/data/main.t").exceptAll(rows.withColumn("_part", F.abs(F.col("k") % 4).cast("int"))).count() == 0
    assert len(files[1000]) == 16 and len(files[100_000]) < 16
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) in (None, "0")


def test_constraints_follow_the_data(spark, tmp_path):
    parent = small_frame(spark, [(1,), (2,)], "id int")
    child = small_frame(spark, [(1, 1), (2, 3), (3, None)], "id int, parent_id int")
    export_tables(spark, {"parent": parent, "child": child}, f"{tmp_path}/b")
    fk = ForeignKey("fk", "child", ("parent_id",), "parent", ("id",))
    with pytest.raises(ValueError, match=r"fk: 1 violation"):
        restore_tables(spark, f"{tmp_path}/b", PathTarget(f"{tmp_path}/t"), constraints=Constraints(foreign_keys=(fk,)))
    restore_tables(spark, f"{tmp_path}/b", PathTarget(f"{tmp_path}/u"), constraints=Constraints(keys=(Key("child", ("id",)),)))


def test_reconcile_statuses(spark):
    a = small_frame(spark, [("t1", 5), ("t2", 6), ("t3", 7)], "t string, row_count bigint")
    b = small_frame(spark, [("t1", 5), ("t2", 9), ("t4", 1)], "t string, row_count bigint")
    report = rec.reconcile(a, b, "t")
    assert {r["t"]: r["status"] for r in report.collect()} == {
        "t1": "OK", "t2": "MISMATCH", "t3": "MISSING_IN_LIVE", "t4": "MISSING_IN_ARCHIVE"}
    with pytest.raises(ValueError, match=r"3 table\(s\)"):
        rec.assert_reconciled(report)
    rec.assert_reconciled(rec.reconcile(a, a, "t"))
    assert [r["t"] for r in rec.missing_results(a, b, "t").collect()] == ["t3"]


def test_fingerprints_see_any_difference(spark):
    base = small_frame(spark, [(1, "a"), (2, None), (2, None)], "k int, v string")
    moved_null = small_frame(spark, [(1, "a"), (None, "2"), (2, None)], "k int, v string")
    fewer = small_frame(spark, [(1, "a"), (2, None)], "k int, v string")
    once = lambda df: tuple(rec.fingerprints({"t": df}).first())
    assert once(base) == once(base.repartition(3).orderBy(F.desc("k")))
    assert len({once(base), once(moved_null), once(fewer)}) == 3


def test_scratch_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == shared_dir(spark)


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Conf:
        value = None

        def get(self, key, default):
            return self.value or default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
    Conf.value = "hdfs://shared/dir/"
    assert shared_dir(Session()) == "hdfs://shared/dir"
