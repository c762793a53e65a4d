"""Keys, foreign keys and checks as data-quality jobs that return what violates them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import column
from ..plans.inventory import union_all
from ..session import small_frame

# The order constraints are applied in after a load.
KIND_ORDER = ("PRIMARY KEY", "UNIQUE", "CHECK", "NOT NULL", "FOREIGN KEY")


@dataclass(frozen=True)
class Key:
    """PRIMARY KEY, or UNIQUE when ``primary`` is False."""

    table: str
    columns: tuple[str, ...]
    name: str = ""
    primary: bool = True
    descending: tuple[str, ...] = ()


@dataclass(frozen=True)
class ForeignKey:
    name: str
    child: str
    child_cols: tuple[str, ...]
    parent: str
    parent_cols: tuple[str, ...]
    on_delete: str = "NO_ACTION"
    on_update: str = "NO_ACTION"
    disabled: bool = False
    untrusted: bool = False


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    condition: str
    disabled: bool = False
    untrusted: bool = False


@dataclass(frozen=True)
class Constraints:
    keys: tuple[Key, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    checks: tuple[Check, ...] = ()
    not_null: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def within(self, tables) -> Constraints:
        """Those whose tables are all among ``tables``."""
        return Constraints(
            tuple(k for k in self.keys if k.table in tables),
            tuple(f for f in self.foreign_keys if f.child in tables and f.parent in tables),
            tuple(c for c in self.checks if c.table in tables),
            {t: c for t, c in self.not_null.items() if t in tables})

    @property
    def empty(self) -> bool:
        return not (self.keys or self.foreign_keys or self.checks or self.not_null)


def _cols(names) -> list[Column]:
    return [column(n) for n in names]


def _any_null(names) -> Column:
    out = F.lit(False)
    for c in _cols(names):
        out = out | c.isNull()
    return out


def duplicate_keys(df: DataFrame, columns) -> DataFrame:
    """Key tuples held by more than one row, with their row count. NULLs compare equal."""
    return df.groupBy(*_cols(columns)).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def key_violations(df: DataFrame, columns, primary: bool = True) -> DataFrame:
    """Key tuples that break a PRIMARY KEY (repeated or with a NULL) or UNIQUE key (repeated)."""
    counted = df.groupBy(*_cols(columns)).agg(F.count(F.lit(1)).alias("copies"))
    bad = F.col("copies") > 1
    return counted.filter(bad | _any_null(columns) if primary else bad)


def orphan_keys(child: DataFrame, child_cols, parent: DataFrame, parent_cols) -> DataFrame:
    """Foreign-key tuples without a parent row, with the number of child rows holding them.

    A tuple with any NULL passes. Child rows are counted per tuple before the join, so a tuple that
    holds a third of the rows crosses the shuffle as a handful of partial counts; parent tuples are
    made distinct for the same reason. The anti join reuses both partitionings.
    """
    keys = [f"_k{i}" for i in range(len(child_cols))]
    held = (
        child.select(*[column(c).alias(k) for c, k in zip(child_cols, keys)])
        .dropna("any", subset=keys)
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("child_rows"))
    )
    known = parent.select(*[column(c).alias(k) for c, k in zip(parent_cols, keys)]).distinct()
    orphans = held.join(known, keys, "left_anti")
    return orphans.select(*[F.col(k).alias(c) for c, k in zip(child_cols, keys)], "child_rows")


def check_fails(condition: Column) -> Column:
    """True only where the condition is FALSE; UNKNOWN passes."""
    return ~F.coalesce(condition, F.lit(True))


def check_violations(df: DataFrame, condition: str) -> DataFrame:
    return df.filter(check_fails(F.expr(condition)))


def check_counts(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """Violations of many checks on one table in one pass: (constraint_name, violations)."""
    aggregated = df.agg(*[F.count_if(check_fails(F.expr(c))).alias(f"v{i}")
                          for i, c in enumerate(conditions.values())])
    cells = [F.struct(F.lit(name).alias("constraint_name"), F.col(f"v{i}").alias("violations"))
             for i, name in enumerate(conditions)]
    return aggregated.select(F.inline(F.array(*cells)))


def finite_condition(column: str) -> str:
    """CHECK text: the number is neither NaN nor infinite."""
    c = "`" + column.replace("`", "``") + "`"
    return f"NOT (isnan({c}) OR abs({c}) = double('Infinity'))"


def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """NULLs per column, all columns in one pass: (column_name, nulls)."""
    names = list(columns or df.columns)
    aggregated = df.agg(*[F.count_if(c.isNull()).alias(f"n{i}") for i, c in enumerate(_cols(names))])
    cells = [F.struct(F.lit(n).alias("column_name"), F.col(f"n{i}").alias("nulls"))
             for i, n in enumerate(names)]
    return aggregated.select(F.inline(F.array(*cells)))


def constraint_report(tables: Mapping[str, DataFrame], constraints: Constraints) -> DataFrame:
    """One row per constraint: kind, status (OK, VIOLATED, SKIPPED) and violations.

    Violations are key tuples for keys and rows for everything else. A disabled or untrusted
    constraint is not validated again. ``seq`` is the order constraints are applied in.
    """
    parts = []

    def labelled(kind: str, table: str, frame: DataFrame) -> DataFrame:
        return frame.select(
            F.lit(KIND_ORDER.index(kind)).alias("seq"), F.lit(kind).alias("kind"),
            F.lit(table).alias("table_name"), "constraint_name", F.col("violations").cast("bigint"))

    def total(frame: DataFrame, name: str, what: Column) -> DataFrame:
        return frame.agg(F.coalesce(what, F.lit(0)).alias("violations")).withColumn(
            "constraint_name", F.lit(name))

    skipped = []
    for key in constraints.keys:
        kind = "PRIMARY KEY" if key.primary else "UNIQUE"
        broken = key_violations(tables[key.table], key.columns, key.primary)
        parts.append(labelled(kind, key.table, total(
            broken, key.name or "_".join((key.table, *key.columns)), F.count(F.lit(1)))))
    active: dict[str, dict[str, str]] = {}
    for check in constraints.checks:
        if check.disabled or check.untrusted:
            skipped.append(("CHECK", check.table, check.name))
        else:
            active.setdefault(check.table, {})[check.name] = check.condition
    for table in {**active, **constraints.not_null}:
        # all row conditions of a table in one pass
        tests = [("CHECK", name, check_fails(F.expr(text))) for name, text in active.get(table, {}).items()]
        tests += [("NOT NULL", name, column(name).isNull()) for name in constraints.not_null.get(table, ())]
        counted = tables[table].agg(*[F.count_if(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(tests)])
        cells = [F.struct(F.lit(KIND_ORDER.index(kind)).alias("seq"), F.lit(kind).alias("kind"), F.lit(table).alias("table_name"),
                          F.lit(name).alias("constraint_name"), F.col(f"v{i}").cast("bigint").alias("violations"))
                 for i, (kind, name, _) in enumerate(tests)]
        parts.append(counted.select(F.inline(F.array(*cells))))
    for fk in constraints.foreign_keys:
        if fk.disabled or fk.untrusted:
            skipped.append(("FOREIGN KEY", fk.child, fk.name))
            continue
        orphans = orphan_keys(tables[fk.child], fk.child_cols, tables[fk.parent], fk.parent_cols)
        parts.append(labelled("FOREIGN KEY", fk.child, total(orphans, fk.name, F.sum("child_rows"))))
    report = []
    if parts:
        report.append(union_all(parts).withColumn(
            "status", F.when(F.col("violations") == 0, "OK").otherwise("VIOLATED")))
    if skipped:
        spark = next(iter(tables.values())).sparkSession
        report.append(small_frame(
            spark, [(KIND_ORDER.index(kind), kind, table, name, None, "SKIPPED") for kind, table, name in skipped],
            "seq int, kind string, table_name string, constraint_name string, violations bigint, status string"))
    if not report:
        raise ValueError("no constraints given")
    return union_all(report)


def retained(edges: DataFrame, tables: DataFrame, child: str = "child", parent: str = "parent",
             name: str = "name") -> DataFrame:
    """Foreign keys whose child and parent are both among ``tables``."""
    kept = tables.select(F.col(name).alias("_n"))
    return (edges.join(kept, F.col(child) == F.col("_n"), "left_semi")
            .join(kept, F.col(parent) == F.col("_n"), "left_semi"))


def retained_constraints(constraints: DataFrame, tables: DataFrame, table: str = "table_name",
                         name: str = "name") -> DataFrame:
    return constraints.join(tables.select(F.col(name).alias("_n")), F.col(table) == F.col("_n"), "left_semi")


def with_computed(df: DataFrame, definitions: Mapping[str, str]) -> DataFrame:
    """Computed columns rebuilt at the target from their definitions."""
    return df.withColumns({name: F.expr(text) for name, text in definitions.items()})
