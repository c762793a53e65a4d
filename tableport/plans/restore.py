"""Restore a bundle into a target and prove that every row arrived."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.names import column, names_of
from ..operators.constraints import Constraints, constraint_report, with_computed
from ..session import delete_path, small_frame
from ..sources.bundle import check_bundle, manifest_problems, open_bundle
from .inventory import row_counts


def _supplied(schema: T.StructType) -> list[str]:
    """Columns a restore writes: everything the target does not generate itself."""
    return [f.name for f in schema.fields if not (f.metadata or {}).get("generated")]


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields]


def load_rounds(tables, references) -> list[list[str]]:
    """Tables in rounds, each after the tables its (child, parent) pairs refer to; a cycle loads together, last."""
    waiting = {t: {p for c, p in references if c == t and p != t} for t in tables}
    rounds = []
    while waiting:
        ready = [t for t, parents in waiting.items() if not parents & waiting.keys()] or list(waiting)
        rounds.append(ready)
        waiting = {t: p for t, p in waiting.items() if t not in ready}
    return rounds


def restore_tables(
    spark: SparkSession, bundle: str, target, data_only: bool = False, replace: bool = False,
    constraints: Constraints | None = None, parallel: int = 8, parents_first: bool = False,
    computed: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """Load every table of a bundle; returns (table_fqn, row_count, restored_rows).

    Nothing is touched until the manifest, the names and every part have been checked. Identity
    values and NULLs are written as they are; defaults never apply. Keys, checks and foreign keys are
    checked after all data is in place, and any violation is an error. Constraints of tables the bundle does not
    hold, and references to such tables, are left out; tables are named ``table`` or ``schema.table`` in them.
    A target that can stage (folders) is loaded and proven beside its tables and published by renames, so a restore
    that fails leaves the old tables as they were; the others are replaced before the load.
    ``parents_first`` loads tables after those their foreign keys refer to, for a target that enforces them.
    ``computed`` (table -> column -> expression) adds columns the target has to hold rebuilt.
    """
    opened = open_bundle(spark, bundle)
    problems = manifest_problems(opened.manifest).collect()  # at most a few per listed table
    if problems:
        raise ValueError("; ".join(f"{p['scope']}: {p['problem']}" for p in problems))
    broken = check_bundle(spark, opened).filter("NOT ok").collect()
    if broken:
        raise ValueError("; ".join(f"{b['table_fqn']}: {b['parts_missing']} part(s) missing, "
                                   f"{b['stored_rows']} of {b['row_count']} rows stored" for b in broken))
    expected = {r[0]: r[1] for r in opened.tables.select("table_fqn", "row_count").collect()}
    absent = set(expected) - set(opened.schemas)
    if absent:
        raise ValueError(f"no schema for {sorted(absent)}")
    parts = opened.parts()
    if hasattr(target, "name"):
        places = {fqn: target.name(fqn).lower() for fqn in expected}
        for fqn, place in places.items():
            same = [f for f, p in places.items() if p == place]
            if len(same) > 1:
                raise ValueError(f"{' and '.join(sorted(same))} would both become {target.name(fqn)}")

    staged = target.staged() if hasattr(target, "staged") and not data_only else None
    if replace:
        if data_only:
            raise ValueError("a data-only restore cannot replace its target")
        if staged is None:
            target.reset(spark, expected)
    before: dict[str, int] = {}
    for fqn in expected:
        exists = target.exists(spark, fqn)
        if data_only:
            if not exists:
                raise ValueError(f"{fqn}: a data-only restore needs the table to exist")
            kept = opened.schemas[fqn]
            there = T.StructType([f for f in kept.fields if f.name in _supplied(kept)])
            if _shape(target.read(spark, fqn).schema) != _shape(there):
                raise ValueError(f"{fqn}: the target's columns differ from the bundle's")
        elif exists and not (replace and staged):
            raise FileExistsError(f"{fqn} already exists in the target")
    if data_only:
        before = {r[0]: r[1] for r in row_counts({f: target.read(spark, f) for f in expected}).collect()}

    place = staged or target

    def load(fqn: str) -> None:
        # empty tables are created as well; appending no rows to an existing one is skipped
        if data_only and expected[fqn] == 0:
            return
        df = opened.read(fqn, parts[fqn]).select(*[column(c) for c in _supplied(opened.schemas[fqn])])
        place.append(with_computed(df, added.get(fqn, {})), fqn)

    fqns = {name: fqn for fqn in expected for name in names_of({fqn: None})}
    fqns = {name: fqn for name, fqn in fqns.items() if name in names_of(dict.fromkeys(expected))}
    added = {fqns[name]: texts for name, texts in (computed or {}).items()}
    rounds = [list(expected)]
    if parents_first and constraints is not None:
        kept = constraints.within(fqns).foreign_keys
        rounds = load_rounds(expected, [(fqns[k.child], fqns[k.parent]) for k in kept if not k.disabled])
    try:
        with ThreadPoolExecutor(max(1, parallel)) as pool:
            for tables in rounds:
                list(pool.map(load, tables))

        restored = {fqn: place.read(spark, fqn) for fqn in expected}
        after = {r[0]: r[1] for r in row_counts(restored).collect()}
        rows = [(fqn, n, after.get(fqn, 0) - before.get(fqn, 0)) for fqn, n in expected.items()]
        for fqn, n, got in rows:
            if n != got:
                raise ValueError(f"{fqn}: {got} rows restored, {n} expected")
        if constraints is not None:
            by_name = names_of(restored)
            kept = constraints.within(by_name)
            violated = [] if kept.empty else constraint_report(by_name, kept).filter("status = 'VIOLATED'").collect()
            if violated:
                raise ValueError("; ".join(f"{v['constraint_name']}: {v['violations']} violation(s)" for v in violated))
    except Exception:
        if staged is not None:
            delete_path(spark, staged.root)
        raise
    if staged is not None:
        target.publish(spark, staged, expected)
        delete_path(spark, staged.root)                  # with the tables that were replaced
    return small_frame(spark, rows, "table_fqn string, row_count bigint, restored_rows bigint")
