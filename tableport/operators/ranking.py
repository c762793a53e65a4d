"""Window results over long orderings without putting one long window into one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.names import column, fresh
from ..session import materialize, small_frame


def global_row_number(df: DataFrame, order_by, name: str = "position") -> DataFrame:
    """1-based position of every row in one total order; ``order_by`` must be unique per row.

    A global sort spreads the rows over range partitions. Each row gets its task number and its place
    in the task, the result is written once, and the number of rows before each task (one row per sort
    task, so small) is added by a broadcast lookup.
    """
    at, number, ahead = fresh([*df.columns, name], "_at", "_task", "_before")
    placed = materialize(df.orderBy(*order_by).withColumn(at, F.monotonically_increasing_id()), "ordered")
    task, place = F.shiftright(at, 33), F.col(at).bitwiseAND((1 << 33) - 1)
    counts = sorted(tuple(r) for r in placed.groupBy(task.alias("task")).count().collect())
    before = [0, *accumulate(n for _, n in counts)]
    offsets = small_frame(
        df.sparkSession, [(t, b) for (t, _), b in zip(counts, before)], f"{number} bigint, {ahead} bigint")
    return (placed.withColumn(number, task).join(F.broadcast(offsets), number)
            .withColumn(name, F.col(ahead) + place + 1).drop(at, number, ahead))


def preceding(df: DataFrame, keys, order_by, columns=(), known=()) -> DataFrame:
    """Values from before each row of its key in ``order_by`` order; NULL keys compare equal, NULLs come first.

    ``prev_<column>`` is the value of the row before (``lag``), ``known_<column>`` the last one before that is not NULL.
    One key may own a third of the rows, and they may all fall into one instant, so no key is a window of its
    own. A global sort by key and order spreads the rows evenly over tasks and is written once; a hash of the
    row breaks ties, so only rows equal in every column stay together. The windows run inside each sorted task,
    and the first rows of a task look at what the tasks before it carry: one row per sort task.
    """
    keys, order_by, columns, known = list(keys), list(order_by), list(columns), list(known)
    at, task, prev, carry, had = fresh(
        [*df.columns, *(f"prev_{c}" for c in columns), *(f"known_{c}" for c in known)], "_at", "_task", "_prev", "_carry", "_had")
    cols = [column(c) for c in (*keys, *order_by)]
    whole = F.xxhash64(*[column(f.name) for f in df.schema.fields if not _holds_map(f.dataType)])
    placed = materialize(df.orderBy(*cols, whole).withColumn(at, F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn(task, F.shiftright(at, 33))
    kept = F.struct(F.lit(0).alias("v"), *[column(c).alias(f"v{i}") for i, c in enumerate(columns)])
    own = F.struct(*[column(k).alias(f"k{i}") for i, k in enumerate(keys)], F.lit(0).alias("k"))
    inside = Window.partitionBy(task, *[column(k) for k in keys]).orderBy(at)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    last = [F.last(column(c), ignorenulls=True).over(before).alias(f"w{i}") for i, c in enumerate(known)]
    labelled = placed.select(
        "*", F.lag(kept).over(inside).alias(prev), (F.row_number().over(inside) > 1).alias(had),
        F.struct(F.lit(0).alias("w"), *last).alias(f"{prev}_known"))
    # one row per sort task, so these windows and the broadcast are small whatever the table holds
    edges = placed.groupBy(task).agg(
        F.max_by(F.struct(own.alias("own"), kept.alias("kept")), at).alias("edge"),
        F.struct(F.lit(0).alias("w"), *[
            F.max_by(F.struct(own.alias("own"), column(c).alias("value")), F.when(column(c).isNotNull(), column(at))).alias(f"w{i}")
            for i, c in enumerate(known)]).alias("tails"))
    same_key = Window.partitionBy("edge.own").orderBy(task)
    running = [F.last(F.when(F.col(f"tails.w{i}.own").eqNullSafe(F.col("edge.own")), F.col(f"tails.w{i}.value")), ignorenulls=True)
               .over(same_key).alias(f"w{i}") for i in range(len(known))]
    edges = edges.select(task, "edge", F.struct(F.lit(0).alias("w"), *running).alias("running"))
    carried = edges.select(task, F.lag(F.struct("edge", "running")).over(Window.orderBy(task)).alias(carry))
    joined = labelled.join(F.broadcast(carried), task, "left")
    same = F.col(carry)["edge"]["own"].eqNullSafe(own)
    lagged = F.when(F.col(had), F.col(prev)).when(same, F.col(carry)["edge"]["kept"])
    values = {f"prev_{c}": lagged[f"v{i}"] for i, c in enumerate(columns)}
    values |= {f"known_{c}": F.coalesce(F.col(f"{prev}_known")[f"w{i}"], F.when(same, F.col(carry)["running"][f"w{i}"]))
               for i, c in enumerate(known)}
    return joined.withColumns(values).drop(at, task, prev, f"{prev}_known", carry, had)


def _holds_map(kind: T.DataType) -> bool:
    """Maps and variants cannot be hashed."""
    return any(word in kind.simpleString() for word in ("map<", "variant"))


def previous(df: DataFrame, keys, order_by, columns) -> DataFrame:
    """``lag`` of ``columns`` per key in ``order_by`` order, as ``prev_<column>``; see ``preceding``."""
    return preceding(df, keys, order_by, columns)
