"""Exact order statistics of an integer key without sorting the table.

``NTILE(n) OVER (ORDER BY k)`` in its obvious Spark form moves every row to one task. Bucket edges need
only the keys at 2n known positions, so we count keys per power-of-two cell, keep the cells that hold a
wanted position, and count again inside those with finer cells until a cell is one key. Every pass is a
map-side-combined count of at most ``cells`` groups: no sort, no wide shuffle, and a key that holds a
third of the rows is just one large count.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import column


def key_summary(df: DataFrame, key: str) -> tuple[int | None, int | None, int, int]:
    """(min, max, non-null rows, all rows) of the key."""
    k = column(key).cast("bigint")
    row = df.agg(F.min(k), F.max(k), F.count(k), F.count(F.lit(1))).first()
    return row[0], row[1], row[2], row[3]


def _in_cells(k: Column, shift: int, cells: list[int]) -> Column:
    """Keys inside ``cells`` (ascending), as closed ranges that reach the Parquet scan.

    Neighbouring cells share a range and one range covers them all, so clustered files skip their other
    row groups even where the single ranges are too many for the scan.
    """
    spans = []
    for cell in cells:
        if spans and spans[-1][1] == cell - 1:
            spans[-1][1] = cell
        else:
            spans.append([cell, cell])
    inside = [k.between(a << shift, ((b + 1) << shift) - 1) for a, b in spans]
    whole = k.between(cells[0] << shift, ((cells[-1] + 1) << shift) - 1)
    while len(inside) > 1:                               # as a tree: many ranges must not nest deeply
        inside = [reduce(lambda a, b: a | b, inside[i:i + 2]) for i in range(0, len(inside), 2)]
    return whole & inside[0] if len(spans) > 1 else whole


def keys_at_ranks(df: DataFrame, key: str, ranks, lo: int, hi: int, cells: int = 1 << 16) -> dict[int, int]:
    """Key at each 1-based rank of the non-null keys in ascending order; keys lie in lo..hi."""
    k = column(key).cast("bigint")
    keyed = df.filter(k.isNotNull())
    # wanted: cell -> [(rank within the cell, original rank)]; one cell covers everything at first
    wanted = {None: [(rank, rank) for rank in sorted(set(ranks))]}
    shift = max((hi ^ lo).bit_length(), 1) if (hi < 0) == (lo < 0) else 64
    found: dict[int, int] = {}
    while wanted:
        # each kept cell splits into 2**step cells, so a pass never collects more than `cells` counts
        step = max(1, (cells // len(wanted)).bit_length() - 1)
        finer = max(0, shift - step)
        inside = keyed if None in wanted else keyed.filter(_in_cells(k, shift, sorted(wanted)))
        counts = inside.groupBy(F.shiftright(k, finer).alias("cell")).count().collect()
        by_parent: dict = {}
        for cell, rows in sorted((r["cell"], r["count"]) for r in counts):
            by_parent.setdefault(None if None in wanted else cell >> (shift - finer), []).append((cell, rows))
        following: dict = {}
        for parent, targets in wanted.items():
            children = by_parent[parent]
            ends = list(accumulate(rows for _, rows in children))
            for rank, original in targets:
                at = bisect_right(ends, rank - 1)
                cell, rows = children[at]
                if finer == 0:
                    found[original] = cell
                else:
                    following.setdefault(cell, []).append((rank - ends[at] + rows, original))
        wanted, shift = following, finer
    return found


def bucket_sizes(rows: int, n: int) -> list[int]:
    """Rows per NTILE bucket: the first ``rows % n`` buckets hold one more; empty ones do not exist."""
    whole, extra = divmod(rows, n)
    return [whole + (b < extra) for b in range(min(n, rows))]


def ntile_edges(df: DataFrame, key: str, n: int) -> list[tuple[int, int, int]]:
    """Exact (lowest key, highest key, rows) of each NTILE bucket over the non-null keys."""
    if n < 1:
        raise ValueError("n must be at least 1")
    lo, hi, rows, _ = key_summary(df, key)
    if not rows:
        return []
    sizes = bucket_sizes(rows, n)
    last = list(accumulate(sizes))
    first = [end - size + 1 for end, size in zip(last, sizes)]
    at = keys_at_ranks(df, key, first + last, lo, hi)
    return [(at[a], at[b], size) for a, b, size in zip(first, last, sizes)]


def trim_overlaps(edges) -> list[tuple[int, int]]:
    """Disjoint ranges from bucket edges: a key on an edge stays with the first bucket that has it.

    So each different upper edge ends one range, and the next range starts behind it.
    """
    edges = list(edges)
    tops = sorted({e[1] for e in edges})
    return list(zip([edges[0][0], *[t + 1 for t in tops]], tops)) if edges else []
