"""Exact top-k inner products with MaxScore.

Each dimension is a term: its column in a shard of the vectors is the posting list, and the largest value
that ``query[term] * weight`` takes in the shard is the term's score bound. Terms in order of their bound
split into non-essential ones (their bounds together stay under the k-th best score so far) and essential
ones. A shard sums the essential columns for all its rows, keeps the rows that can still reach the k-th
best, and probes the other terms only for those, largest bound first, dropping rows as they fall behind.
Bounds are of signed products, so the split is exact for negative weights too, and rows whose bound equals
the k-th score stay in, because ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .common import quoted


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", factor: int = 1024) -> DataFrame:
    """(id, weights): each component as ``floor(factor * x)``. Null ids, null vectors and vectors holding a
    null, NaN or infinite component take no part."""
    x = F.col(quoted(vector)).cast("array<double>")
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    kept = vectors.where(F.col(quoted(id_col)).isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False)))
    return kept.select(F.col(quoted(id_col)).cast("long").alias("id"),
                       F.transform(x, lambda v: F.floor(v * F.lit(float(factor)))).cast("array<long>").alias("weights"))


def _matrix(rows, width: int):
    """Terms by rows, zero where a vector is shorter."""
    out = np.zeros((width, len(rows)), "i8")
    for i, row in enumerate(rows):
        out[:len(row), i] = row
    return out


class _Best:
    """The k best (score, id) of one query so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, "i8"), np.zeros(0, "i8")

    @property
    def floor(self):
        return self.scores[-1] if len(self.scores) == self.k else None

    def add(self, scores, ids):
        scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]


def search_shard(postings, ids, query, own_id, best: _Best):
    """Add what one shard (``postings``: terms by rows) has for ``query`` to ``best``."""
    products = query[:, None] * np.stack((postings.min(axis=1), postings.max(axis=1)), axis=1)
    bound = products.max(axis=1)
    order = np.argsort(bound, kind="stable")
    reach = np.cumsum(bound[order])                     # what the terms up to each one can add together
    floor = best.floor
    split = 0 if floor is None else int(np.searchsorted(np.maximum.accumulate(reach), floor, side="left"))
    essential, others = order[split:], order[:split]
    live = np.flatnonzero(ids != own_id)
    scores = (query[essential] @ postings[essential])[live]
    for i in range(split - 1, -1, -1):
        keep = scores + reach[i] >= floor
        live, scores = live[keep], scores[keep]
        if not len(live):
            return
        scores = scores + query[others[i]] * postings[others[i], live]
    if floor is not None:
        keep = scores >= floor
        live, scores = live[keep], scores[keep]
    if len(live) > best.k:                              # ties at the k-th score stay for the id rule
        kth = np.partition(scores, len(scores) - best.k)[len(scores) - best.k]
        live, scores = live[scores >= kth], scores[scores >= kth]
    best.add(scores, ids[live])


def top_k(vectors: DataFrame, is_query, k: int = 10, shard_rows: int = 16_384, block_rows: int = 8_192) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query row with all other ids.

    ``vectors`` comes from ``scaled``; ``is_query`` is a condition on ``id``. Ties go to the smaller id. A query
    never meets rows of its own id. Components that one vector lacks count as 0. Query rows repeated with the
    same id and weights give one result; a repeated candidate row counts as often as it occurs. No query or no
    candidate gives no row. Scores must fit in a long.

    Queries are taken in blocks of about ``block_rows`` rows, which bounds what is sent to the tasks; each block
    is one pass over all vectors, in shards of ``shard_rows``, and gives at most ``k`` rows per query and task.
    """
    spark = vectors.sparkSession
    queries = vectors.where(is_query).distinct()
    blocks = max(1, -(-queries.count() // block_rows))
    parts = []
    for block in range(blocks):
        chosen = queries.where(F.pmod(F.xxhash64("id", "weights"), F.lit(blocks)) == block).collect()
        if chosen:
            parts.append(_search_block(vectors, block, [(r[0], list(r[1])) for r in chosen], k, shard_rows))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    best_first = Window.partitionBy("block", "query").orderBy(F.desc("score"), "vec_id", "copy")
    return (found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _search_block(vectors: DataFrame, block: int, queries: list, k: int, shard_rows: int) -> DataFrame:
    def search(batches):
        import pyarrow as pa

        best = [_Best(k) for _ in queries]

        def shard(ids, rows):
            width = max(max(map(len, rows)), max(len(q) for _, q in queries))
            postings, ids = _matrix(rows, width), np.array(ids, "i8")
            for (own, query), top in zip(queries, best):
                full = np.zeros(width, "i8")
                full[:len(query)] = query
                if width:
                    search_shard(postings, ids, full, own, top)
                else:
                    top.add(np.zeros(int((ids != own).sum()), "i8"), ids[ids != own])

        ids, rows = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            rows += batch.column(1).to_pylist()
            while len(rows) >= shard_rows:
                shard(ids[:shard_rows], rows[:shard_rows])
                ids, rows = ids[shard_rows:], rows[shard_rows:]
        if rows:
            shard(ids, rows)
        for number, ((own, _), top) in enumerate(zip(queries, best)):
            n = len(top.ids)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block)), pa.array(np.full(n, number)), pa.array(np.full(n, own)),
                     pa.array(top.ids), pa.array(top.scores), pa.array(np.arange(n))],
                    names=["block", "query", "query_id", "vec_id", "score", "copy"])

    return vectors.mapInArrow(search, "block long, query long, query_id long, vec_id long, score long, copy long")
