"""Removal of boilerplate lines by the number of sites they are found on.

A HyperLogLog sketch of the sites is kept per line hash; sketches of the tasks merge by aggregation. Lines whose
estimate is clear of the threshold are decided by it, lines near it get an exact distinct count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import quoted, without


def line_text(line: Column) -> Column:
    """What is compared: the line without spaces, tabs and carriage returns around it."""
    return F.btrim(line, F.lit(" \t\r"))


def _lines(docs: DataFrame, text: str, *columns: Column) -> DataFrame:
    """(columns, pos, line) for each line with something in it."""
    split = F.posexplode(F.split(F.col(quoted(text)), "\n"))
    placed = docs.select(*columns, split.alias("pos", "raw"))
    return placed.withColumn("line", line_text(F.col("raw"))).where(F.col("line") != "").drop("raw")


def _hash(line: str) -> Column:
    return F.unhex(F.md5(F.col(line)))


def spread_lines(docs: DataFrame, min_sites: int, text: str = "text", site: str = "source", lg_k: int = 10,
                 margin: float = 0.2) -> DataFrame:
    """(hash) of every line found on at least ``min_sites`` different sites; a null site is none.

    ``lg_k`` 10 has a standard error of 3.3 %; estimates within ``margin`` (six of them) of the threshold are counted.
    """
    seen = _lines(docs, text, F.col(quoted(site)).cast("string").alias("site")).select("site", _hash("line").alias("hash"))
    sketched = seen.groupBy("hash").agg(F.hll_sketch_agg("site", lg_k).alias("sketch"))
    sites = sketched.select("hash", F.hll_sketch_estimate("sketch").alias("sites"))
    likely = materialize(sites.where(F.col("sites") >= min_sites * (1 - margin)), "line-sites")
    near = likely.where(F.col("sites") <= min_sites * (1 + margin)).select("hash")
    exact = seen.join(near, "hash", "left_semi").groupBy("hash").agg(F.countDistinct("site").alias("sites"))
    clear = likely.where(F.col("sites") > min_sites * (1 + margin))
    return materialize(clear.select("hash").union(exact.where(F.col("sites") >= min_sites).select("hash")), "line-spread")


def mark_boilerplate(docs: DataFrame, min_sites: int = 10, doc_id: str = "doc_id", text: str = "text",
                     site: str = "source") -> DataFrame:
    """``docs`` with ``n_lines`` (with something in them), ``n_spread`` (boilerplate among them), ``removed`` (places).

    A line is boilerplate if it is found on at least ``min_sites`` sites; it is removed whatever its share of the text.
    Only a document that has no other lines is left as it is: that is a copy which many sites hold as a whole, and so the
    near-duplicate operator's business. ``removed`` is null or the places of the lines that go. A null or empty text has
    no lines; rows repeated with one id and text are treated alike; columns named like a new one are replaced.

    A line on very many pages is one sketch per task before the shuffle; the join of the lines with the boilerplate
    hashes is one that AQE can split, and only lines that are boilerplate come out of it.
    """
    docs = without(docs, "n_lines", "n_spread", "removed")
    spread = spread_lines(docs, min_sites, text, site)
    own = [F.col(quoted(doc_id)).alias("own_id"), F.md5(F.col(quoted(text))).alias("own_md5")]
    found = _lines(docs, text, *own).select("own_id", "own_md5", "pos", _hash("line").alias("hash"))
    hits = found.join(spread, "hash").select("own_id", "own_md5", "pos").distinct()
    by_doc = hits.groupBy("own_id", "own_md5").agg(F.sort_array(F.collect_list("pos")).alias("places"))
    by_doc = materialize(by_doc, "line-places")          # so that AQE can split rows repeated very often
    keyed = docs.withColumn("_op_md5", F.md5(F.col(quoted(text))))
    joined = keyed.join(
        by_doc, keyed[quoted(doc_id)].eqNullSafe(by_doc["own_id"]) & (keyed["_op_md5"] == by_doc["own_md5"]), "left")
    lines = F.filter(F.split(F.col(quoted(text)), "\n"), lambda x: line_text(x) != "")
    small = F.size("places") < F.size(lines)
    return joined.select(
        *[F.col(quoted(c)) for c in docs.columns], F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).alias("n_spread"), F.when(small, F.col("places")).alias("removed"))


def remove_boilerplate(docs: DataFrame, text: str = "text", **settings) -> DataFrame:
    """``mark_boilerplate`` with the lines taken out of ``text``."""
    marked = mark_boilerplate(docs, text=text, **settings)
    kept = F.filter(F.split(F.col(quoted(text)), "\n"), lambda line, i: ~F.array_contains(F.col("removed"), i))
    cut = F.when(F.col("removed").isNull(), F.col(quoted(text))).otherwise(F.array_join(kept, "\n"))
    return marked.withColumn(text, cut)
