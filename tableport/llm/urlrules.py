"""URL allow and block rules by a sort-merge range join.

A host is written backwards with a dot behind each label (``www.example.com`` as ``com.example.www.``), so a
rule's host and all its subdomains are the keys that start with the rule's key: one interval of the sorted
keys. URLs are cut into key ranges and sorted; a rule goes to every range its interval meets. In each range
one sweep over the sorted rows keeps the stack of the rule hosts whose interval is open, innermost last, and
looks for the longest fitting path in each of them.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, functions as F

from .common import partitions_of, quoted, sampled, with_fields, without

_AFTER = "substr({u}, locate('://', {u}) + 3)"


def url_parts(url: str) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL column; both empty if it is null or has no ``://``."""
    u = quoted(url)
    rest = F.when(F.coalesce(F.expr(f"locate('://', {u}) > 0"), F.lit(False)), F.expr(_AFTER.format(u=u))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class _Node:
    """The path rules of one host: verdict by path, and the path lengths, longest first."""

    def __init__(self, key: str):
        self.key, self.verdicts, self.lengths = key, {}, []

    def add(self, path: str, verdict: str):
        if self.verdicts.get(path) != "block":          # of two rules for one host and path, block wins
            self.verdicts[path] = verdict
        self.lengths = sorted({len(p) for p in self.verdicts}, reverse=True)

    def longest(self, path: str) -> str | None:
        return next((path[:n] for n in self.lengths if n <= len(path) and path[:n] in self.verdicts), None)


def judge(stack: list[_Node], path: str):
    """(host key, path, verdict) of the longest rule among the open hosts, or None; ties to the longer host."""
    best = None
    for node in reversed(stack):
        found = node.longest(path)
        if found is not None and (best is None or len(node.key) + len(found) > len(best[0]) + len(best[1])):
            best = node.key, found, node.verdicts[found]
    return best


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
               ranges_per_partition: int = 8) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the rule that decides, else null), ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits its host and all subdomains if
    the path starts with the rule's path; the longest host and path together win, of equally long ones the longer
    host, of equal rules block. No fitting rule gives ``default``; so does a null URL or one without ``://``. Rules
    with a null or an empty host fit nothing; a null path counts as empty. Rows are kept one by one, repeated ones
    too; columns of ``pages`` named like a new one are replaced; without rules every URL gets the default.

    One shuffle of ``pages``. The ranges are cut at sampled keys that end in a row hash, so one host, or one URL,
    with a third of the rows is spread over many ranges.
    """
    new = ("host", "path", "rule", "verdict")
    parsed_host, parsed_path = url_parts(url)
    urls = without(pages.withColumns({"_op_host": parsed_host, "_op_path": parsed_path}), *new)
    salt = F.hex(F.xxhash64(*[F.col(quoted(c)) for c in urls.columns if not _is_map(urls, c)]))
    key = F.concat_ws("\x01", host_key(F.col("_op_host")), "_op_path", salt)
    urls = urls.withColumns({"_op_key": key, "_op_kind": F.lit(1)})
    partitions = partitions_of(pages)
    wanted = partitions * ranges_per_partition
    drawn = sorted(r[0] for r in sampled(urls.select("_op_key"), ["_op_key"], 8 * wanted))
    cuts = sorted({drawn[i * len(drawn) // wanted] for i in range(1, wanted)}) if drawn else []

    @F.pandas_udf("int")
    def range_of(keys):
        return keys.map(lambda k: bisect_right(cuts, k)).astype("int32")

    prefix = host_key(F.lower("host"))
    usable = rules.where(F.col("host") != "").select(
        F.coalesce("path", F.lit("")).alias("_op_path"), F.col("verdict").alias("_op_verdict"), prefix.alias("_op_key"))
    first, last = range_of("_op_key"), range_of(F.expr("concat(left(_op_key, length(_op_key) - 1), '/')"))
    placed = (usable.withColumns({"_op_first": first, "_op_last": last})
              .withColumn("_op_range", F.explode(F.sequence("_op_first", "_op_last")))
              .drop("_op_first", "_op_last").withColumn("_op_kind", F.lit(0)))
    both = urls.withColumn("_op_range", range_of("_op_key")).unionByName(placed, allowMissingColumns=True)
    laid = both.repartition(partitions, "_op_range").sortWithinPartitions("_op_range", "_op_key", "_op_kind")
    schema = with_fields(without(urls.drop("_op_key", "_op_kind"), "_op_host", "_op_path").schema,
                         *[(n, "string") for n in new])

    def sweep(batches):
        import pyarrow as pa

        at, stack = None, []
        for batch in batches:
            column = {n: batch.column(batch.schema.get_field_index(n)).to_pylist()
                      for n in ("_op_range", "_op_key", "_op_kind", "_op_host", "_op_path", "_op_verdict")}
            keep, rows = [], {n: [] for n in new}
            for i, (where, key, kind, host, path, verdict) in enumerate(zip(*column.values())):
                if where != at:
                    at, stack = where, []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1].key != key:
                        stack.append(_Node(key))
                    stack[-1].add(path, verdict)
                    continue
                best = judge(stack, path)
                keep.append(i)
                rows["host"].append(host)
                rows["path"].append(path)
                rows["rule"].append(best and ".".join(reversed(best[0].split(".")[:-1])) + best[1])
                rows["verdict"].append(best[2] if best else default)
            if keep:
                kept = batch.take(pa.array(keep))
                own = [kept.column(i) for i, f in enumerate(kept.schema) if not f.name.startswith("_op_")]
                yield pa.RecordBatch.from_arrays(
                    [*own, *[pa.array(rows[n], pa.string()) for n in new]], names=[f.name for f in schema])

    return laid.mapInArrow(sweep, schema)


def _is_map(df: DataFrame, column: str) -> bool:
    return "map<" in dict(df.dtypes)[column]
