"""Removal of long passages that stand in an earlier document, word by word.

Two equal windows have the same least k-gram (their anchor), so runs of windows under one anchor are the passages to
compare, and passages that meet lie in one shard. The distinct passages of a shard, each with the least id of its
documents, form the shard's reference, a suffix automaton over words. Passages stream through it; where the matching
statistic reaches the window, the state tells the least id in which the window stands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.names import fresh
from ..session import materialize
from .common import give_back, partitions_of, quoted, sub_batches, with_fields, without

# Odd 64-bit multipliers of the rolling hashes.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_RUN = "struct<start:int,n:int,anchor:bigint,c1:bigint,c2:bigint>"


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than space and U+0009 to U+000D, as UTF-8; what ``bytes.split`` does."""
    return text.encode().split() if text else []


class WordHashes(dict):
    """64-bit hashes of the words met so far."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _rolling(h, length: int, base: int):
    """Hash of every ``length`` neighbouring elements, put together from hashes of doubled lengths."""
    import numpy as np

    done, done_len, power, power_len = None, 0, h, 1
    while True:
        if length & power_len:
            if done is None:
                done, done_len = power, power_len
            else:
                n = len(h) - done_len - power_len + 1
                done = done[:n] * np.uint64(pow(base, power_len, 1 << 64)) + power[done_len:done_len + n]
                done_len += power_len
        if power_len * 2 > length:
            return done
        n = len(power) - power_len
        power, power_len = power[:n] * np.uint64(pow(base, power_len, 1 << 64)) + power[power_len:], power_len * 2


def _sliding_min(values, width: int):
    import numpy as np

    low, covered = values, 1
    while covered * 2 <= width:
        low, covered = np.minimum(low[:len(low) - covered], low[covered:]), covered * 2
    return np.minimum(low[:len(values) - width + 1], low[width - covered:][:len(values) - width + 1])


def runs_of(h, doc, window: int, gram: int, single=None):
    """Runs of windows under one anchor in a flat array of word hashes.

    ``doc`` numbers the document of each word. Gives (document, place in the flat array, number of windows, anchor,
    two content hashes) as arrays. A run has at most ``window - gram + 1`` windows, so its first and last window cover
    it. ``single`` (sorted anchors) asks for only those anchors, each window as a run of its own under its own hash.
    """
    import numpy as np

    if len(h) < window:
        return None
    width = window - gram + 1
    with np.errstate(over="ignore"):
        grams = _rolling(h, gram, _BASES[0])
        grams = (grams ^ (grams >> np.uint64(31))) * np.uint64(_BASES[1])
        anchor = _sliding_min(grams ^ (grams >> np.uint64(29)), width)
        whole = [_rolling(h ^ np.uint64(i), window, base) for i, base in enumerate(_BASES)]
        inside = doc[:len(anchor)] == doc[window - 1:]
        if single is not None:
            at = np.flatnonzero(inside & np.isin(anchor, single))
            return doc[at], at, np.ones(len(at), "i8"), whole[0][at], whole[0][at], whole[1][at]
        begins = np.ones(len(anchor), bool)
        begins[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:len(anchor)] != doc[:len(anchor) - 1])
        edges = np.flatnonzero(begins)
        place = np.arange(len(anchor)) - np.repeat(edges, np.diff(np.append(edges, len(anchor))))
        at = np.flatnonzero((begins | (place % width == 0)) & inside)
        begins[at] = True
        stops = np.flatnonzero(begins | ~inside)
        after = np.searchsorted(stops, at, "right")
        n = np.append(stops, len(anchor))[after] - at
        last, size = at + n - 1, n.astype(np.uint64)
        c1, c2 = ((w[at] * np.uint64(b) + w[last]) * np.uint64(b) + size for w, b in zip(whole, _BASES[::-1]))
    return doc[at], at, n, anchor[at], c1, c2


def window_runs(docs: DataFrame, key: str, doc_id: str, text: str, window: int, gram: int, single=None,
                batch_bytes: int = 2_000_000) -> DataFrame:
    """(doc_id, key, runs) of every document with an id and at least ``window`` words; nothing is shuffled."""
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("key", T.LongType())])
    schema = with_fields(schema, ("runs", f"array<{_RUN}>"))

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        hashes = WordHashes()
        for whole in batches:
            for batch in sub_batches(whole, "text", batch_bytes):
                if len(hashes) > 500_000:
                    hashes.clear()
                split = [words_of(t) for t in batch.column("text").to_pylist()]
                sizes = np.array([len(w) for w in split], "i8")
                h = np.fromiter((hashes[w] for row in split for w in row), np.uint64, int(sizes.sum()))
                del split
                doc = np.repeat(np.arange(len(sizes)), sizes)
                found = runs_of(h, doc, window, gram, single)
                if found is None or not len(found[0]):
                    continue
                row, at, n, anchor, c1, c2 = found
                first = np.concatenate(([0], np.cumsum(sizes)))
                kept, counts = np.unique(row, return_counts=True)
                offsets = np.concatenate(([0], np.cumsum(counts))).astype("i4")
                fields = [(at - first[row]).astype("i4"), n.astype("i4"), *(x.view("i8") for x in (anchor, c1, c2))]
                runs = pa.StructArray.from_arrays([pa.array(f) for f in fields], ["start", "n", "anchor", "c1", "c2"])
                picked = batch.take(pa.array(kept))
                yield pa.RecordBatch.from_arrays(
                    [picked.column("id"), picked.column("key"), pa.ListArray.from_arrays(pa.array(offsets), runs)],
                    names=["id", "key", "runs"])
            del whole
            give_back()

    named = docs.where(F.col(quoted(doc_id)).isNotNull()).select(
        F.col(quoted(doc_id)).alias("id"), F.col(key).alias("key"), F.col(quoted(text)).alias("text"))
    return named.mapInArrow(scan, schema)


class Automaton:
    """Suffix automaton of several word sequences. A state keeps the least id of the sequences its words stand in."""

    def __init__(self):
        self.next, self.link, self.size, self.least = [{}], [-1], [0], [None]

    def _state(self, size, link, steps) -> int:
        self.next.append(steps)
        self.link.append(link)
        self.size.append(size)
        self.least.append(None)
        return len(self.size) - 1

    def _split(self, above: int, word, below: int) -> int:
        """A state of its own for what ``above`` and ``word`` make, which ``below`` held so far."""
        copy = self._state(self.size[above] + 1, self.link[below], dict(self.next[below]))
        self.link[below] = copy
        while above != -1 and self.next[above].get(word) == below:
            self.next[above][word] = copy
            above = self.link[above]
        return copy

    def add(self, words, own) -> None:
        steps, link, size, least, last = self.next, self.link, self.size, self.least, 0
        for word in words:
            there = steps[last].get(word)
            if there is not None:
                last = there if size[there] == size[last] + 1 else self._split(last, word, there)
            else:
                fresh_state = self._state(size[last] + 1, 0, {})
                above = last
                while above != -1 and word not in steps[above]:
                    steps[above][word] = fresh_state
                    above = link[above]
                if above != -1:
                    there = steps[above][word]
                    link[fresh_state] = there if size[there] == size[above] + 1 else self._split(above, word, there)
                last = fresh_state
            if least[last] is None or own < least[last]:
                least[last] = own

    def finish(self) -> None:
        """What stands in a sequence stands there with each of its ends: ids go up the suffix links."""
        least, link = self.least, self.link
        for state in sorted(range(1, len(link)), key=self.size.__getitem__, reverse=True):
            up, own = link[state], least[state]
            if least[up] is None or own < least[up]:
                least[up] = own

    def first_ids(self, words, window: int) -> list:
        """For each word from the ``window``-th on: least id in which the window ending there stands, or None."""
        steps, link, size, least = self.next, self.link, self.size, self.least
        state, length, out = 0, 0, []
        for n, word in enumerate(words, 1):
            while state and word not in steps[state]:
                state = link[state]
                length = size[state]
            there = steps[state].get(word)
            if there is not None:
                state, length = there, length + 1
            if length >= window:                         # the window itself is enough
                while size[link[state]] >= window:
                    state = link[state]
                length = window
            if n >= window:
                out.append(least[state] if length >= window else None)
        return out


def _spans(ids: list) -> list[dict]:
    """Maximal runs of windows with one least id."""
    out = []
    for i, own in enumerate(ids):
        if out and out[-1]["least"] == own:
            out[-1]["stop"] = i + 1
        else:
            out.append({"begin": i, "stop": i + 1, "least": own})
    return out


def _passages(reps: DataFrame, schema: T.StructType, window: int) -> DataFrame:
    """The words of each place asked for, from the joined documents."""

    def cut(batches):
        import pyarrow as pa

        done = None
        for batch in batches:
            out = []
            rows = (batch.column(n).to_pylist() for n in ("own_id", "own_key", "text", "places"))
            for own_id, own_key, text, places in zip(*rows):
                if done == (own_id, own_key):            # rows come sorted by key; a repeated one gives the same
                    continue
                done, words = (own_id, own_key), words_of(text)
                for p in places:
                    words_there = words[p["start"]:p["start"] + p["n"] + window - 1]
                    out.append({"shard": p["shard"], "c1": p["c1"], "c2": p["c2"], "least": p["least"],
                                "words": b" ".join(words_there).decode()})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)
    return reps.mapInArrow(cut, schema)


def _match(passages: DataFrame, schema: T.StructType, window: int) -> DataFrame:
    """One automaton for each shard (rows come sorted by shard); its passages stream through it."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)

    def match(batches):
        import pyarrow as pa

        def judged(rows):
            automaton = Automaton()
            split = [r["words"].encode().split() for r in rows]
            for r, words in zip(rows, split):
                automaton.add(words, r["least"])
            automaton.finish()
            out = [{"c1": r["c1"], "c2": r["c2"], "parts": _spans(automaton.first_ids(words, window))}
                   for r, words in zip(rows, split)]
            return pa.RecordBatch.from_pylist(out, schema=target)

        shard, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["shard"] != shard:
                    yield judged(held)
                    held = []
                shard = row["shard"]
                held.append(row)
        if held:
            yield judged(held)
        give_back()

    return passages.mapInArrow(match, schema)


def repeated_spans(docs: DataFrame, window: int = 50, gram: int = 16, doc_id: str = "doc_id", text: str = "text",
                   shard_words: int = 100_000, max_group: int = 4096) -> DataFrame:
    """``docs`` with ``spans``: [begin, end) word places of passages that also stand in a row with a smaller id.

    A window of ``window`` words counts if its word sequence starts anywhere in a row with a smaller ``doc_id``; a span
    is a run of such windows (spans of one row may overlap). Rows with equal ids do not count against each other; a
    row without id neither loses words nor stands against others. Null, empty and short texts have null ``spans``;
    columns named like the new one are replaced; an empty table stays empty; repeated rows are treated alike.

    Only places under anchors of at least two ids go on, equal passages are one, and a shard holds about
    ``shard_words``. An anchor with over ``max_group`` different passages (a phrase that many contexts share) is
    taken apart: each of its windows stands for itself. The list of such anchors goes to the driver; at most
    100 000 can exist, as ``max_group`` grows to a 100 000th of all passages beyond 400 million.
    """
    docs = without(docs, "spans")
    spark, id_type = docs.sparkSession, docs.schema[doc_id].dataType
    key, = fresh([*docs.columns, "spans"], "_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col(quoted(text))))
    scanned = materialize(window_runs(keyed, key, doc_id, text, window, gram), "window-runs")
    runs = scanned.select("id", "key", F.inline("runs"))

    def contents_of(rows):
        return rows.groupBy("anchor", "c1", "c2").agg(F.min("id").alias("least"), F.max("id").alias("last"))

    contents = materialize(contents_of(runs), "passages")
    limit = max(max_group, contents.count() // 100_000)
    anchors = contents.groupBy("anchor").agg(
        F.min("least").alias("low"), F.max("last").alias("high"), F.count(F.lit(1)).alias("passages"))
    anchors = materialize(anchors.where("low < high"), "anchors")
    hot = [r[0] for r in anchors.where(F.col("passages") > limit).select("anchor").collect()]
    candidates = contents.join(anchors.where(F.col("passages") <= limit).select("anchor"), "anchor", "left_semi")
    candidates = candidates.select("anchor", "c1", "c2", "least")
    if hot:
        import numpy as np

        single = np.sort(np.array(hot, "i8").view("u8"))
        apart = materialize(window_runs(keyed, key, doc_id, text, window, gram, single), "single-windows")
        apart = apart.select("id", "key", F.inline("runs"))
        runs = runs.unionByName(apart)                   # an anchor taken apart is no candidate itself
        candidates = candidates.unionByName(contents_of(apart).where("least < last").select("anchor", "c1", "c2", "least"))
    candidates = materialize(candidates, "candidates")
    shards = max(1, candidates.count() * (window + gram) // shard_words)
    members = materialize(runs.join(candidates, ["anchor", "c1", "c2"]), "members")

    first = members.where(F.col("id").eqNullSafe(F.col("least"))).groupBy("anchor", "c1", "c2", "least").agg(
        F.min(F.struct("key", "start", "n")).alias("at"))
    place = F.struct(
        F.col("at.start").alias("start"), F.col("at.n").alias("n"), "c1", "c2", "least",
        F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int").alias("shard"))
    wanted = first.groupBy(F.col("least").alias("own_id"), F.col("at.key").alias("own_key")).agg(
        F.collect_list(place).alias("places"))

    def beside(frame):
        """The same condition, and so the same exchange of the documents, in both joins."""
        return keyed[quoted(doc_id)].eqNullSafe(frame["own_id"]) & keyed[key].eqNullSafe(frame["own_key"])

    reps = keyed.join(wanted, beside(wanted)).select("own_id", "own_key", F.col(quoted(text)).alias("text"), "places")
    shape = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("c1", T.LongType()),
                          T.StructField("c2", T.LongType()), T.StructField("least", id_type)])
    passages = _passages(reps, with_fields(shape, ("words", "string")), window)
    dealt = passages.repartition(partitions_of(docs), "shard").sortWithinPartitions("shard")
    part = T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("stop", T.IntegerType()),
                         T.StructField("least", id_type)])
    judged = T.StructType([*shape.fields[1:3], T.StructField("parts", T.ArrayType(part))])
    judged = _match(dealt, judged, window)               # not written, so that both joins read one exchange of the documents

    hits = members.select("id", "key", "start", "c1", "c2").join(judged, ["c1", "c2"]).select(
        "id", "key", "start", F.explode(F.filter("parts", lambda p: p["least"] < F.col("id"))).alias("p"))
    span = F.struct((F.col("start") + F.col("p.begin")).alias("begin"), (F.col("start") + F.col("p.stop") + window - 1).alias("stop"))
    spans = hits.groupBy(F.col("id").alias("own_id"), F.col("key").alias("own_key")).agg(F.collect_set(span).alias("spans"))
    return keyed.join(spans, beside(spans), "left").select(*[F.col(quoted(c)) for c in docs.columns], "spans")


def remove_repeats(docs: DataFrame, text: str = "text", **settings) -> DataFrame:
    """``docs`` without the words of ``repeated_spans``: ``text`` becomes the kept words, joined by one space.

    ``n_words`` and ``n_removed`` count the words before and those removed. A null text stays null with zeros.
    """
    found = repeated_spans(without(docs, "n_words", "n_removed"), text=text, **settings)
    schema = T.StructType([f for f in found.schema.fields if f.name != "spans"])
    schema = with_fields(schema, ("n_words", "bigint"), ("n_removed", "bigint"))

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for batch in sub_batches(whole, text, 2_000_000):
                texts, totals, removed = [], [], []
                for own, spans in zip(batch.column(text).to_pylist(), batch.column("spans").to_pylist()):
                    words = words_of(own)
                    total = len(words)
                    if spans:
                        gone = np.zeros(total + 1, "i8")
                        np.add.at(gone, [s["begin"] for s in spans], 1)
                        np.add.at(gone, [s["stop"] for s in spans], -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
                    texts.append(None if own is None else b" ".join(words).decode())
                    totals.append(total)
                    removed.append(total - len(words))
                columns = [pa.array(texts, pa.string()) if n == text else batch.column(n) for n in batch.schema.names if n != "spans"]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(totals, pa.int64()), pa.array(removed, pa.int64())], names=schema.names)
            give_back()

    return found.mapInArrow(cut, schema)
