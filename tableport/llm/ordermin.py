"""Near-duplicate documents by order MinHash.

The k-mers of a text are its five-word shingles, each labelled with its occurrence number, so a text is a set even
where it repeats itself. One repetition of the sketch takes the few labelled k-mers with the least hash values and
keeps them in text order; two texts meet in a bucket when a repetition gives both the same sequence, which needs
common k-mers in a common order. The texts of a bucket are then compared: banded alignment verifies pairs that have
as many shingles in common as their edits must leave, and equal shingles in any order count by their Jaccard similarity.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import give_back, partitions_of, quoted
from .components import connected

K = 5
THRESHOLD = 0.8                                          # of labelled shingles
ALIKE = 0.9                                              # of words, by alignment
_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(x):
    """Bijective scrambling of 64-bit numbers (constants of the public splitmix64 generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def labelled_shingles(tokens):
    """A number per shingle of ``K`` words and its occurrence in the text; a shorter text is one shingle."""
    t = np.asarray(tokens, "i8").astype("u8")
    k = min(K, len(t))
    h = np.zeros(len(t) - k + 1, "u8")
    for i in range(k):
        h = _mix(h * _P + t[i:len(t) - k + 1 + i] + np.uint64(k))
    return labelled(h)


def labelled(h):
    """Each number joined with how often it has occurred before, so that a list becomes a set."""
    order = np.argsort(h, kind="stable")
    in_order = h[order]
    starts = np.flatnonzero(np.concatenate(([True], in_order[1:] != in_order[:-1])))
    nth = np.arange(len(h)) - np.repeat(starts, np.diff(np.append(starts, len(h))))
    out = np.empty_like(h)
    out[order] = _mix(in_order + nth.astype("u8") * _P)
    return out


def sketch(labelled, seeds, length: int):
    """One number per repetition: the ``length`` labelled k-mers with the least hashes, in text order."""
    hashed = (labelled[None, :] ^ seeds[:, None]) * _P   # the labels are well mixed already
    if len(labelled) > length:
        least = np.sort(np.argpartition(hashed, length - 1, axis=1)[:, :length], axis=1)
    else:
        least = np.broadcast_to(np.arange(len(labelled)), hashed.shape)
    out = seeds.copy()
    for i in range(least.shape[1]):
        out = _mix(out * _P + labelled[least[:, i]])
    return out.view("i8")


def _runs(a, b, band: int):
    """For each diagonal from -band to band and each place of ``a``: the next place of a mismatch on it."""
    n, m = len(a), len(b)
    shift = np.arange(-band, band + 1)[:, None]
    at = np.arange(n)[None, :] + shift
    same = (at >= 0) & (at < m)
    same &= a[None, :] == b[np.clip(at, 0, m - 1)]
    stop = np.where(same, n, np.arange(n)[None, :]).astype("i4")
    return np.minimum.accumulate(stop[:, ::-1], axis=1)[:, ::-1]


def _by_diagonals(a, b, band: int):
    n, m = len(a), len(b)
    runs = np.concatenate((_runs(a, b, band), np.full((2 * band + 1, 1), n, "i4")), axis=1)
    rows, end = np.arange(2 * band + 1), m - n + band
    limit = np.minimum(n, m - (rows - band))             # the furthest place of a on each diagonal
    reach = np.full(2 * band + 1, -1)
    reach[band] = min(runs[band, 0], limit[band])
    for edits in range(band + 1):
        if edits:
            grown = np.where(reach >= 0, reach + 1, -1)
            grown[1:] = np.maximum(grown[1:], reach[:-1])
            grown[:-1] = np.maximum(grown[:-1], np.where(reach[1:] >= 0, reach[1:] + 1, -1))
            grown = np.minimum(grown, limit)
            known = (grown >= 0) & (grown >= band - rows)
            reach = np.where(known, np.minimum(runs[rows, np.clip(grown, 0, n)], limit), -1)
        if reach[end] >= n:
            return edits
    return None


def _by_rows(a, b, band: int):
    n, m = len(a), len(b)
    far, place = n + m + 1, np.arange(2 * band + 1)
    at = place - band
    row = np.where((at >= 0) & (at <= m), at, far)
    for i in range(1, n + 1):
        at = at + 1                                      # places of b on this row of the band
        inside = (at >= 0) & (at <= m)
        cost = np.where((at >= 1) & (at <= m), b[np.clip(at - 1, 0, m - 1)] != a[i - 1], 1)
        cost[at < 1] = far
        step = np.minimum(row + cost, np.append(row[1:], far) + 1)
        step = np.minimum.accumulate(np.where(inside, step, far) - place) + place
        row = np.where(inside, np.minimum(step, far), far)
    found = int(row[m - n + band])
    return found if found <= band else None


def edit_distance(a, b, most: int, max_cells: int = 8_000_000):
    """Least number of words to replace, insert or delete, or None if it is over ``most``.

    Aligned in a band around the diagonal that is doubled until the distance fits in it. A band of few cells is
    aligned along its diagonals (jumping over equal runs), a wider one row by row in memory of one row.
    """
    a, b = np.asarray(a), np.asarray(b)
    if abs(len(a) - len(b)) > most:
        return None
    if not len(a) or not len(b):
        return max(len(a), len(b))
    band = 8
    while True:
        band = min(max(band, abs(len(a) - len(b))), most)
        align = _by_diagonals if (2 * band + 1) * len(a) <= max_cells else _by_rows
        found = align(a, b, band)
        if found is not None or band == most:
            return found
        band *= 4


def similar(a, b, alike: float) -> bool:
    """Edit similarity of two word sequences: at most ``1 - alike`` of the longer one is edited."""
    return edit_distance(a, b, most_edits(max(len(a), len(b)), alike)) is not None


def most_edits(words, alike: float):
    """How many words of the longer text may be edited."""
    return np.floor((1 - alike) * words + 1e-9).astype("i8")


def _in_common(sets):
    """A function of i: how many elements set i has in common with each of ``sets`` (none of them empty)."""
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum([len(s) for s in sets])
    starts, flags = np.concatenate(([0], ends[:-1])), np.zeros(codes.max() + 1, "i4")

    def of(i):
        own = codes[starts[i]:ends[i]]
        flags[own] = 1
        found = np.add.reduceat(flags[codes], starts)
        flags[own] = 0
        return found

    return of


def compare_group(keys, tokens, side, classes, threshold: float = THRESHOLD, alike: float = ALIKE):
    """Links (i, j) that join the texts of a bucket into the classes all its similar pairs give.

    ``side`` tells which of two blocks a text is from (all 0 in one block); with two blocks only pairs across are
    compared. Texts of one of ``classes`` are joined already. A pair already joined needs no test, so the links form a
    forest. Each text's common shingles with all others are counted at once. A pair is aligned only if it can be
    alike: an edit changes at most ``K`` shingles and one word, so texts of few edits have all others in common.
    """
    sets = [np.unique(labelled_shingles(t)) for t in tokens]
    sizes, words = np.array([len(s) for s in sets]), np.array([len(t) for t in tokens])
    common_shingles = _in_common(sets)
    bags = [None] * len(keys)

    def bag(x):
        if bags[x] is None:
            bags[x] = labelled(np.asarray(tokens[x], "i8").astype("u8"))
        return bags[x]

    side, root, first = np.asarray(side), list(range(len(keys))), {}
    two = side.min() != side.max()
    for i, c in enumerate(classes):
        root[i] = first.setdefault(c, i)

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(keys)):
        if two and side[i]:
            continue
        common = common_shingles(i)
        close = common >= threshold * (sizes + sizes[i] - common) - 1e-9
        longer = np.maximum(words, words[i])
        most = most_edits(longer, alike)
        near = common >= np.maximum(1, np.maximum(sizes, sizes[i]) - K * most)
        others = (side == 1) if two else (np.arange(len(keys)) > i)
        for j in np.flatnonzero((close | near) & others):
            if find(i) == find(j):
                continue
            if close[j] or (len(np.intersect1d(bag(i), bag(j), assume_unique=True)) >= longer[j] - most[j]
                            and similar(tokens[i], tokens[j], alike)):
                root[find(j)] = find(i)
                yield i, int(j)


def tokenized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_md5, key, tokens) of every row: words in lower case as hashes, and the MD5 of the words.

    A word is a run of letters, digits and underscores. Texts with equal words share their key; a text without a
    word (null, empty, punctuation) has neither key nor tokens. Written once; the text itself is not.
    """
    words = F.filter(F.split(F.lower(F.col(quoted(text))), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    split = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.md5(F.col(quoted(text))).alias("text_md5"),
                        words.alias("words"))
    has = F.size("words") > 0
    return materialize(split.select(
        "doc_id", "text_md5", F.when(has, F.unhex(F.md5(F.array_join("words", " ")))).alias("key"),
        F.when(has, F.transform("words", lambda w: F.hash(w))).alias("tokens")), "omh-tokens")


def _buckets(base: DataFrame, repetitions: int, length: int, seed: int) -> DataFrame:
    seeds = np.random.default_rng(seed).integers(0, 1 << 63, repetitions, dtype="u8") * np.uint64(2) + np.uint64(1)

    def sketches(batches):
        import pyarrow as pa

        for batch in batches:
            keys, found = batch.column(0), []
            flat, offsets = batch.column(1).values.to_numpy(), batch.column(1).offsets.to_numpy()
            for at, end in zip(offsets[:-1], offsets[1:]):
                found.append(sketch(labelled_shingles(flat[at:end]), seeds, length))
            if found:
                rows = np.repeat(np.arange(len(found)), repetitions)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(rows)), pa.array(np.concatenate(found))], names=["key", "bucket"])
        give_back()

    worded = base.where(F.col("key").isNotNull()).select("key", "tokens")
    return worded.mapInArrow(sketches, "key binary, bucket long").distinct()


def links(base: DataFrame, repetitions: int, length: int, threshold: float, alike: float, block: int,
          seed: int) -> DataFrame:
    """(a, b): verified links between different word sequences, enough to join each class.

    First every text of a bucket is compared with the least one (``lead``), which joins a large group of copies in as
    many comparisons as it has texts. Then all pairs of a bucket that are not joined yet: the texts outside the largest
    joined set of their bucket are compared with one another and with that set, which is not compared within itself.
    The repetitions bring one large set together in many buckets, so these are compared as one group if that is less.
    """
    members = materialize(_buckets(base, repetitions, length, seed), "omh-buckets")
    number = F.xxhash64("key")
    sizes = (members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("key").alias("lead"),
                                           F.bit_xor(number).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"))
             .where(F.col("n") > 1))
    # the repetitions often bring the same texts together; each set of texts is compared once
    chosen = sizes.groupBy("n", "lead", "x", "y").agg(F.min("bucket").alias("bucket"))
    met = materialize(members.join(chosen.select("bucket", "n", "lead"), "bucket"), "omh-met")
    wanted = met.select("key").distinct()
    texts = materialize(base.where(F.col("key").isNotNull()).select("key", "tokens").join(wanted, "key", "left_semi")
                        .groupBy("key").agg(F.first("tokens").alias("tokens")), "omh-texts")

    widest = chosen.groupBy("lead").agg(F.ceil(F.max("n") / block).cast("int").alias("blocks"))
    widest = materialize(widest, "omh-leads")
    apart = (met.where(F.col("key") != F.col("lead")).select("lead", "key").distinct().join(widest, "lead")
             .select(F.col("lead").alias("bucket"), F.pmod(number, "blocks").cast("int").alias("i"), "key",
                     F.lit(1).alias("side")))
    leads = widest.select(F.col("lead").alias("bucket"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"),
                          F.col("lead").alias("key"), F.lit(0).alias("side"))
    stars = apart.unionByName(leads).withColumn("j", F.col("i")).withColumn("class", F.col("key"))
    led = materialize(_compared(stars, texts, threshold, alike), "omh-led")

    # copies of one text are often less alike than each is to some lead: what links join by any way is joined
    joined = connected(led).select(F.col("node").alias("key"), F.col("root").alias("class"))
    known = materialize(met.select("bucket", "key").join(joined, "key", "left")
                        .select("bucket", "key", F.coalesce("class", "key").alias("class")), "omh-known")
    largest = (known.groupBy("bucket", "class").agg(F.count("*").alias("n")).groupBy("bucket")
               .agg(F.max_by("class", F.struct("n", "class")).alias("main"), F.max("n").alias("m"), F.sum("n").alias("n"))
               .where(F.col("n") > F.col("m")).select("bucket", "main", "m", (F.col("n") - F.col("m")).alias("o")))
    largest = materialize(largest, "omh-largest")

    def rows(m, o):                                      # laid out for m texts of the main set and o others
        return m * F.ceil(o / block) + o * (F.ceil(o / block) + F.ceil(m / block))

    # buckets with one main set are compared as one group where that lays out no more rows than each on its own
    placed = materialize(known.join(largest, "bucket"), "omh-placed")
    in_main = F.col("class") == F.col("main")
    whole = (placed.select("main", "key", "class").distinct().groupBy("main")
             .agg(F.count_if(in_main).alias("m"), F.count_if(~in_main).alias("o")))
    apart = largest.groupBy("main").agg(F.sum(rows(F.col("m"), F.col("o"))).alias("rows"))
    one = materialize(whole.join(apart, "main").where(rows(F.col("m"), F.col("o")) <= F.col("rows"))
                      .select("main", F.col("m").alias("all_m"), F.col("o").alias("all_o")), "omh-one")
    own_group = F.when(F.col("all_m").isNotNull(), F.col("main")).otherwise(
        F.unhex(F.lpad(F.hex("bucket"), 16, "0")))
    grouped = (placed.join(one, "main", "left").select(
        own_group.alias("bucket"), "key", "class", "main",
        F.ceil(F.coalesce("all_o", "o") / block).cast("int").alias("others"),
        F.ceil(F.coalesce("all_m", "m") / block).cast("int").alias("mains")).distinct())
    own = F.when(in_main, F.col("others") + F.pmod(number, "mains")).otherwise(F.pmod(number, "others")).cast("int")
    last = F.when(in_main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    with_all = F.transform(F.sequence(F.lit(0), last.cast("int")), lambda o: F.struct(
        F.least("own", o).alias("i"), F.greatest("own", o).alias("j")))
    dealt = (grouped.withColumn("own", own)
             .select("bucket", "key", "class", "own", F.explode(with_all).alias("pair"))
             .select("bucket", "key", "class", "pair.i", "pair.j", (F.col("own") != F.col("pair.i")).cast("int").alias("side")))
    return led.union(_compared(dealt, texts, threshold, alike))


def _compared(dealt: DataFrame, texts: DataFrame, threshold: float, alike: float) -> DataFrame:
    """(a, b): links within each (bucket, i, j) of ``dealt`` (bucket, i, j, key, class, side)."""
    laid = (dealt.join(texts, "key").repartition(partitions_of(texts), "bucket", "i", "j")
            .sortWithinPartitions("bucket", "i", "j", "key"))

    def compare(batches):
        import pyarrow as pa

        def found(group):
            if len(group) < 2:
                return
            keys, sides, classes, tokens = zip(*group)
            pairs = [(keys[i], keys[j]) for i, j in compare_group(keys, tokens, sides, classes, threshold, alike)]
            if pairs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[s] for p in pairs], pa.binary()) for s in (0, 1)], names=["a", "b"])

        at, group = None, []
        for batch in batches:
            column = {n: batch.column(batch.schema.get_field_index(n))
                      for n in ("bucket", "i", "j", "key", "side", "class", "tokens")}
            flat, offsets = column["tokens"].values.to_numpy(), column["tokens"].offsets.to_numpy()
            places = zip(*[column[n].to_pylist() for n in ("bucket", "i", "j")])
            keys, sides, classes = (column[n].to_pylist() for n in ("key", "side", "class"))
            for row, place in enumerate(places):
                if place != at:
                    yield from found(group)
                    at, group = place, []
                group.append((keys[row], sides[row], classes[row], flat[offsets[row]:offsets[row + 1]].copy()))
        yield from found(group)
        del group
        give_back()

    return laid.mapInArrow(compare, "a binary, b binary")


def classify(base: DataFrame, repetitions: int = 24, length: int = 2, threshold: float = THRESHOLD,
             alike: float = ALIKE, block: int = 256, seed: int = 7) -> DataFrame:
    """(doc_id, text_md5, root, class_id) for each row of ``tokenized``: the least id of the row's class.

    ``root`` tells classes apart whose ids are repeated or null; it is null for a text without a word.

    Two texts are linked if their labelled five-word shingles have a Jaccard similarity of at least ``threshold``
    (wherever the shingles stand, so moved blocks count), or if banded alignment gives their words an edit similarity of
    at least ``alike``; a class is a connected set of links, and texts with equal words are in one. A pair of shingle
    similarity j meets in one of 24 repetitions of 2 k-mers with probability 1 - (1 - j * j) ** 24: 0.999 at 0.5, 0.98
    at 0.4. A text of under ten words has no edit within 0.9, one of fewer than five words is one shingle. A text
    without a word is a class of its own. Ids that are null do not count for the least id; repeated rows share a class. An empty table gives none.

    Texts that meet nobody never leave their sketch. A bucket is compared in blocks of about ``block`` texts, and
    two blocks at a time, so a group with a third of all rows is spread over many tasks, and only links that join
    classes come out. Copies of one text cost a comparison each; different texts of one bucket all their pairs.
    """
    edges = materialize(links(base, repetitions, length, threshold, alike, block, seed), "omh-links")
    roots = connected(edges)                             # (node, root), nodes with a link only
    least = base.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("own"))
    rooted = least.join(roots, least["key"] == roots["node"], "left").select(
        "key", "own", F.coalesce("root", "key").alias("root"))
    rooted = materialize(rooted, "omh-roots")
    # written, so that AQE can split a large class in the join
    moved = materialize(rooted.groupBy("root").agg(F.min("own").alias("class_id"), F.count("*").alias("n"))
                        .where("n > 1").drop("n"), "omh-least")
    classes = rooted.join(moved, "root", "left").select("key", "root", F.coalesce("class_id", "own").alias("class_id"))
    rows = base.select("doc_id", "text_md5", "key")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return rows.join(classes, "key", "left").select("doc_id", "text_md5", "root", own.alias("class_id"))


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``classify`` of a document table."""
    return classify(tokenized(docs, doc_id, text), **settings)


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each class: that with the least id, of several the one with the least MD5.

    A null id counts as larger than any other. Rows without a word stay. Rows repeated with one id and one text leave
    one row. Columns stay as they are. Only ids and MD5s are shuffled besides the documents.
    """
    named = materialize(near_classes(docs, doc_id, text, **settings).where(F.col("root").isNotNull()), "omh-classes")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_md5")
    first = materialize(named.groupBy("root").agg(F.min(order).alias("first")), "omh-first")
    placed = named.join(first, "root").withColumn(
        "stays", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_md5") == F.col("first.text_md5")))
    rows = materialize(placed.groupBy("doc_id", "text_md5", "stays").agg(F.count("*").alias("n")), "omh-stays")
    mark = docs.withColumn("_op_md5", F.md5(F.col(quoted(text))))

    def of(pairs):
        return mark[quoted(doc_id)].eqNullSafe(pairs["doc_id"]) & (mark["_op_md5"] == pairs["text_md5"])

    extra, repeated = rows.where("NOT stays"), rows.where("stays AND n > 1")
    if repeated.isEmpty():
        return mark.join(extra, of(extra), "left_anti").drop("_op_md5")
    both = extra.unionByName(repeated)
    once = mark.join(repeated, of(repeated), "left_semi").dropDuplicates([doc_id, "_op_md5"])
    return mark.join(both, of(both), "left_anti").unionByName(once).drop("_op_md5")
