"""Phrase collocations by set-oriented mining (SETM).

Occurrences are a persisted relation, sorted by piece and place within rows, parts of blocks of documents. A relation of frequent
phrases is merge-joined with itself at the next place, which makes the phrases one word longer whose both ends are
frequent; these are counted by group, and occurrences semi-joined with the frequent groups make the relation of the
next length. Before pairs are counted, bins of them are (the hash filter of Park, Chen and Yu, over 2^32 bins), and pairs
of bins that are not frequent are left out. The semi-join is a Bloom filter of fixed size: a group it lets through by mistake only costs time, since
no phrase that holds it can be counted often enough.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .common import give_back, quoted, small_batches, sub_batches, written

# What separates pieces, and the code of a piece end among word codes.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
_END = b"."

# A-Z in lower case, piece ends as one sign that no word can hold, tabs as spaces
_SIGNS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + PIECE_ENDS.encode() + b"\t",
                         b"abcdefghijklmnopqrstuvwxyz" + _END * len(PIECE_ENDS) + b" ")


def tokens_of(text: str | None) -> list[bytes]:
    """Words of a text with piece ends between them."""
    if not text:
        return []
    return text.encode().translate(_SIGNS).replace(_END, b" " + _END + b" ").split()


def _hash_start(spark, salt: int) -> int:
    """What ``xxhash64`` starts from after the salt, for hashing in tasks as Spark does."""
    return spark.range(1).select(F.xxhash64(F.lit(salt))).first()[0] & (1 << 64) - 1


def word_counts(docs: DataFrame, text: str, lang: str, block_words: int) -> DataFrame:
    """(lang, word, n) of each block of words; nothing is shuffled."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        codes, held, size = {}, {}, 0

        def flush():
            nonlocal size
            words = pa.array(list(codes), pa.binary()).cast(pa.string())
            for name, parts in held.items():
                found, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), words.take(pa.array(found)), pa.array(n)], names=["lang", "word", "n"])
            codes.clear()
            held.clear()
            size = 0
            give_back()

        for whole in batches:
            for batch in sub_batches(whole, "text", 2_000_000):
                for name, own in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                    found = [w for w in tokens_of(own) if w != _END]
                    for word in set(found).difference(codes):
                        codes[word] = len(codes)
                    held.setdefault(name, []).append(np.fromiter(map(codes.__getitem__, found), "i4", len(found)))
                    size += len(found)
                    if size >= block_words:
                        yield from flush()
        yield from flush()

    return _named(docs, text, lang).mapInArrow(count, "lang string, word string, n bigint")


def _named(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(quoted(lang)), F.lit("und")).alias("lang"), F.col(quoted(text)).alias("text"))


class Filter:
    """Bloom filter of ``2 ** bits`` bits over 64-bit ids, put together by Spark; a broadcast of fixed size."""

    def __init__(self, ids: DataFrame, bits: int):
        # three places from the bits of an id and of its hash; positions of Spark's bitmaps are counted within buckets
        self.bits, mask = bits, (1 << bits) - 1
        places = F.array(*[F.shiftrightunsigned(F.col("id"), i).bitwiseAND(mask) for i in (0, 19, 37)])
        at = ids.select(F.explode(places).alias("at")).select(
            F.shiftright("at", 15).alias("bucket"), F.col("at").bitwiseAND(32767).alias("bit"))
        buckets = at.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map")).collect()
        whole = bytearray(1 << max(bits - 3, 12))
        for bucket, part in buckets:
            whole[bucket * 4096:bucket * 4096 + len(part)] = part
        self.sent = ids.sparkSession.sparkContext.broadcast(bytes(whole))

    def lets(self, ids):
        import numpy as np

        whole, out = np.frombuffer(self.sent.value, "u1"), np.ones(len(ids), bool)
        for shift in (0, 19, 37):
            at = (ids.view("u8") >> np.uint64(shift)) & np.uint64((1 << self.bits) - 1)
            out &= (whole[at >> np.uint64(3)] >> (at & np.uint64(7)).astype("u1")) & 1 == 1
        return out


def row_starts(places, size: int):
    """Offsets of rows of about ``size`` occurrences, cut only where the next place is not held: no neighbours are parted."""
    import numpy as np

    gaps = np.flatnonzero(places[1:] != places[:-1] + 1) + 1
    at = np.searchsorted(gaps, np.arange(size, len(places), size))
    return np.concatenate([[0], np.unique(gaps[at[at < len(gaps)]]), [len(places)]]).astype("i4")


def word_relation(docs: DataFrame, text: str, lang: str, start: int, frequent: Filter, block_words: int,
                  row_words: int = 16_384) -> DataFrame:
    """(places, ids): occurrences of frequent words, sorted by place, in rows of about ``row_words`` of a block. A place
    counts piece ends too, so places of neighbouring words differ by one exactly within a piece. Written once."""

    def scan(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        codes, held, size = {}, [], 0

        def known(name, found):
            own = codes.get(name)
            if own is None:
                own = codes[name] = {_END: 0}
            seed = xxhash.xxh64_intdigest(name.encode(), start)
            for word in set(found).difference(own):
                own[word] = xxhash.xxh64_intdigest(word, seed)
            return np.fromiter(map(own.__getitem__, found), "u8", len(found)).view("i8")

        def block():
            nonlocal size
            ids = np.concatenate(held)
            # piece ends have the id 0, which no word has
            places = np.flatnonzero((ids != 0) & frequent.lets(ids)).astype("i4")
            offsets = pa.array(row_starts(places, row_words))
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (places, ids[places])],
                                              names=["places", "ids"])

        for whole in batches:
            for batch in sub_batches(whole, "text", 2_000_000):
                if sum(map(len, codes.values())) > 200_000:
                    codes.clear()
                for name, own in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                    found = tokens_of(own)
                    found.append(_END)
                    held.append(known(name, found))
                    size += len(found)
                    if size >= block_words:
                        yield block()
            give_back()
        if held:
            yield block()

    return _written(_named(docs, text, lang).mapInArrow(scan, _RELATION))


_RELATION = "places array<int>, ids array<bigint>"


def _written(relation: DataFrame) -> DataFrame:
    """A relation written once, so that a task reads it again in a few MB at a time.

    A reader holds up to 4096 rows of a row group at once, so sizes are looked at after every row. They are those of the
    plain values: no dictionary, and no page is compressed before its group ends. Arrays of few words would look short else.
    """
    size = 4 << 20
    return written(relation, "occurrences", size, **{
        "parquet.page.size.row.check.min": 1, "parquet.page.size": size, "parquet.enable.dictionary": False, "compression": "zstd"})


def _neighbours(batch):
    """(places, p, s) of neighbouring occurrences of each row of a batch: the merge join with the next place."""
    for i in range(batch.num_rows):
        places = batch.column("places").slice(i, 1).flatten().to_numpy(zero_copy_only=False)
        ids = batch.column("ids").slice(i, 1).flatten().to_numpy(zero_copy_only=False)
        next_to = places[1:] == places[:-1] + 1
        yield places[:-1][next_to], ids[:-1][next_to], ids[1:][next_to]


def pair_id(p, s):
    """64-bit id of the phrase made of the phrases ``p`` and ``s``, as an array."""
    import numpy as np

    with np.errstate(over="ignore"):
        mixed = p.view("u8") * np.uint64(_ODD[0]) + s.view("u8") * np.uint64(_ODD[1])
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(_ODD[0])
        return (mixed ^ (mixed >> np.uint64(29))).view("i8")


# Odd 64-bit multipliers.
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _sliced(batch, rows: int = 512):
    """A batch with long arrays in a few parts, as the JVM holds a whole one."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def pair_bins(relation: DataFrame, min_count: int, held_pairs: int = 3_000_000) -> DataFrame:
    """(id) of the bins that hold ``min_count`` pairs: a bin is 32 bits of a pair's id, so no frequent pair is outside.

    The bins of many blocks are counted together and go out as sorted arrays by their first bits, a few bytes a pair
    where a row of two ids takes 18. A count beyond ``min_count`` says no more than that.
    """

    def count(batches):
        import numpy as np
        import pyarrow as pa

        held, size = [], 0

        def flush():
            nonlocal size
            bins, n = np.unique(np.concatenate(held), return_counts=True)
            buckets, starts = np.unique(bins >> np.uint32(20), return_index=True)
            offsets = pa.array(np.append(starts, len(bins)).astype("i4"))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (bins.view("i4"), np.minimum(n, min_count).astype("i4"))]
            held.clear()
            size = 0
            give_back()
            yield from _sliced(pa.RecordBatch.from_arrays([pa.array(buckets.astype("i4")), *lists], names=["bucket", "bin", "n"]))

        for batch in batches:
            for _, p, s in _neighbours(batch):
                if len(p):
                    held.append((pair_id(p, s).view("u8") >> np.uint64(32)).astype("u4"))
                    size += len(p)
                if size >= held_pairs:
                    yield from flush()
        if held:
            yield from flush()

    # counted where the buckets are, with no further shuffle
    there = relation.mapInArrow(count, "bucket int, bin array<int>, n array<int>").repartition("bucket")
    counted = there.select("bucket", F.inline(F.arrays_zip("bin", "n"))).groupBy("bucket", "bin").agg(F.sum("n").alias("n"))
    low = F.col("bin").cast("bigint").bitwiseAND(0xFFFFFFFF)
    return counted.where(F.col("n") >= min_count).select(F.shiftleft(low, 32).bitwiseOR(low).alias("id"))


def pair_shares(relation: DataFrame, bins: Filter, held_pairs: int = 1_000_000) -> DataFrame:
    """(bucket, p, s, n): arrays of the pairs whose bin may be frequent, by the first bits of their ids.

    The pairs of many blocks are counted together, so rows grow with the blocks and not with the pairs that
    ``min_count`` lets through, of which a larger table has more in every block.
    """

    def count(batches):
        import numpy as np
        import pyarrow as pa

        found, held, fresh, size = [], [], 0, 0

        def add_up():
            nonlocal fresh, size
            p, s = [np.concatenate(x) for x in zip(*found)]
            p, s, _, n = _summed(p, s, np.ones(len(p), "i8"))
            held.append((p, s, n))
            found.clear()
            fresh = 0
            size += len(p)

        def flush():
            nonlocal size
            p, s, ids, n = _summed(*[np.concatenate(x) for x in zip(*held)])
            buckets, starts = np.unique(ids.view("u8") >> np.uint64(52), return_index=True)
            offsets = pa.array(np.append(starts, len(ids)).astype("i4"))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (p, s, n)]
            held.clear()
            size = 0
            give_back()
            yield from _sliced(pa.RecordBatch.from_arrays([pa.array(buckets.astype("i4")), *lists], names=["bucket", "p", "s", "n"]))

        for batch in batches:
            for _, p, s in _neighbours(batch):
                high = pair_id(p, s).view("u8") >> np.uint64(32)
                kept = bins.lets((high << np.uint64(32)) | high)
                if kept.any():
                    found.append((p[kept], s[kept]))
                    fresh += len(found[-1][0])
                # some rows on their own first, so what is held is less than a row an occurrence
                if found and fresh >= held_pairs // 2:
                    add_up()
                if size >= held_pairs:
                    yield from flush()
            give_back()
        if found:
            add_up()
        if held:
            yield from flush()

    return relation.mapInArrow(count, "bucket int, p array<bigint>, s array<bigint>, n array<bigint>")


def _summed(p, s, n):
    """(p, s, id, n) of the different pairs, sorted by the first 12 bits of their ids."""
    import numpy as np

    order = np.lexsort((s, p))
    p, s, n = p[order], s[order], n[order]
    starts = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (s[1:] != s[:-1])))
    p, s, n = p[starts], s[starts], np.add.reduceat(n, starts)
    ids = pair_id(p, s)
    order = np.argsort(ids.view("u8") >> np.uint64(52), kind="stable")
    return p[order], s[order], ids[order], n[order]


def pair_counts(relation: DataFrame, bins: Filter, min_count: int = 1) -> DataFrame:
    """(p, s, n, id) of the pairs whose bin may be frequent, found ``min_count`` times: a row a pair.

    A task adds up one bucket after the other; a pair stands in a bucket once for every flush of its blocks.
    """

    def add(batches):
        import numpy as np
        import pyarrow as pa

        held, bucket = [], None

        def flush():
            p, s, ids, n = _summed(*[np.concatenate(x) for x in zip(*held)])
            held.clear()
            kept = n >= min_count
            return pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (p, s, n, ids)], names=["p", "s", "n", "id"])

        for batch in batches:
            buckets = batch.column("bucket").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])) if len(buckets) else []
            for start, end in zip(starts, [*starts[1:], len(buckets)]):
                if held and buckets[start] != bucket:
                    yield flush()
                bucket = buckets[start]
                part = batch.slice(start, end - start)
                held.append(tuple(part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("p", "s", "n")))
        if held:
            yield flush()

    there = pair_shares(relation, bins).repartition("bucket").sortWithinPartitions("bucket")
    return there.mapInArrow(add, "p bigint, s bigint, n bigint, id bigint")


def next_relation(relation: DataFrame, frequent: Filter) -> DataFrame:
    """The relation of the phrases one word longer, semi-joined with the frequent ones; written once."""

    def extend(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            found = []
            for places, p, s in _neighbours(batch):
                ids = pair_id(p, s)
                kept = frequent.lets(ids)
                found.append((places[kept], ids[kept]))
            if found:
                offsets = pa.array(np.cumsum([0, *[len(x) for x, _ in found]]).astype("i4"))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in zip(*found)],
                                                 names=["places", "ids"])
            give_back()

    return _written(relation.mapInArrow(extend, _RELATION))


def frequent_phrases(docs: DataFrame, min_count: int = 100, longest: int = 5, text: str = "text", lang: str = "lang",
                     block_words: int = 500_000, filter_bits: int = 26) -> tuple[list[DataFrame], DataFrame]:
    """Phrases of 1, 2, ... ``longest`` words found ``min_count`` times in a language, and (lang, n) of all words.

    Each is (id, lang, words, f, heads, tails, p, s): ``heads[i]`` counts the first i + 1 words, ``tails[i]`` the last
    i + 1, ``p`` and ``s`` are the phrases without the last and without the first word. Occurrences overlap. Groups are
    counted by the ids of both, words by their text. Ids of words are hashes that no two words of the table share
    (another salt is taken otherwise); two frequent phrases of one id are an error.
    """
    spark = docs.sparkSession
    counted = materialize(word_counts(docs, text, lang, block_words).groupBy("lang", "word").agg(F.sum("n").alias("f")), "word-counts")
    totals = materialize(counted.groupBy("lang").agg(F.sum("f").alias("n")), "word-totals")
    words, salt = counted.count(), 0
    while counted.select(F.xxhash64(F.lit(salt), "lang", "word").alias("id")).where("id <> 0").distinct().count() < words:
        salt += 1
    none = F.lit(None).cast("bigint")
    singles = counted.where(F.col("f") >= min_count).select(
        F.xxhash64(F.lit(salt), "lang", "word").alias("id"), "lang", F.array("word").alias("words"), "f",
        F.array("f").alias("heads"), F.array("f").alias("tails"), none.alias("p"), none.alias("s"))
    levels = [materialize(singles, "phrases")]
    relation = word_relation(docs, text, lang, _hash_start(spark, salt), Filter(levels[0].select("id"), filter_bits), block_words)
    for length in range(2, longest + 1):
        bins = Filter(pair_bins(relation, min_count), filter_bits)
        groups = pair_counts(relation, bins, min_count).withColumnRenamed("n", "f")
        known = levels[-1]
        heads = known.select(F.col("id").alias("p"), "lang", "words", "heads")
        tails = known.select(F.col("id").alias("s"), F.element_at("words", -1).alias("last"), "tails")
        longer = groups.join(heads, "p").join(tails, "s").select(
            "id", "lang", F.array_append("words", F.col("last")).alias("words"), "f",
            F.array_append("heads", F.col("f")).alias("heads"), F.array_append("tails", F.col("f")).alias("tails"), "p", "s")
        levels.append(materialize(longer, "phrases"))
        ids = levels[-1].select("id")
        found, different = ids.agg(F.count("id"), F.countDistinct("id")).first()
        if found != different:
            raise ValueError("two frequent phrases have one 64-bit id")
        if length < longest:
            relation = next_relation(relation, Filter(ids, filter_bits))
    return levels, totals


def collocations(docs: DataFrame, min_count: int = 100, longest: int = 5, top: int = 2000, text: str = "text",
                 lang: str = "lang", block_words: int = 500_000, filter_bits: int = 26) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z count as a-z, pieces end at ``.,;:!?`` and line ends (U+000A to U+000D), words are parted by spaces and tabs; a
    null text is empty and a null language ``und``. A phrase of 2 to ``longest`` words with ``a`` occurrences scores
    floor(1000 * a * n / (l * r)) for the cut that scores least (ties: the shortest first part), ``l`` and ``r`` being
    the counts of its parts and ``n`` that of all words. A phrase is dropped if one longer phrase that holds it is as
    frequent. Order: score, then ``a``, both descending, then the phrase by its UTF-8 bytes; phrases of a language
    differ, so there are no ties. An empty table gives no rows; further columns are not looked at. Products are decimals of 38 digits, exact
    up to a * n of 10^35.

    A word or phrase of a third of all places is one row per block before any shuffle, and only a language's
    best ``top`` of each task come together.
    """
    with small_batches(docs.sparkSession):
        levels, totals = frequent_phrases(docs, min_count, longest, text, lang, block_words, filter_bits)
    kept = []
    for i, level in enumerate(levels[1:], 1):
        if i + 1 < len(levels):
            longer = levels[i + 1]
            inside = longer.where(F.col("f") >= F.element_at("heads", -2)).select(F.col("p").alias("id")).union(
                longer.where(F.col("f") >= F.element_at("tails", -2)).select(F.col("s").alias("id")))
            level = level.join(inside.distinct(), "id", "left_anti")
        kept.append(level.select("lang", "words", "f", "heads", "tails"))
    if not kept:
        kept = [levels[0].where(F.lit(False)).select("lang", "words", "f", "heads", "tails")]
    both = reduce(DataFrame.unionByName, kept).join(totals, "lang")
    cut = F.expr("""array_min(transform(sequence(1, size(words) - 1), k -> named_struct(
        'score', (CAST(1000 AS DECIMAL(38, 0)) * f * n) div (CAST(heads[k - 1] AS DECIMAL(38, 0)) * tails[size(words) - k - 1]),
        'k', k, 'l', heads[k - 1], 'r', tails[size(words) - k - 1])))""")
    scored = both.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "n", cut.alias("c")).select(
        "lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").cast("bigint").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
