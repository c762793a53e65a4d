"""Substring dedup, cross-tokenizer alignment and collocations against plain versions, and on odd tables."""

import hashlib
import os
import random
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from tableport.llm import alignment, phrases, queries, substrings  # noqa: E402

ROOT = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# substring dedup

def mixed(seed, rows, passages=6, words=40):
    """Documents of a small vocabulary that share passages at random places, in different contexts."""
    rnd = random.Random(seed)
    shared = [[f"p{j}x{i}" for i in range(rnd.randint(5, 30))] for j in range(passages)]
    out = []
    for d in range(rows):
        text = []
        for _ in range(rnd.randint(0, 4)):
            text += [rnd.choice("abcdefgh") + str(rnd.randint(0, words)) for _ in range(rnd.randint(0, 12))]
            text += rnd.choice(shared)[rnd.randint(0, 3):]
        out.append((d if d % 7 else d // 2, rnd.choice([" ", "\n", "\t "]).join(text)))
    return out


def check_substrings(spark, rows, window, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in substrings.remove_repeats(docs, window=window, **settings).collect()]
    want = [(own, None if text is None else " ".join(kept), len(words), len(words) - len(kept))
            for (own, text), (words, kept) in zip(rows, brute.without_repeats(rows, window))]
    assert Counter(got) == Counter(want)
    return sum(n for *_, n in want)


@pytest.mark.parametrize("window,gram,settings", [
    (8, 3, {}), (8, 8, {"shard_words": 200}), (10, 1, {"shard_words": 50, "max_group": 2}), (12, 4, {"max_group": 1})])
def test_repeats_against_plain_windows(spark, window, gram, settings):
    assert check_substrings(spark, mixed(window, 120), window, gram=gram, **settings) > 100


def test_repeats_in_periodic_and_nested_texts(spark):
    tune = " ".join(["la"] * 90)
    rows = [(1, tune), (2, "la " * 40 + "x"), (3, " ".join(["la", "di"] * 30)), (4, "di " + " ".join(["la", "di"] * 20)), (5, tune + " end"),
            (0, "start " + " ".join(["la"] * 12)), (7, "short"), (8, None), (None, tune), (9, "")]
    for gram in (1, 4, 10):
        assert check_substrings(spark, rows, 10, gram=gram, max_group=1) > 0


def test_repeats_only_count_smaller_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (5, text), (5, text + " more"), (None, text), (9, "before " + text + " after"), (12, " ".join(f"w{i}" for i in range(49)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Spans", F.lit(1)).withColumn("n_words", F.lit("x"))
    got = substrings.remove_repeats(docs)
    assert got.columns == ["doc_id", "text", "n_words", "n_removed"]
    assert {(r["doc_id"], r["n_removed"]) for r in got.collect()} == {(5, 0), (None, 0), (9, 60), (12, 0)}
    assert got.where("doc_id = 9").first()["text"] == "before after"


def test_repeats_of_odd_tables(spark, odd_docs, no_docs):
    assert substrings.remove_repeats(no_docs).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in substrings.remove_repeats(odd_docs).collect()}
    assert got == {(own, len(words), 0) for (own, _), (words, _) in zip(rows, brute.without_repeats(rows, 10**9))}
    words = spark.createDataFrame([("b", "x y z x y z"), ("a", "q x y z")], "doc_id string, text string")
    assert {tuple(r) for r in substrings.remove_repeats(words, window=3, gram=2).collect()} == {("b", "", 6, 6), ("a", "q x y z", 4, 0)}


def test_automaton_knows_the_least_id_of_each_window():
    rnd = random.Random(4)
    texts = [(rnd.randint(0, 9), [rnd.choice("ab") for _ in range(rnd.randint(1, 30))]) for _ in range(40)]
    automaton = substrings.Automaton()
    for own, words in texts:
        automaton.add(words, own)
    automaton.finish()
    for _, words in [*texts, (0, [rnd.choice("abc") for _ in range(200)])]:
        got = automaton.first_ids(words, 4)
        for i, first in enumerate(got):
            holders = [own for own, other in texts if any(other[j:j + 4] == words[i:i + 4] for j in range(len(other) - 3))]
            assert first == min(holders, default=None)


def test_equal_windows_have_equal_anchors():
    rnd = np.random.default_rng(3)
    words = rnd.integers(0, 3, 500).astype("u8") * np.uint64(0x9E3779B97F4A7C15)
    doc = np.repeat(np.arange(5), 100)
    row, at, n, anchor, c1, c2 = substrings.runs_of(words, doc, 6, 3)
    windows = sorted(s for a, m in zip(at, n) for s in range(a, a + m))
    assert windows == [s for s in range(495) if doc[s] == doc[s + 5]] and n.max() <= 4
    seen = {}
    for a, m, key in zip(at, n, anchor):
        for s in range(a, a + m):
            assert seen.setdefault(tuple(words[s:s + 6]), key) == key
    one = substrings.runs_of(words, doc, 6, 3, np.sort(anchor[:1]))
    assert sorted(one[1]) == sorted(s for a, m, key in zip(at, n, anchor) if key == anchor[0] for s in range(a, a + m))


# alignment

@pytest.fixture(scope="module")
def tokenizers():
    pair = alignment.Pair(alignment.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json")), queries.piece_model())
    return pair


def check_alignment(spark, pair, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    aligned = alignment.align_texts(docs, alignment.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json")), queries.piece_model(), batch_bytes=3_000)
    got = {r["doc_id"]: r for r in alignment.score_links(aligned, **settings).collect()}
    plain = brute.alignment(rows, pair.a, pair.b, pair.a_bytes, pair.b_bytes)
    counts, best = Counter(x for *_, links in plain.values() for x in links), Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    assert len(got) == len(rows)
    for own, (a, b, groups, links) in plain.items():
        want = (own, len(a), len(b), groups.count(";") + bool(groups), len(links), groups,
                sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links))
        r = got[own]
        assert (own, r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups"], r["n_best"], r["count_sum"]) == want
    return counts


ODD_TEXTS = ["", None, " ", "  two  spaces ", "\n", "a\n b \tc", "<|endoftext|> <s> </s> <unk>", "▁", "one ▁ two", "x▁ y", "a ▁b c", "café naïve",
             "é ‍  x  y", "日本語 のテキスト", "👨‍👩‍👧 family 👨", "\x00 \x1c a\x1f b", "don't  'll we'll", "½ ① Ａ ﬁ", "\U0010FFFF", "a" * 3000,
             " lead", "trail ", "x y 　 z", "1234567 89 0.5", "\r\n\r\n", "é" * 2000, "᠎ a ᠎", "a \x85 b"]


@pytest.mark.parametrize("limit", [1 << 20, 50, 0])
def test_alignment_of_odd_texts(spark, tokenizers, limit):
    rnd = random.Random(limit)
    signs = ["a", "é", " ", "  ", "\n", "日", "👨", "'s", "12", "-", "\t", "<s>", "Zx", "́", " ", "the ", "of "]
    rows = [(i, t) for i, t in enumerate([*ODD_TEXTS, *("".join(rnd.choices(signs, k=rnd.randint(1, 40))) for _ in range(300))])]
    assert len(check_alignment(spark, tokenizers, rows, max_broadcast=limit)) > 60


def test_alignment_with_a_table_that_starts_anew(tokenizers):
    table = alignment.AlignedChunks(tokenizers, max_chunks=3)
    texts = ["one two three four", "four three  two", "▁ x", "one ▁ x"]
    first = [[table.groups[c] for c in row] for row in table.code(texts)]
    assert table.full()
    for _ in range(3):
        table.trim()
        assert len(table.codes) <= 1
        assert [[table.groups[c] for c in row] for row in table.code(texts)] == first and first[2] == [] == first[3]


def test_alignment_of_odd_tables(spark, odd_docs, no_docs, tokenizers):
    a_json = alignment.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert alignment.score_links(alignment.align_texts(no_docs, a_json, queries.piece_model())).count() == 0
    clash = odd_docs.withColumn("Links", F.lit(1)).withColumn("n_best", F.lit("x"))
    got = alignment.score_links(alignment.align_texts(clash, a_json, queries.piece_model()))
    assert got.columns == [*odd_docs.columns, "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    rows = got.collect()
    assert len(rows) == 13 and all((r["n_a"] == 0) == (not r["text"] or "▁" in r["text"]) for r in rows)
    twice = [r["count_sum"] for r in rows if r["doc_id"] == 5]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_alignment_query_digest(spark, tokenizers):
    rows = {r["doc_id"]: r for r in queries.op12_token_alignment(spark, ROOT).collect()}
    texts = spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text").limit(20).collect()
    for own, (a, _, groups, _) in brute.alignment(texts, tokenizers.a, tokenizers.b, tokenizers.a_bytes, tokenizers.b_bytes).items():
        assert rows[own]["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if a else "")


# collocations

def spoken(seed, n):
    rnd = random.Random(seed)
    parts = ["New York", "the cat sat", "of the", "a b a b a", "x", "ÉTÉ été", "to be or not to be", "q\tz", "Σ", "co-op"]
    return [(i, rnd.choice([" ", ", ", ". ", "\n", "  ", "\r"]).join(rnd.choices(parts, k=rnd.randint(0, 9))),
             rnd.choice(["en", "fr", None, "und"]), "s", 1) for i in range(n)]


@pytest.mark.parametrize("least,longest,top,block,bits", [(3, 5, 2000, 50, 26), (8, 3, 4, 1_000_000, 15), (20, 5, 10, 7, 5)])
def test_collocations_against_plain_counts(spark, least, longest, top, block, bits):
    rows = spoken(least, 300)
    docs = spark.createDataFrame(rows, DOCS).withColumn("rank", F.lit(1)).withColumn("n", F.lit("x"))
    got = phrases.collocations(docs, least, longest, top, block_words=block, filter_bits=bits)
    assert got.dtypes == [(c, "string" if c in ("lang", "phrase") else "bigint") for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")]
    want = brute.collocations([(r[1], r[2]) for r in rows], least, longest, top)
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_collocations_of_odd_tables(spark, odd_docs, no_docs):
    assert phrases.collocations(no_docs).count() == 0
    assert phrases.collocations(odd_docs, longest=1).count() == 0
    rows = [(r["text"], r["lang"]) for r in odd_docs.collect()]
    assert sorted(map(tuple, phrases.collocations(odd_docs, 2).collect())) == sorted(brute.collocations(rows, 2, 5, 2000))


def test_hashes_in_tasks_are_those_of_spark(spark):
    import xxhash

    rows = [("en", "word"), ("und", ""), ("fr", "été" * 30), ("", "x")]
    start = phrases._hash_start(spark, 3)
    got = spark.createDataFrame(rows, "lang string, word string").select("lang", "word", F.xxhash64(F.lit(3), "lang", "word")).collect()
    for lang, word, value in got:
        assert xxhash.xxh64_intdigest(word.encode(), xxhash.xxh64_intdigest(lang.encode(), start)) == value & (1 << 64) - 1


def test_filter_lets_its_ids_through(spark):
    ids = np.random.default_rng(2).integers(-2**63, 2**63, 5000)
    known = spark.createDataFrame([(int(i),) for i in ids[:2500]], "id long")
    lets = phrases.Filter(known, 20).lets(ids)
    assert lets[:2500].all() and lets[2500:].mean() < 0.05


def test_scores_beyond_64_bits(spark):
    big = 4_000_000_000
    expr = "(CAST(1000 AS DECIMAL(38, 0)) * f * n) div (CAST(l AS DECIMAL(38, 0)) * r)"
    row = spark.createDataFrame([(big, 9 * big, 2 * big, 3 * big)], "f long, n long, l long, r long").selectExpr(expr).first()
    assert row[0] == 1000 * big * 9 * big // (6 * big * big)


def test_bins_of_frequent_pairs_hold_them_and_little_else(spark):
    """Pairs are counted only in frequent bins: rare ones are left out before the shuffle, counts of the others are exact."""
    ids = [1, 2, 3, 1, 2, 4, 1, 2, 5, 6]                 # the pair (1, 2) three times, the others once
    relation = spark.createDataFrame([(list(range(10)), ids), ([0, 1, 5], [1, 2, 3])], phrases._RELATION).repartition(2)
    for held in (1, 100):
        bins = phrases.pair_bins(relation, 4, held)
        assert bins.count() == 1
        found = phrases.pair_counts(relation, phrases.Filter(bins, 20)).groupBy("p", "s").sum("n").collect()
        assert [tuple(r) for r in found] == [(1, 2, 4)]


def test_a_pair_is_one_row_however_many_blocks_hold_it(spark):
    rnd = np.random.default_rng(5)
    blocks = [rnd.integers(1, 9, 200).tolist() for _ in range(60)]
    relation = spark.createDataFrame([(list(range(200)), ids) for ids in blocks], phrases._RELATION).repartition(4)
    want = Counter(pair for ids in blocks for pair in zip(ids, ids[1:]))
    bins = phrases.Filter(phrases.pair_bins(relation, 1), 20)
    got = phrases.pair_counts(relation, bins).select("p", "s", "n").collect()
    assert len(got) == len(want) and {(p, s): n for p, s, n in got} == want
    shares = [phrases.pair_shares(relation, bins, held) for held in (1, 1_000_000)]
    assert shares[0].count() > 60 * 32 and shares[1].count() <= 4 * 64    # a row a bucket and flush
    for found in shares:
        total = found.select(F.inline(F.arrays_zip("p", "s", "n"))).groupBy("p", "s").sum("n").collect()
        assert {(p, s): n for p, s, n in total} == want
    half = sorted(want.values())[32]
    assert {tuple(r) for r in phrases.pair_counts(relation, bins, half).select("p", "s", "n").collect()} == {
        (*pair, n) for pair, n in want.items() if n >= half}


def test_occurrences_are_read_in_small_groups(spark):
    """A task reads a row group as a whole, and a group ended only after 100 rows, each a block of half a million words."""
    rnd = random.Random(1)
    texts = [". ".join(" ".join(rnd.choices("abcd", k=8)) for _ in range(4_000)) for _ in range(40)]
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").coalesce(1)
    start = phrases._hash_start(spark, 0)
    words = spark.createDataFrame([("en", w) for w in "abcd"], "lang string, word string")
    frequent = phrases.Filter(words.select(F.xxhash64(F.lit(0), "lang", "word").alias("id")), 20)
    relation = phrases.word_relation(docs, "text", "lang", start, frequent, 500_000)
    pairs = phrases.pair_counts(relation, phrases.Filter(phrases.pair_bins(relation, 1), 20)).select("id")
    for level in (relation, phrases.next_relation(relation, phrases.Filter(pairs, 20))):
        groups = []
        for name in level.inputFiles():
            meta = pq.ParquetFile(name.removeprefix("file:")).metadata
            groups += [meta.row_group(i).column(1).num_values for i in range(meta.num_row_groups)]
        assert max(groups) < 500_000 < sum(groups)       # of 12 bytes each
    held = relation.select(F.size("ids").alias("n")).agg(F.sum("n"), F.max("n")).first()
    assert held[0] == 40 * 4_000 * 8 and held[1] < 20_000


def test_rows_are_cut_between_pieces_only(spark):
    """Neighbours stay in one row, so pairs are the same however long the rows are."""
    places = np.array([0, 1, 2, 4, 5, 6, 7, 8, 10, 12, 13], "i4")
    for size, want in ((1, [0, 3, 8, 9, 11]), (4, [0, 8, 11]), (9, [0, 9, 11]), (50, [0, 11])):
        assert phrases.row_starts(places, size).tolist() == want
    assert phrases.row_starts(places[:0], 4).tolist() == [0, 0] and phrases.row_starts(places[:3], 1).tolist() == [0, 3]
    docs = spark.createDataFrame([(r[1], r[2]) for r in spoken(9, 200)], "text string, lang string").coalesce(2)
    start = phrases._hash_start(spark, 0)
    words = phrases.word_counts(docs, "text", "lang", 1_000).select("lang", "word").distinct()
    frequent = phrases.Filter(words.select(F.xxhash64(F.lit(0), "lang", "word").alias("id")), 20)
    found = []
    for size in (3, 1_000_000):
        relation = phrases.word_relation(docs, "text", "lang", start, frequent, 500, size)
        bins = phrases.Filter(phrases.pair_bins(relation, 1), 20)
        found.append((relation.count(), sorted(map(tuple, phrases.pair_counts(relation, bins, 1).collect()))))
    assert found[0][0] > 10 * found[1][0] and found[0][1] == found[1][1] != []
