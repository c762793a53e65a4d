"""Each operator against a plain version, and on odd tables."""

import hashlib
import heapq
import os
import random
import sys
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from tableport.llm import (  # noqa: E402
    components, decontam, langid, licenses, linespread, maxscore, ordermin, pieces, queries, sharding, urlrules, warc)


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# sharding

def loads(assigned):
    out = defaultdict(lambda: [0, 0])
    for shard, page, size in rows(assigned, "shard", "page", "row_bytes"):
        out[shard, page][0] += size
        out[shard, page][1] += 1
    return out


def test_shards_fit_and_split_only_where_needed(spark):
    random.seed(1)
    docs = spark.createDataFrame([(i, "é" * random.randint(0, 400)) for i in range(3000)], "doc_id long, text string")
    limit = 20_000
    got = loads(sharding.assign_shards(docs, limit, finer=2))
    assert sum(n for _, n in got.values()) == 3000 and all(size <= limit for size, _ in got.values())
    shards = sorted(s for s, _ in got)
    assert all(not b.startswith(a) for a, b in zip(shards, shards[1:]))
    for shard in shards:                                 # without the last bit the bucket would be too large
        assert sum(size for (s, _), (size, _) in got.items() if s.startswith(shard[:-1])) > limit


def test_hot_key_gets_overflow_pages(spark):
    docs = spark.createDataFrame([(7 if i % 3 == 0 else i, f"{i:06d}" * 10) for i in range(3000)], "doc_id long, text string")
    got = loads(sharding.assign_shards(docs, 5000))
    assert sum(n for _, n in got.values()) == 3000 and all(size <= 5000 for size, _ in got.values())
    assert sum(page != "" for _, page in got) >= 12


def test_shards_of_odd_tables(spark, odd_docs, no_docs):
    assert sharding.assign_shards(no_docs, 100).count() == 0
    got = sharding.assign_shards(odd_docs.withColumn("Shard", F.lit(1)), 1000)
    assert got.count() == odd_docs.count() and got.columns.count("shard") == 1 and "Shard" not in got.columns
    assert max(loads(got).values())[1] == 1              # a row over the limit is alone
    same = spark.createDataFrame([(1, "x" * 80)] * 5, "doc_id long, text string")
    assert list(loads(sharding.assign_shards(same, 100)).values()) == [[400, 5]]


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i or None, f"text {i}" * 5) for i in range(200)], "doc_id long, text string")
    assigned = sharding.assign_shards(docs, 1000)
    sharding.write_shards(docs, assigned, str(tmp_path / "shards"))
    back = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(str(tmp_path / "shards"))
    assert set(rows(back, "doc_id", "text")) == set(rows(docs, "doc_id", "text")) and back.count() == 200


# license scans

@pytest.mark.parametrize("number", range(len(licenses.TEMPLATES)))
def test_every_template_is_found(number):
    name, text = licenses.TEMPLATES[number]
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.15, 0.1, 6)
    words = text.split(" ")
    wrapped = "\n".join(" ".join(words[i:i + 11]) for i in range(0, len(words), 11))
    for body in (text, wrapped, text.upper()):
        found = list(scanner.scan(f"some words\nbefore it\n{body}\nand then quite other words"))
        if number == 4:                                  # the shorter notice is the start of the longer one
            assert found and found[0][0].startswith("BSD")
        else:
            assert [f[0] for f in found] == [name] or name in [f[0] for f in found], found


def test_wording_decides_between_close_templates():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.15, 0.1, 6)
    for version in (2, 3):
        line = f"This work is licensed under the GNU General Public License, version {version}."
        assert [(f[0], f[4]) for f in scanner.scan("x\n" + line)] == [(f"GPL-{version}.0", 0)]
    assert not list(scanner.scan("permission to enter the hall is licensed by nobody at all"))


def test_notice_inside_a_very_long_line():
    import time

    scanner = licenses.Scanner(licenses.TEMPLATES, 0.15, 0.1, 6)
    filler = " ".join(f"word{i}" for i in range(40_000))
    start = time.time()
    found = list(scanner.scan(f"{filler} {licenses.TEMPLATES[0][1]} {filler} a license of another kind {filler}"))
    assert [(f[0], f[4]) for f in found] == [("MIT", 0)] and time.time() - start < 20


@pytest.mark.parametrize("number", range(len(licenses.TEMPLATES)))
def test_text_around_a_notice_does_not_hide_it(number, small_docs):
    name, text = licenses.TEMPLATES[number]
    prose = " ".join(" ".join(t.split()) for _, t, *_ in small_docs if t and not any(c.split()[0] in t.lower() for c in licenses.CUES))
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.15, 0.1, 6)
    for size in (0, 145, 400, 1600, 9000):
        assert [(f[0], f[4]) for f in scanner.scan(f"{prose[:size]} {text} {prose[-size:]}")] == [(name, 0)]


def test_each_neighbouring_notice_gives_a_row():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.15, 0.1, 6)
    pair = "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."
    assert [(f[0], f[1], f[2], f[4]) for f in scanner.scan(pair)] == [("Apache-2.0", 0, 0, 0), ("MIT", 1, 1, 0)]
    assert [f[0] for f in scanner.scan(pair.replace("\n", " "))] == ["Apache-2.0", "MIT"]
    every = [(name, n, n, 0) for n, (name, _) in enumerate(licenses.TEMPLATES)]
    assert [(*f[:3], f[4]) for f in scanner.scan("\n".join(t for _, t in licenses.TEMPLATES))] == every


def plain_notices(text):
    """The best template of each cue line by wording alone."""
    for n, line in enumerate((text or "").split("\n")):
        if any(c in line.lower() for c in licenses.CUES):
            words = licenses.words_of(line)
            off = [(licenses.differences(w, words), name, len(w)) for name, t in licenses.TEMPLATES for w in [licenses.words_of(t)]]
            fits = [(d, name) for d, name, size in off if d <= int(0.1 * size)]
            if fits:
                yield n, min(fits)[1], min(fits)[0]


def test_notices_of_the_corpus(spark, small_docs):
    docs = spark.createDataFrame(small_docs, "doc_id long, text string, lang string, source string, n_chars long")
    want = sorted((d, *notice) for d, text, *_ in small_docs for notice in plain_notices(text))
    assert sorted(rows(licenses.scan_licenses(docs), "doc_id", "first_line", "license", "differences")) == want and want


def test_notices_of_odd_tables(odd_docs, no_docs):
    assert licenses.scan_licenses(no_docs).count() == 0 == licenses.scan_licenses(odd_docs).count()
    clash = odd_docs.withColumn("License", F.lit("x")).withColumn("text", F.concat("text", F.lit("\nAll rights reserved.")))
    got = licenses.scan_licenses(clash)
    assert got.count() == odd_docs.where("text is not null").count() and {r[0] for r in rows(got, "license")} == {"proprietary"}


# order MinHash

def test_edit_distance():
    random.seed(2)
    for _ in range(400):
        a = [random.randint(0, 3) for _ in range(random.randint(0, 20))]
        b = [x for x in a if random.random() < 0.85]
        b.insert(random.randint(0, len(b)), 9)
        most, true = random.randint(0, 10), brute.edits(a, b)
        for cells in (0, 10 ** 6):
            assert ordermin.edit_distance(a, b, most, cells) == (true if true <= most else None)


def test_sketch_keeps_text_order():
    seeds = np.random.default_rng(0).integers(0, 1 << 63, 8, dtype="u8")
    forward = ordermin.labelled_shingles(list(range(40)))
    swapped = np.concatenate((forward[20:], forward[:20]))
    assert set(forward) == set(swapped)
    assert (ordermin.sketch(forward, seeds, 3) != ordermin.sketch(swapped, seeds, 3)).any()
    assert len(set(ordermin.labelled_shingles([1] * 30))) == 26


def test_classes_against_all_pairs(spark, small_docs):
    docs = spark.createDataFrame(small_docs, "doc_id long, text string, lang string, source string, n_chars long")
    want = brute.classes([(d, t) for d, t, *_ in small_docs])
    assert dict(rows(ordermin.near_classes(docs), "doc_id", "class_id")) == {r[0]: want[i] for i, r in enumerate(small_docs)}


def test_large_group_in_blocks(spark):
    random.seed(4)
    base = [f"w{random.randint(0, 5000)}" for _ in range(120)]
    texts = []
    for i in range(150):
        own = list(base)
        for _ in range(random.randint(0, 6)):
            own[random.randrange(120)] = f"new{random.random()}"
        texts.append((i, " ".join(own)))
    texts += [(1000 + i, texts[0][1].upper() + "!") for i in range(100)] + [(2000 + i, f"lone text number {i} " * 3) for i in range(5)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = brute.classes(texts)
    got = dict(rows(ordermin.near_classes(docs, block=16), "doc_id", "class_id"))
    assert got == {t[0]: want[i] for i, t in enumerate(texts)}
    kept = sorted(r[0] for r in rows(ordermin.first_of_each(docs, block=16), "doc_id"))
    assert kept == sorted(set(want.values()))


def test_edited_and_moved_copies_are_found(spark):
    random.seed(6)
    texts = []
    for i in range(150):
        base = [f"w{random.randint(0, 9000)}" for _ in range(random.randint(60, 400))]
        copy = list(base)
        for at in random.sample(range(len(base)), int(len(base) * (0.05 if i < 100 else 0.085)) if i < 140 else 0):
            if random.random() < 0.6:
                copy[at] = f"new{random.getrandbits(40)}"
            else:
                copy[at] = copy[at] + f" more{random.getrandbits(40)}"
        if i >= 140:                                    # the first third moved to the end
            copy = copy[len(copy) // 3:] + copy[:len(copy) // 3]
        texts += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    got = dict(rows(ordermin.near_classes(spark.createDataFrame(texts, "doc_id long, text string")), "doc_id", "class_id"))
    for low, high in ((0, 100), (100, 140), (140, 150)):
        found = sum(got[2 * i + 1] == 2 * i for i in range(low, high))
        assert found >= 0.98 * (high - low)
    assert all(got[2 * i] == 2 * i for i in range(150))


def test_joined_texts_are_not_compared_again():
    base = np.arange(60)
    group = [base, np.append(base[1:], 7), np.append(base[2:], [8, 9])]
    every = list(ordermin.compare_group("abc", group, [0, 0, 0], "abc"))
    assert every == [(0, 1), (0, 2)]
    assert list(ordermin.compare_group("abc", group, [0, 0, 0], "xxc")) == [(0, 2)]
    assert list(ordermin.compare_group("abc", group, [0, 1, 1], "axx")) == [(0, 1)]


def test_classes_of_odd_tables(spark, odd_docs, no_docs):
    assert ordermin.near_classes(no_docs).count() == 0 == ordermin.first_of_each(no_docs).count()
    data = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    want = brute.classes(data)
    got = sorted(map(repr, rows(ordermin.near_classes(odd_docs), "doc_id", "class_id")))
    expected = [(d, d if not brute.shingles(t)[0] else want[i]) for i, (d, t) in enumerate(data)]
    assert got == sorted(map(repr, expected))
    kept = rows(ordermin.first_of_each(odd_docs.withColumn("class_id", F.lit(0))), "doc_id", "text")
    # the row without an id is a class of its own, and so are both texts of id 6; 9 and 10 hold the same single word
    assert len(kept) == len(data) - 2 and kept.count((5, "the same words in this row")) == 1 and (10, "x") not in kept


def test_components(spark):
    random.seed(5)
    pairs = [(i, i + 1) for i in range(60)] + [(random.randint(100, 400), random.randint(100, 400)) for _ in range(150)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = rows(components.connected(spark.createDataFrame(pairs, "a long, b long")), "node", "root")
    assert dict(got) == {x: find(x) for x in root} and len(got) == len(root)


# language

def test_language_of_texts_never_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    network = langid.train_network(docs.where(~langid.held_out()))
    named = langid.identify(docs, network).where(langid.held_out()).select((F.col("lang") == F.col("lang_pred")).cast("int"), "score")
    right = [tuple(r) for r in named.collect()]
    assert len(right) > 250 and sum(r[0] for r in right) / len(right) > 0.98 and all(0 <= s <= 1 for _, s in right)


def test_network_learns_by_its_gradient():
    """Numeric derivative of the loss against the backward pass: a step down the gradient lowers the loss."""
    network = langid.ByteNetwork(["a", "b"])
    x = np.concatenate([langid.windows(bytes([65 + i % 3] * 100)) for i in range(8)] + [langid.windows(bytes([97 + i % 3] * 100)) for i in range(8)])
    y = np.repeat([0, 1], 8)
    before = -np.log(network.probabilities(x)[np.arange(16), y]).mean()
    network.train(x, y, epochs=5, batch=16)
    assert -np.log(network.probabilities(x)[np.arange(16), y]).mean() < before


def test_windows_cover_the_text():
    data = bytes(range(256)) * 3
    assert bytes(b for b in langid.windows(data).ravel() if b != langid.PAD) == data and langid.windows(b"").shape == (1, langid.SPAN)


def test_language_of_odd_tables(spark, odd_docs, no_docs):
    network = langid.train_network(odd_docs.where(~langid.held_out()))
    got = rows(langid.identify(odd_docs.withColumn("Score", F.lit("x")), network), "doc_id", "lang_pred", "score")
    assert len(got) == odd_docs.count()
    assert all((p, s) == ("und", 0.0) for d, p, s in got if d in (1, 2, 3, 7)) and all(p != "und" for d, p, _ in got if d in (4, 5, 8))
    nothing = langid.train_network(no_docs)
    assert {r[0] for r in rows(langid.identify(odd_docs, nothing), "lang_pred")} == {"und"}
    assert langid.identify(no_docs, network).count() == 0


# URL rules

def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for stop in "/?#":
        host = host.split(stop)[0]
    path = rest[len(host):]
    for stop in "?#":
        path = path.split(stop)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), v == "block", h, p, v) for h, p, v in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3] + best[4], best[5] if best else "allow"


def test_url_rules_against_every_rule(spark):
    random.seed(6)
    label = lambda: random.choice(["a", "b", "c", "com", "x-y"])
    host = lambda: ".".join(label() for _ in range(random.randint(1, 4)))
    path = lambda: "/" + "/".join(label() for _ in range(random.randint(0, 3)))
    rules = [(host(), random.choice(["", path(), path() + "/"]), random.choice(["allow", "block"])) for _ in range(60)]
    urls = [f"http://{host().upper() if random.random() < 0.2 else host()}{path()}{random.choice(['', '?q=/a', '#/b', '/'])}" for _ in range(800)]
    urls += [None, "", "no scheme/a", "http://", "://a.com", "http://a.com?x://y"] + ["http://a.b.com/a/b"] * 400
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("Rule", F.lit(1))
    frame = spark.createDataFrame([*rules, (None, "/", "block"), ("", "/", "block")], "host string, path string, verdict string")
    got = {r[0]: r[1:] for r in rows(urlrules.judge_urls(pages, frame), "page_id", "host", "path", "rule", "verdict")}
    assert got == {i: plain_verdict(u, rules) for i, u in enumerate(urls)}


def test_url_rules_of_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")] * 2, "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert rows(urlrules.judge_urls(pages, none), "rule", "verdict") == [(None, "allow")] * 2
    assert urlrules.judge_urls(pages.limit(0), none).count() == 0


# WARC

def test_loser_tree():
    random.seed(7)
    for k in range(0, 9):
        runs = [sorted(random.randint(0, 30) for _ in range(random.randint(0, 12))) for _ in range(k)]
        assert list(warc.loser_tree(runs, lambda x: x)) == list(heapq.merge(*runs))


def test_archives_round_trip(spark, tmp_path):
    body = "<p>\r\n\r\nWARC/1.1\r\n</p>" + "é" * 800
    data = [(1, "http://b.com/x", body), (2, "http://a.com/\r\ny", body), (3, None, None), (4, "http://a.com/", ""), (5, "no url", "short"),
            (6, "http://a.com/z", "short"), (None, "http://c.com", body), (7, "http://a.com/z", body), (7, "http://a.com/z", body)]
    data += [(100 + i, "http://hot.com/", f"page {i}" * 300) for i in range(300)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("archive", F.lit("clash"))
    index = warc.archive_pages(pages, str(tmp_path / "w")).cache()
    got = sorted(map(repr, rows(index, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")))
    want = []
    for own, _, html in data:
        raw = (html or "").encode()
        refers = 7 if html == body and own != 7 else None
        want.append((own, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if refers else "response", refers))
    assert got == sorted(map(repr, want))
    order = [tuple(r) for r in index.orderBy("part", "place").select("url_key", "captured").collect()]
    assert order == sorted(order)
    lines = b"".join(__import__("gzip").open(f).read() for f in (tmp_path / "w").glob("*.gz"))
    assert lines.count(b"WARC-Type: response") == len(data) - 3 and sum(1 for _ in warc.records(lines)) == len(data)


def test_archives_of_an_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_damaged_payload_is_noticed():
    record = list(warc.records(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:capture:1>\r\nWARC-Date: x\r\n"
                               b"WARC-Payload-Digest: sha1:00\r\nContent-Length: 23\r\n\r\nContent-Length: 1\r\n\r\nab\r\n\r\n"))
    with pytest.raises(ValueError, match="digest"):
        warc._index_entry("a", *record[0])


# line spread

def test_lines_against_plain_counts(spark):
    random.seed(8)
    common = [f"common line {i}" for i in range(30)]
    data = []
    for i in range(600):
        own = [f"own line {i} {j} " * 4 for j in range(4)]
        own.insert(random.randint(0, 4), " " * (i % 3) + common[random.randint(0, 29)])
        data.append((i, "\n".join(own), None if i % 17 == 0 else f"s{random.randint(0, 11) if i % 2 else 0}"))
    data += [(1000 + i, f"copied line\nmore of it {i % 2}", f"s{i}") for i in range(12)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").withColumn("N_lines", F.lit(0))
    got = dict(rows(linespread.remove_boilerplate(docs), "doc_id", "text"))
    want = brute.without_boilerplate([(t, s) for _, t, s in data])
    assert got == {d: want[i] for i, (d, _, _) in enumerate(data)}
    assert any(got[d] != t for d, t, _ in data) and all(got[d] == t.split("\n")[1] for d, t, _ in data if d >= 1000)


def test_only_whole_copies_keep_their_lines(spark):
    copy = "the notice line of many sites\n\nand another line of them"
    data = [(i, f"the notice line of many sites\nown {i}", f"s{i}") for i in range(12)]
    data += [(100 + i, copy, f"s{i}") for i in range(12)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = dict(rows(linespread.remove_boilerplate(docs), "doc_id", "text"))
    assert got == {i: f"own {i}" for i in range(12)} | {100 + i: copy for i in range(12)}


def test_lines_of_odd_tables(odd_docs, no_docs):
    assert linespread.remove_boilerplate(no_docs).count() == 0
    got = linespread.remove_boilerplate(odd_docs, min_sites=1)
    assert got.count() == odd_docs.count()
    assert {r for r in rows(got, "doc_id", "text", "n_lines") if r[0] in (1, 2, 3)} == {(1, None, 0), (2, "", 0), (3, " \t\n\n ", 0)}


# exact top-k

def plain_top(vectors, k):
    out = []
    for q, a in sorted(vectors):
        if q % 100 == 0:
            size = lambda b: sum(x * y for x, y in zip(a, b))
            ranked = sorted(((-size(b), v) for v, b in vectors if v != q))[:k]
            out += [(q, n, v, -s) for n, (s, v) in enumerate(ranked, 1)]
    return out


def test_top_k_against_all_pairs(spark):
    random.seed(9)
    vectors = [(i, [random.randint(-3, 3) for _ in range(8)]) for i in range(500)] + [(i, [1] * 8) for i in range(500, 900)]
    vectors += [(1000, []), (1001, [5] * 12), (1100, [2] * 3)]
    frame = spark.createDataFrame([(v, [float(x) for x in w]) for v, w in vectors], "vec_id long, embedding array<double>")
    scaled = maxscore.scaled(frame, factor=1)
    got = rows(maxscore.top_k(scaled, F.col("id") % 100 == 0, k=7, shard_rows=64, block_rows=4), "query_id", "rank", "vec_id", "score")
    assert sorted(got) == plain_top(vectors, 7)


def test_shard_search_probes_less_than_everything():
    random.seed(10)
    postings = np.array([[random.randint(-20, 20) * (4 if t < 2 else 1) for _ in range(2000)] for t in range(10)])
    query, best = np.array([30, -30, 1, 1, 1, 1, 1, 1, 1, 1]), maxscore._Best(5)
    best.add(np.sort(query @ postings)[-5:][::-1], np.arange(-5, 0))
    reach = np.sort(np.abs(query)[:, None] * np.abs(postings)).max(axis=1)
    assert reach[2:].sum() < best.floor                  # so the eight small terms are non-essential
    maxscore.search_shard(postings, np.arange(2000), query, -1, best)
    assert best.scores.tolist() == np.sort(np.concatenate([query @ postings] * 2))[-5:][::-1].tolist()


def test_vectors_that_take_no_part(spark):
    odd = [(100, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]),
           (5, [1.0, 1.0]), (5, [1.0, 1.0]), (200, [-0.0005, 0.0])]
    frame = spark.createDataFrame(odd, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash"))
    got = rows(maxscore.top_k(maxscore.scaled(frame), F.col("id") % 100 == 0), "query_id", "rank", "vec_id", "score")
    assert sorted(got) == [(100, 1, 5, 3 << 20), (100, 2, 5, 3 << 20), (100, 3, 200, -1024), (200, 1, 5, -1024), (200, 2, 5, -1024), (200, 3, 100, -1024)]
    assert maxscore.top_k(maxscore.scaled(frame.limit(0)), F.col("id") % 100 == 0).count() == 0


# pieces

def test_pieces_are_those_of_the_library(spark, odd_docs, small_docs):
    import sentencepiece

    model = queries.piece_model()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    random.seed(11)
    alphabet = " ▁ab\n\t\x00é😀<s>/  　ﬁ́​"
    texts = [t for _, t, *_ in small_docs] + ["".join(random.choice(alphabet) for _ in range(random.randint(0, 12))) for _ in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(
        odd_docs.select((F.coalesce("doc_id", F.lit(0)) + 100_000).alias("doc_id"), "text")).withColumn("IDS", F.lit(1))
    for _, text, ids, decoded in rows(pieces.encode_texts(docs, model, batch_bytes=5000), "doc_id", "text", "ids", "decoded"):
        want = library.encode(text or "", add_eos=True)
        assert ids == want and decoded == library.decode(want)


def test_chunk_table_starts_anew_without_effect():
    table = pieces.ChunkTable(queries.piece_model(), max_chunks=2)
    first = table.ids_of(table.code(["some words here", ""]), True)
    assert table.full()
    table.clear()
    again = table.ids_of(table.code(["some words here", ""]), True)
    assert first[0].tolist() == again[0].tolist() and first[1].tolist() == again[1].tolist()


def test_piece_digests(spark, no_docs):
    model = queries.piece_model()
    assert pieces.with_digests(pieces.encode_texts(no_docs, model)).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    empty = hashlib.sha256(b"").hexdigest()
    assert rows(pieces.with_digests(pieces.encode_texts(one, model)), "n_tokens", "ids_sha256", "decoded_sha256") == [
        (1, hashlib.sha256(b"2").hexdigest(), empty)]


# decontamination

def test_items_against_every_alignment(spark):
    random.seed(12)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "and"] * 40
    words = lambda n: [random.choice(vocabulary) for _ in range(n)]
    items = [(i, words(random.randint(5, 40))) for i in range(12)] + [(50, ["the", "of"]), (51, ["the", "of", "and", "the", "of"])]
    docs = []
    for i in range(150):
        text = words(random.randint(0, 120))
        if i % 2:
            copy = list(items[i % 12][1])
            for _ in range(i % 5):
                copy[random.randrange(len(copy))] = f"edit{i}"
            at = random.randint(0, len(text))
            text[at:at] = copy
        docs.append((i, text))
    frame = spark.createDataFrame([(i, ", ".join(t).upper()) for i, t in docs], "doc_id long, text string").withColumn("hits", F.lit(1))
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items] * 2 + [(99, None), (98, "")], "item_id long, text string")
    found = decontam.find_items(frame, bench, block_bytes=400).select("doc_id", F.inline("hits"))
    got = {(d, i): s for d, i, s in rows(found, "doc_id", "item_id", "score")}
    want = {}
    for d, text in docs:
        for i, item in items:
            score = brute.smith_waterman(item, text) / (2 * len(item))
            runs = {tuple(item[k:k + 5]) for k in range(len(item) - 4)} or {tuple(item)}
            seen = {tuple(text[k:k + n]) for n in {len(r) for r in runs} for k in range(len(text))}
            if score >= 0.5 and len(item) >= 3 and runs & seen:   # a run of five words is sure to hold a seed
                want[d, i] = round(score, 6)
    assert want and all(got.get(key) == score for key, score in want.items())
    for (d, i), score in got.items():
        assert score == round(brute.smith_waterman(dict(items)[i], docs[d][1]) / (2 * len(dict(items)[i])), 6)


@pytest.mark.parametrize("step", (3, 4))
def test_copy_with_each_nth_word_replaced(spark, step):
    random.seed(13)
    items = [[f"w{random.randint(0, 900)}" for _ in range(7 + i)] for i in range(40)]
    texts = [" ".join(f"new{n}" if n % step == step - 1 else w for n, w in enumerate(item)) for item in items]
    docs = spark.createDataFrame([(i, f"before it {t} after it") for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    found = rows(decontam.find_items(docs, bench).select("doc_id", F.inline("hits")), "doc_id", "item_id", "score")
    high = {i: brute.smith_waterman(t, texts[i].split()) / (2 * len(t)) for i, t in enumerate(items)}
    assert {(d, i) for d, i, _ in found} == {(i, i) for i, s in high.items() if s >= 0.5} and len(found) >= 30


def test_long_excerpt_of_a_longer_item(spark):
    item = [f"w{i}" for i in range(56)]
    around = [f"own{i}" for i in range(40)]
    edited = item[5:23]
    edited[8] = "other"
    texts = [around + item[10:35] + around, around + item[20:33] + around, around + edited + around,
             around + item[20:32] + around, around + item[::2] + around]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    found = decontam.find_items(docs, bench).select("doc_id", F.inline("hits"))
    want = [(d, 7, round(brute.smith_waterman(item, texts[d]) / 112, 6)) for d in (0, 1, 2)]
    assert sorted(rows(found, "doc_id", "item_id", "score")) == want and all(w[2] < 0.5 for w in want)


def test_items_in_odd_tables(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "the same words in this row")], "item_id long, text string")
    found = decontam.find_items(odd_docs, bench)
    assert found.count() == odd_docs.count()
    assert [r[:3] for r in rows(found.select("doc_id", F.inline("hits")), "doc_id", "item_id", "score")] == [(5, 1, 1.0)] * 2
    assert decontam.find_items(no_docs, bench).count() == 0
    assert rows(decontam.find_items(odd_docs, bench.limit(0)).select(F.max(F.size("hits"))), "*") == [(0,)]


def test_words_of_many_texts_are_those_of_each():
    """Decontamination numbers the words of a batch at once, by bytes where Latin-1 will do."""
    from tableport.llm import decontam

    texts = ["", None, "Über_Größe 12² naïve.café\xa0x\x85y", "ŁÓDŹ łódź · Σας ΣΑΣ", "plain . words, a.b", "&#322; 322", "日本 x", " "]
    items = decontam.Items([(1, "łódź plain words 322 über_größe"), (2, "café x 12² σας naïve 日本")])
    words, starts = items.numbered_texts(texts)
    for i, text in enumerate(texts):
        plain = [items.vocabulary.get(w, -1) for w in decontam.words_of(text)]
        assert words[starts[i]:starts[i + 1] - 1].tolist() == plain
    assert (words[starts[1:-1] - 1] < 0).all() and len(starts) == len(texts) + 1
