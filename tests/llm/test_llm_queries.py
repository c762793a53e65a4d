"""The registered queries beside their SQL, and the pipeline beside a plain version."""

import hashlib
import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

import __spark_entry__ as contract  # noqa: E402
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from check_oracle import compare  # noqa: E402
from tableport.llm import decontam, langid, queries  # noqa: E402

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{ROOT}/{table}.parquet'")
    return con


def test_all_operators_and_the_pipeline():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, name, ROOT).startswith(("ok", "rows only"))


def test_contract_columns(spark):
    types = {name: dict(queries.QUERIES[name](spark, ROOT).dtypes) for name in ("op4_language", "op6_warc", "op8_topk", "op9_sentencepiece")}
    assert types["op4_language"] == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    assert types["op6_warc"]["payload_bytes"] == "bigint" and types["op8_topk"] == {
        "query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert types["op9_sentencepiece"]["n_tokens"] == "bigint"


def test_held_out_rows(spark):
    import zlib

    got = queries.op4_language(spark, ROOT).select("doc_id", "held_out").collect()
    assert got and all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for d, h in got)


def test_pipeline_against_a_plain_version(spark, small_docs):
    import sentencepiece

    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    network = langid.train_network(docs.where(~langid.held_out()))
    kept = [r for r in small_docs if any(c.isalpha() for c in r[1] or "")]
    named = network.classify([r[1].encode() for r in kept])
    kept = [r for r, (_, score) in zip(kept, named) if score >= corpus_pipeline.MIN_LANGUAGE_SCORE]
    kept = [(d, t, lang, s) for (d, _, lang, s, _), t in zip(kept, brute.without_boilerplate([(r[1], r[3]) for r in kept]))]
    classes = brute.classes([(r[0], r[1]) for r in kept])
    kept = [r for i, r in enumerate(kept) if classes[i] == r[0] or not brute.shingles(r[1])[0]]
    items = [decontam.words_of(r[0]) for r in duckdb.sql(f"SELECT text FROM '{ROOT}/benchmark.parquet'").fetchall()]
    near = lambda a, b: len(set(a) & set(b)) >= len(set(a)) / 2 and brute.smith_waterman(a, b) >= len(a)
    kept = [r for r in kept if not any(near(i, decontam.words_of(r[1])) for i in items)]
    library = sentencepiece.SentencePieceProcessor(model_proto=queries.piece_model())
    want = []
    for d, text, lang, source in kept:
        ids = library.encode(text, add_eos=True)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids))]
        want.append((d, lang, source, len(ids), *digests))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, ROOT).collect()) == sorted(want) and len(want) < len(small_docs)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_odd_tables(spark, odd_docs, no_docs, name, stage):
    clash = odd_docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in ("Ids", "hits", "class_id", "score", "removed")})
    got = stage(spark, clash, ROOT)
    rows = got.collect()
    if name == "encoding":
        assert len(rows) == 13 and got.columns[:3] == ["doc_id", "lang", "source"]
    else:
        assert got.columns == clash.columns and all(r["score"] == (None if r["doc_id"] is None else f"score{r['doc_id']}") for r in rows)
    if name == "language":
        assert {4, 5, 8} <= {r["doc_id"] for r in rows} and not {1, 2, 3, 7} & {r["doc_id"] for r in rows}
    elif name == "near_duplicates":
        assert len(rows) == 11                           # one of two equal rows, and one of two texts of the same single word
    else:
        assert len(rows) == 13
    assert stage(spark, no_docs, ROOT).count() == 0
