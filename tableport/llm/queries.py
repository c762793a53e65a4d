"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import small_frame
from ..sources.tables import read_table
from . import alignment, decontam, langid, licenses, linespread, maxscore, ordermin, phrases, pieces, sharding, substrings, urlrules, warc

SHARD_BYTES = 1 << 20

URL_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


def piece_model(name: str = "piece_bpe_32k.model") -> bytes:
    import public_tokenizers

    return pieces.load_model(public_tokenizers.path(name))


def op1_sharding(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign_shards(docs, SHARD_BYTES)


def op2_licenses(spark, sf_dir):
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_near_duplicates(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ordermin.near_classes(docs).select("doc_id", "class_id")


def op4_language(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = langid.train_network(docs.where(~langid.held_out()))
    named = langid.identify(docs.select("doc_id", "text"), network)
    return named.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op5_url_filter(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = small_frame(spark, URL_RULES, "host string, path string, verdict string")
    return urlrules.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op6_warc(spark, sf_dir):
    index = warc.archive_pages(read_table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_line_spread(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    cleaned = linespread.remove_boilerplate(docs)
    return cleaned.select("doc_id", "n_lines", "n_spread", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
                          F.md5("text").alias("kept_md5"))


def op8_topk(spark, sf_dir):
    vectors = maxscore.scaled(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return maxscore.top_k(vectors, F.col("id") % 100 == 0)


def op9_sentencepiece(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.with_digests(pieces.encode_texts(docs, piece_model())).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10_decontamination(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_items(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("hits"))


def op11_substring_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = substrings.remove_repeats(docs, window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op12_token_alignment(spark, sf_dir):
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = alignment.align_texts(docs, alignment.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json")), piece_model())
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    scored = alignment.score_links(aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "links"))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_collocations(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("lang", "text")
    return phrases.collocations(docs, min_count=100, longest=5, top=2000)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_licenses": op2_licenses,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_language": op4_language,
    "op5_url_filter": op5_url_filter,
    "op6_warc": op6_warc,
    "op7_line_spread": op7_line_spread,
    "op8_topk": op8_topk,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_decontamination": op10_decontamination,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_token_alignment": op12_token_alignment,
    "op13_collocations": op13_collocations,
}

ORACLES = {
    "op1_sharding": f"""
        WITH d AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS row_bytes,
                          CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
                   FROM documents),
        p AS (SELECT *, h // (1::BIGINT << (60 - depth)) AS bucket
              FROM d, (SELECT CAST(unnest(generate_series(0, 30)) AS INTEGER) AS depth)),
        fits AS (SELECT depth, bucket FROM p GROUP BY 1, 2 HAVING sum(row_bytes) <= {SHARD_BYTES}),
        leaf AS (SELECT doc_id, any_value(row_bytes) AS row_bytes, any_value(h) AS h, min(depth) AS depth
                 FROM p JOIN fits USING (depth, bucket) GROUP BY doc_id)
        SELECT doc_id, left(lpad(format('{{:b}}', h), 60, '0'), depth) AS shard, '' AS page, row_bytes FROM leaf
    """,
    "op5_url_filter": """
        WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
                   FROM pages),
        h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        r(rule_host, rule_path, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
            ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        f AS (SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                     max_by(action, length(rule_host || rule_path)) AS action
              FROM h JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
              GROUP BY page_id)
        SELECT h.page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM h LEFT JOIN f USING (page_id)
    """,
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
        o AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to FROM o
    """,
    "op7_line_spread": """
        WITH l AS (SELECT doc_id, source, md5(text) AS own, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
                          unnest(string_split(text, chr(10))) AS raw FROM documents),
        t AS (SELECT *, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM l),
        b AS (SELECT line FROM t WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 10),
        m AS (SELECT t.*, b.line IS NOT NULL AS spread FROM t LEFT JOIN b ON t.line = b.line),
        s AS (SELECT doc_id, own, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (spread) AS n_spread,
                     string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT spread) AS kept FROM m GROUP BY ALL)
        SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_spread, 0) AS INTEGER) AS n_spread,
               CAST(CASE WHEN n_spread < n_lines THEN n_spread ELSE 0 END AS INTEGER) AS n_removed,
               CASE WHEN n_spread < n_lines AND n_spread > 0 THEN md5(coalesce(kept, '')) ELSE md5(text) END AS kept_md5
        FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id AND s.own = md5(d.text)
    """,
    "op8_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
                   FROM embeddings WHERE embedding IS NOT NULL AND
                   len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.w, v.w),
                     lambda z: z[1] * z[2])) AS BIGINT) AS score
              FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op11_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        w AS (SELECT doc_id, unnest(list_transform(range(1, len(words) - 48), lambda i: md5(array_to_string(words[i:i + 49], ' ')))) AS code,
                     unnest(range(1, len(words) - 48)) AS pos FROM d),
        f AS (SELECT code, min(doc_id) AS least FROM w GROUP BY code HAVING min(doc_id) < max(doc_id)),
        h AS (SELECT doc_id, list(pos) AS hits FROM w JOIN f USING (code) WHERE least < doc_id GROUP BY doc_id),
        g AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM (SELECT doc_id, unnest(hits) AS pos FROM h)),
        t AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d),
        k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n
              FROM t ANTI JOIN g USING (doc_id, pos) GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)
    """,
    "op13_collocations": r"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
        t AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
        o AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS w
              FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
        g AS (SELECT lang, k, w, count(*) AS f FROM o GROUP BY ALL HAVING count(*) >= 100),
        c AS (SELECT x.lang, x.k, x.w, x.f AS a, t.n, j, l.f AS l, r.f AS r,
                     (1000::HUGEINT * x.f * t.n) // (l.f::HUGEINT * r.f) AS score
              FROM g AS x JOIN t ON t.lang = x.lang, (SELECT unnest(range(1, 5)) AS j), g AS l, g AS r
              WHERE j < x.k AND l.lang = x.lang AND l.w = x.w[1:j] AND r.lang = x.lang AND r.w = x.w[j + 1:]),
        b AS (SELECT lang, k, w, any_value(a) AS a, any_value(n) AS n, arg_min(l, (score, j)) AS l, arg_min(r, (score, j)) AS r,
                     min(score) AS score FROM c GROUP BY lang, k, w),
        kept AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM g AS y WHERE y.lang = b.lang AND y.f >= b.a AND y.k = b.k + 1
                     AND (y.w[1:b.k] = b.w OR y.w[2:] = b.w))),
        s AS (SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM kept)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM s QUALIFY rank <= 2000
    """,
}
