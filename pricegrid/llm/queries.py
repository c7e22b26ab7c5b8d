"""One query per operator, over its whole table, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.llm import alignment, ann, bpe, contamination, divergence, exact_dedup, near_dedup, packing, quality, secrets, sharding, url_trust, warc
from pricegrid.llm.words import small_batches


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(_read(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(docs))


def op3_link_graph_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trust.judge(_read(spark, sf_dir, "pages"))


def op4_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                       public_tokenizers.PATTERN)


def op5_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the rank file holds the vocabulary of byte_bpe_50k.json, but for its added tokens
    return packing.pieces(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN, special=packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json")))


def op6_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shards(_read(spark, sf_dir, "documents"))
    body = F.coalesce("text", F.lit("")).cast("binary")
    return shards.select("doc_id", sharding.size().alias("size"), F.crc32(body).alias("text_crc32"),
                         F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, _read(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out().alias("held_out"), F.col("_score").alias("score"),
                         F.col("_predicted").alias("predicted"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents"), words=2, percent=80)


def op10_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve(warc.captures(_read(spark, sf_dir, "pages")))
    return found.select("record_id", "uri_key", "state", "source_id", "digest", warc.header_lines(F.col("headers")).alias("headers"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_read(spark, sf_dir, "documents"))


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.digests(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_link_graph_trust": op3_link_graph_trust,
    "op4_prefix_bpe": op4_prefix_bpe,
    "op5_hilbert_packing": op5_hilbert_packing,
    "op6_external_shuffle": op6_external_shuffle,
    "op7_multi_index_hashing": op7_multi_index_hashing,
    "op8_quality_classifier": op8_quality_classifier,
    "op10_revisit_resolution": op10_revisit_resolution,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_source_divergence": op12_source_divergence,
    "op13_benchmark_decontamination": op13_benchmark_decontamination,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH flat AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM flat WINDOW same AS (PARTITION BY body)""",
    "op3_link_graph_trust": url_trust.oracle_sql(),
    "op9_minhash_near_dedup": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, [x FOR x IN regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws
                ELSE list_distinct([ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) END AS s FROM worded),
        items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other),
        named AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
        SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
        FROM sets s JOIN named c USING (doc_id)""",
    "op10_revisit_resolution": r"""
        WITH base AS (
            SELECT *, 1700000000 + page_id * 60 AS stamp, sha256(coalesce(html, '')) AS digest,
                '"' || left(sha256(coalesce(html, '')), 16) || '"' AS tag,
                regexp_replace(regexp_replace(url, '#[\s\S]*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
        keyed AS (
            SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^www[.]', ''), ':(80|443)$', '')
                || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/$', '') AS place,
                array_to_string([x FOR x IN string_split(regexp_extract(bare, '^[^?]*[?]([\s\S]*)$', 1), '&')
                    IF x <> '' AND NOT starts_with(x, 'utm_')], '&') AS asked FROM base),
        page AS (SELECT *, place || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END AS uri_key FROM keyed),
        full_ AS (
            SELECT uri_key, stamp AS t, page_id * 4 AS source_id, digest, stamp::VARCHAR AS of_date,
                CASE WHEN page_id % 7 <> 3 THEN tag END AS of_tag, CASE WHEN page_id % 5 <> 2 THEN stamp::VARCHAR END AS of_changed FROM page),
        revisits AS (
            SELECT uri_key, page_id * 4 + 1 AS record_id, stamp + (page_id % 11 + 1) * 3600 AS t, 'max-age=120' AS cache,
                CASE WHEN page_id % 7 <> 3 THEN CASE WHEN page_id % 13 = 5 THEN '"stale"' WHEN page_id % 4 = 0 THEN 'W/' || tag ELSE tag END END AS sent,
                CASE WHEN page_id % 5 <> 2 THEN stamp::VARCHAR END AS changed FROM page WHERE page_id % 3 <> 1
            UNION ALL SELECT uri_key, page_id * 4 + 2, stamp - 86400, NULL, tag, NULL FROM page WHERE page_id % 17 = 4),
        found AS (
            SELECT r.*, f.* EXCLUDE (uri_key, t) FROM revisits r LEFT JOIN full_ f
            ON f.uri_key = r.uri_key AND (f.t, f.source_id) < (r.t, r.record_id)
            QUALIFY row_number() OVER (PARTITION BY r.record_id ORDER BY f.t DESC NULLS LAST, f.source_id DESC NULLS LAST) = 1),
        checked AS (SELECT *, coalesce(regexp_replace(sent, '^W/', '') = of_tag, changed = of_changed) AS agrees FROM found)
        SELECT record_id, uri_key, source_id, digest,
            CASE WHEN source_id IS NULL THEN 'missing' WHEN agrees THEN 'resolved' WHEN agrees IS NULL THEN 'unverified' ELSE 'mismatch' END AS state,
            CASE WHEN agrees THEN array_to_string(list_filter(['cache-control: ' || coalesce(cache, 'max-age=60'), 'content-type: text/html',
                'date: ' || t::VARCHAR, 'etag: ' || coalesce(sent, of_tag), 'last-modified: ' || of_changed], lambda x: x IS NOT NULL), chr(10)) END AS headers
        FROM checked""",
    "op12_source_divergence": r"""
        WITH rows AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS rid,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        used AS (SELECT lang, source, rid, unnest(terms) AS term FROM rows),
        vocab AS (SELECT lang, term, count(*) AS n FROM used GROUP BY ALL HAVING count(DISTINCT rid) >= 30),
        sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM vocab GROUP BY lang),
        groups AS (SELECT DISTINCT lang, source FROM rows),
        hits AS (SELECT lang, source, term, count(*) AS n FROM used SEMI JOIN vocab USING (lang, term) GROUP BY ALL),
        cells AS (
            SELECT g.lang, g.source, k.term, k.n AS in_lang, coalesce(h.n, 0) AS n,
                sum(coalesce(h.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
            FROM groups g JOIN vocab k USING (lang) LEFT JOIN hits h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
        shares AS (
            SELECT c.lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (c.total::HUGEINT + 5 * v) AS p,
                1 + (1000000000::HUGEINT * (in_lang + 5)) // (s.total::HUGEINT + 5 * v) AS q
            FROM cells c JOIN sizes s USING (lang)),
        apart AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
            UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q)
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
        FROM found QUALIFY part = 'pair' OR rank <= 50""",
    "op13_benchmark_decontamination": r"""
        WITH items AS (
            SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS words
            FROM (SELECT *, unnest(range(1, greatest(2, len(ws) - 8))) AS i FROM items WHERE len(ws) > 0)),
        docs AS (
            SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        grams AS (
            SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS words
            FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows))),
        met AS (SELECT rid, i, n, item_id FROM grams JOIN windows USING (n, words)),
        hits AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS place FROM met) GROUP BY rid),
        named AS (SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY encode(item_id::VARCHAR)) AS ids
            FROM (SELECT DISTINCT rid, item_id FROM met WHERE item_id IS NOT NULL) GROUP BY rid)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hits USING (rid) LEFT JOIN named USING (rid)""",
}
