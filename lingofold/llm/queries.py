"""Registered queries of the subpackage and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingofold.llm import (
    exact_dedup,
    filter_audit,
    main_text,
    mixing,
    near_dedup,
    periodic_runs,
    phrases,
    piece_sampling,
    quality_model,
    quality_rules,
    suffix_dedup,
    url_filter,
    vector_topk,
)
from lingofold.llm.common import read


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(read(spark, sf_dir, "documents"), words=4)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.remove_passages(read(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).drop("source")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_model.score_quality(docs, quality_model.fit(docs, read(spark, sf_dir, "labels")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(read(spark, sf_dir, "pages"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.encode_and_verify(read(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(url_filter.RULES), "verdict string, host string, path string")
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), rules)


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return vector_topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.planted(read(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_mix_sources": op5_mix_sources,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_quality_rules": op7_quality_rules,
    "op8_html_main_text": op8_html_main_text,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_url_filters": op10_url_filters,
    "op11_exact_topk": op11_exact_topk,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL = {
    "op3_exact_dedup": r"""
        WITH t AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY body)""",
    "op5_mix_sources": r"""
        WITH d AS (
          SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                 ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
          FROM documents),
        s AS (
          SELECT source, sum(size)::BIGINT AS source_size,
                 [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
          FROM d GROUP BY source),
        o AS (
          SELECT *, 2 * source_size AS most, row_number() OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST) AS k FROM s),
        l AS (
          SELECT a.k, any_value(a.most) AS most, any_value(a.w) AS w,
                 (1.5 * (SELECT sum(source_size)::BIGINT FROM s)::DOUBLE
                  - coalesce(sum(b.most) FILTER (b.k < a.k), 0)::DOUBLE) / sum(b.w) FILTER (b.k >= a.k)::DOUBLE AS level
          FROM o a CROSS JOIN o b GROUP BY a.k),
        lv AS (SELECT arg_min(level, k) FILTER (level * w <= most) AS level FROM l),
        t AS (
          SELECT source, source_size, least(most::DOUBLE, coalesce(level * w, most::DOUBLE)) AS target FROM o, lv),
        p AS (
          SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
                 sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS prior
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
        SELECT doc_id, size, source_size, target,
               (epochs * size + least(size, greatest(0, budget - epochs * source_size - prior)))::BIGINT AS taken
        FROM e""",
    "op10_url_filters": r"""
        WITH r(verdict, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                                               ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
        p AS (
          SELECT page_id,
                 lower(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's')) AS host,
                 regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
          FROM pages),
        m AS (
          SELECT p.*, r.host || r.path AS rule, r.verdict,
                 row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS n
          FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1""",
    "op11_exact_topk": r"""
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND len(q.v) = len(c.v) AND q.vec_id IS DISTINCT FROM c.vec_id),
        r AS (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST)::INT AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op13_filter_audit": r"""
        WITH d AS (
          SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
        g AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        f AS (
          SELECT part, coalesce(good, false) AS good, coalesce(g.toxic, false) AS toxic,
                 len(words) < 100 AS a, 100 * list_unique(words) < 80 * len(words) AS b,
                 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) AS c,
                 regexp_matches(text, '[#$%&*|]') AS d,
                 coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false) AS e
          FROM w LEFT JOIN g ON w.doc_id = g.doc_id),
        m AS (
          SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
                 count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
          FROM f GROUP BY ALL),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (
          SELECT p.x || q.x || r.x || s.x || t.x AS o FROM l p, l q, l r, l s, l t
          WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
        k AS (
          SELECT m.*, o.o, i.step, (m.mask >> (ascii(o.o[i.step]) - 65)) & 1 AS fails,
                 coalesce(list_min([j FOR j IN [1, 2, 3, 4, 5] IF (m.mask >> (ascii(o.o[j]) - 65)) & 1 = 1]), 6) AS gone
          FROM m, o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) i),
        c AS (
          SELECT part, o AS filter_order, step, o[step] AS letter,
                 coalesce(sum(n) FILTER (gone > step), 0)::BIGINT AS kept,
                 coalesce(sum(n) FILTER (gone = step), 0)::BIGINT AS removed,
                 coalesce(sum(n) FILTER (fails = 1 AND gone < step), 0)::BIGINT AS redundant,
                 coalesce(sum(n) FILTER (fails = 1 AND bit_count(mask) = 1), 0)::BIGINT AS unique_fails,
                 coalesce(sum(good) FILTER (gone = step), 0)::BIGINT AS good_lost,
                 coalesce(sum(toxic) FILTER (gone = step), 0)::BIGINT AS toxic_lost
          FROM k GROUP BY ALL)
        SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
        FROM c""",
}
