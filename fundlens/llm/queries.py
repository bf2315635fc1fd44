"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    centroid_clusters,
    chat_quotes,
    decontamination,
    embedding_dedup,
    exact_dedup,
    filter_audit,
    language_id,
    license_scan,
    ngram_join,
    packing,
    sentencepiece_codec,
    token_files,
    toxicity,
)
from ._shared import table


def _documents(fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": lambda spark, d: embedding_dedup.near_duplicates(table(spark, d, "embeddings")),
    "op2_ngram_jaccard_join": _documents(ngram_join.jaccard_join),
    "op3_packing": _documents(packing.pieces),
    "op4_license_scan": _documents(license_scan.scan),
    "op5_toxicity": lambda spark, d: toxicity.toxicity(table(spark, d, "documents"), table(spark, d, "labels")),
    "op6_token_files": _documents(token_files.round_trip),
    "op7_exact_dedup": _documents(exact_dedup.exact_duplicates),
    "op8_chat_quotes": lambda spark, d: chat_quotes.conversations(table(spark, d, "conversations")),
    "op9_sentencepiece": _documents(sentencepiece_codec.encode_decode),
    "op10_language_id": _documents(language_id.identify),
    "op11_decontamination": lambda spark, d: decontamination.decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op12_filter_audit": lambda spark, d: filter_audit.interactions(table(spark, d, "documents"), table(spark, d, "labels")),
    "op13_centroid_clusters": lambda spark, d: centroid_clusters.cluster(table(spark, d, "embeddings")),
}

# A word of the decontamination contract, after A-Z became a-z.
_CAPITALS, _SMALL = filter_audit.CAPITALS, filter_audit.CAPITALS.lower()


def _words_sql(col: str) -> str:
    return f"regexp_extract_all(translate({col}, '{_CAPITALS}', '{_SMALL}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"


def _centroids_sql(rounds: int = 5, k: int = 40, dim: int = 64) -> str:
    """Lloyd rounds as one chain of common table expressions, a row for each
    component."""
    out = f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
            WHERE len(embedding) = {dim}
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
        e AS MATERIALIZED (
            SELECT r, vec_id, unnest(range({dim})) AS i, CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM v),
        f AS MATERIALIZED (
            SELECT r, row_number() OVER (ORDER BY h NULLS LAST, p) - 1 AS c
            FROM (SELECT r, sha256('2:' || vec_id::VARCHAR) AS h, list(x ORDER BY i) AS p FROM e GROUP BY r, vec_id)
            ORDER BY c LIMIT {k}),
        c0 AS MATERIALIZED (SELECT f.c, e.i, e.x FROM f JOIN e ON f.r = e.r)"""
    for n in range(rounds + 1):
        out += f""",
        a{n} AS MATERIALIZED (
            SELECT r, min(d * {k} + c) % {k} AS c, min(d * {k} + c) // {k} AS d
            FROM (SELECT e.r, c{n}.c, sum((e.x - c{n}.x) * (e.x - c{n}.x)) AS d FROM e JOIN c{n} ON e.i = c{n}.i GROUP BY ALL)
            GROUP BY r)"""
        if n < rounds:
            out += f""",
        s{n} AS MATERIALIZED (
            SELECT a{n}.c, e.i, sum(e.x) AS s, count(*)::HUGEINT AS m FROM e JOIN a{n} ON e.r = a{n}.r GROUP BY ALL),
        c{n + 1} AS MATERIALIZED (
            SELECT o.c, o.i, coalesce((s - ((s % m) + m) % m) // m, o.x) AS x FROM c{n} o LEFT JOIN s{n} USING (c, i))"""
    return out + f""",
        h AS (SELECT c, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
        SELECT v.vec_id, a.c::INTEGER AS cluster, a.d::BIGINT AS distance,
               (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
               h.centroid_sha256
        FROM v JOIN a{rounds} a ON v.r = a.r JOIN h ON h.c = a.c
    """

ORACLE: dict[str, str] = {
    "op7_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t
    """,
    "op11_decontamination": f"""
        WITH item AS (SELECT item_id, {_words_sql("text")} AS w FROM benchmark WHERE text IS NOT NULL),
        win AS (
            SELECT item_id, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i, w FROM item WHERE len(w) > 0),
        keys AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS key FROM win),
        doc AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_words_sql("coalesce(text, '')")} AS w FROM documents),
        spot AS (
            SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i
            FROM doc JOIN (SELECT DISTINCT n FROM keys) ON len(w) >= n),
        hit AS MATERIALIZED (
            SELECT a.r, a.i, a.n, k.item_id
            FROM (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS key FROM spot) a JOIN keys k ON a.key = k.key AND a.n = k.n),
        words AS (
            SELECT r, count(DISTINCT p) AS n_hit
            FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
        items AS (
            SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
    """,
    "op12_filter_audit": """
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        lab AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        m AS MATERIALIZED (
            SELECT part, quality IS NOT DISTINCT FROM 1 AS good, lab.toxic IS NOT DISTINCT FROM 1 AS bad,
                   (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
                   + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT
                   + 8 * regexp_matches(t, '[#$%&*|]')::INT
                   + 16 * coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)::INT AS mask
            FROM d LEFT JOIN lab ON d.doc_id = lab.doc_id),
        c AS MATERIALIZED (
            SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS toxic FROM m GROUP BY part, mask),
        f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
        o AS MATERIALIZED (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
            FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
              AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
        s AS (
            SELECT filter_order, step, filter, f.bit,
                   (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE position(g.f IN left(filter_order, step - 1)) > 0) AS before
            FROM (SELECT filter_order, step, substring(filter_order, step, 1) AS filter FROM o, (SELECT unnest(range(1, 6)) AS step)) x
            JOIN f ON f.f = filter),
        r AS (
            SELECT part, filter_order, step::INTEGER AS step, filter,
                   coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
                   coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS removed,
                   coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0) AS redundant,
                   coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
                   coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS good_lost,
                   coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
            FROM c, s GROUP BY part, filter_order, step, filter)
        SELECT part, filter_order, step, filter, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
               unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
               (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
        FROM r
    """,
    "op13_centroid_clusters": _centroids_sql(),
}
