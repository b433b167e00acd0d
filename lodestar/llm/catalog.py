"""The registered queries of this package, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import containers, exact, fingerprints, middle, mixing, near, periods, pieces, quality, sharding, substrings, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query(
    "op1_substring_dedup",
    r"""
    WITH texts AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
    ), windows AS (
        SELECT doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM texts WHERE len(ws) >= 35)
    ), repeated AS (
        SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS c FROM windows) WHERE c > 1
    ), covered AS (
        SELECT DISTINCT doc_id, i + k AS j FROM repeated, range(0, 35) AS r(k)
    ), words AS (
        SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM texts
    ), kept AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS t
        FROM words ANTI JOIN covered USING (doc_id, j) GROUP BY doc_id
    )
    SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
           sha256(coalesce(t, '')) AS kept_sha256
    FROM texts LEFT JOIN kept USING (doc_id)
    """,
)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"), width=35)


URL_RULES = [
    urls.Rule("allow", "com/"),
    urls.Rule("block", "example.com/en/"),
    urls.Rule("allow", "www.example.com/en/"),
    urls.Rule("block", "net/es/"),
    urls.Rule("block", "net/fr/"),
]


@_query(
    "op2_url_filter",
    r"""
    WITH RECURSIVE rules(pattern, rule_host, rule_path, action) AS (
        VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
               ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
               ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
    ), parts AS (
        SELECT page_id, html,
               translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) AS query
        FROM (SELECT *, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
    ), stated AS (
        SELECT host, path, host || path || query AS src, replace(target, '&amp;', '&') AS target
        FROM (SELECT *, unnest([
            regexp_extract(regexp_extract(html, '(?is)<link[^>]*rel\s*=\s*["'']?canonical[^>]*>'), '(?is)href\s*=\s*["'']?([^"''\s>]+)', 1),
            regexp_extract(regexp_extract(html, '(?is)<meta[^>]*http-equiv\s*=\s*["'']?refresh[^>]*>'), '(?is)url\s*=\s*["'']?([^"''\s>]+)', 1)
        ]) AS target FROM parts WHERE host <> '')
        WHERE target <> ''
    ), resolved AS (
        SELECT src, CASE WHEN strpos(target, '://') > 0 THEN target WHEN starts_with(target, '//') THEN 'http:' || target
                         WHEN starts_with(target, '/') THEN 'http://' || host || target
                         ELSE 'http://' || host || CASE WHEN path LIKE '%/%' THEN regexp_extract(path, '^(.*/)', 1) ELSE '/' END || target END AS dst
        FROM stated
    ), links AS (
        SELECT src, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                    || regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) || regexp_extract(dst, '^[^?#]*(\?[^#]*)', 1) AS dst
        FROM (SELECT *, substr(dst, strpos(dst, '://') + 3) AS rest FROM resolved)
    ), both_ways AS (
        SELECT src, dst FROM links UNION SELECT dst, src FROM links
    ), reach(id, other) AS (
        SELECT src, src FROM both_ways UNION SELECT id, dst FROM reach JOIN both_ways ON other = src
    ), fits AS (
        SELECT node, pattern, action, length(pattern) AS size FROM (
            SELECT DISTINCT node, regexp_extract(node, '^[^/?#]*') AS host, regexp_extract(node, '^[^/?#]*([^?#]*)', 1) AS path
            FROM (SELECT host || path || query AS node FROM parts WHERE host <> '' UNION SELECT src FROM both_ways)
        ) JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    ), ruled AS (
        SELECT node, arg_max(pattern, size) AS rule, arg_max(action, size) AS action FROM fits GROUP BY node
    ), decided AS (
        SELECT id, min(action) AS decided FROM reach JOIN ruled ON other = node GROUP BY id
    )
    SELECT page_id, host, path, rule, coalesce(action, decided, 'allow') AS verdict
    FROM parts LEFT JOIN ruled ON node = host || path || query LEFT JOIN decided ON id = host || path || query
    """,
)
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), URL_RULES)


@_query("op4_sharding")
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_bytes(_table(spark, sf_dir, "documents"), shards=16)


@_query(
    "op8_exact_dedup",
    """
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM (
        SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
    )
    """,
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_table(spark, sf_dir, "documents"), keep="max")


@_query("op10_fingerprints")
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


@_query("op5_near_dedup")
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


@_query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), modulus=3, remainder=1, threshold=0.7)


@_query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), modulus=5, remainder=0, threshold=0.3)


@_query("op3_mixing")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(_table(spark, sf_dir, "documents"), flatten=0.5, max_epochs=4.0).drop("tie")


@_query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"), pieces.Vocabulary.load(pieces.MODEL_FILE))


@_query("op11_html_extraction")
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers.extract(_table(spark, sf_dir, "pages"))


@_query(
    "op12_fill_in_middle",
    """
    WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS draw FROM documents
    ), draws AS (
        SELECT doc_id, text, n, ('0x' || substr(draw, 1, 8))::BIGINT % (n + 1) AS x, ('0x' || substr(draw, 9, 8))::BIGINT % (n + 1) AS y,
               ('0x' || substr(draw, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(draw, 25, 8))::BIGINT % 100 AS h4
        FROM texts
    ), cuts AS (
        SELECT *, least(x, y) AS a, greatest(x, y) AS b,
               CASE WHEN n = 0 OR h3 >= 90 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                    WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM draws
    ), parts AS (
        SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM cuts
    )
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts
    """,
)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    arranged = middle.fill_in_middle(_table(spark, sf_dir, "documents"), seed=1)
    restored = middle.restore(F.col("output"), F.col("form"))
    return arranged.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))


@_query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.collapse_runs(_table(spark, sf_dir, "documents"), repeated_tails=True).drop("n_words", "n_dropped")
