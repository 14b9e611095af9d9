"""The registered queries of the corpus operators."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lakeaudit.llm import (
    angular,
    chosen_path,
    host_bayes,
    importance,
    interleave,
    line_frequency,
    mixing,
    packing,
    phrases,
    secrets,
    suffixes,
    url_rules,
    vafile,
)
from lakeaudit.session import apply_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``build(read) -> DataFrame``, where ``read(table)`` is a whole table."""

    def wrap(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return build(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return wrap


@query("op1_chosen_path_join")
def op1(read):
    return chosen_path.near_duplicates(read("documents"))


@query("op2_linked_secrets")
def op2(read):
    return secrets.secret_report(read("documents"))


@query("op3_pattern_packing")
def op3(read):
    import public_tokenizers

    return packing.packed(read("documents"), public_tokenizers.path("word_bpe_49k.json"))


@query(
    "op4_va_file",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
      WHERE q.vec_id % 50 = 0
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
    ) WHERE rank <= 5
    """,
)
def op4(read):
    return vafile.nearest(read("embeddings"))


@query("op5_water_filled_mix")
def op5(read):
    return mixing.taken_words(read("documents"))


@query(
    "op6_line_frequency",
    r"""
    WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
    windows AS (SELECT doc_id, s, array_to_string(list_slice(ws, s, s + 2), ' ') AS k
                FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS s FROM w WHERE len(ws) >= 3)),
    again AS (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows),
    repeated AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
                   SELECT doc_id, unnest(range(s, s + 3)) AS p FROM again WHERE n > 1) GROUP BY doc_id),
    split AS (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
    lines AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS own FROM split),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE len(own) > 0 GROUP BY doc_id),
    plain AS (SELECT doc_id, host, text, lower(array_to_string(own, ' ')) AS line, len(own) AS words FROM lines WHERE len(own) > 0),
    limits AS (SELECT host, greatest(30, count(DISTINCT text) * 0.01) AS most FROM d GROUP BY host),
    frequent AS (SELECT host, line FROM (SELECT host, line, count(DISTINCT text) AS n FROM plain GROUP BY host, line)
                 JOIN limits USING (host) WHERE n > most),
    removed AS (SELECT doc_id, CAST(sum(words) AS BIGINT) AS n_removed FROM plain JOIN frequent USING (host, line) GROUP BY doc_id),
    figures AS (
      SELECT w.doc_id, host, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed, 0) AS n_removed
      FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN removed USING (doc_id)
    ), judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures)
    SELECT *, NOT base_failed AND n_words - n_removed >= 0.5 * n_words AS kept FROM judged
    """,
)
def op6(read):
    return line_frequency.verdicts(read("documents"))


@query("op7_host_posteriors")
def op7(read):
    return host_bayes.judged(read("documents"), read("labels"))


@query(
    "op8_phrase_automata",
    r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    windows AS (SELECT doc_id, s, array_to_string(list_slice(ws, s, s + 19), ' ') AS k
                FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w WHERE len(ws) >= 20)),
    ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM windows),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM ranked WHERE r > 1),
    every AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM every ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
    removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
    """,
)
def op8(read):
    return phrases.repeat_report(read("documents"))


@query("op9_radix_suffixes")
def op9(read):
    return suffixes.repeat_report(read("documents"))


@query("op10_interleaved_shards")
def op10(read):
    return interleave.sharded_documents(read("documents"))


@query(
    "op11_angular_negatives",
    """
    WITH v AS (
      SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
      WHERE a.vec_id % 100 = 0
    ), positives AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same
      ) WHERE place <= 5
    )
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
      SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM positives p JOIN scored s USING (anchor_id)
      WHERE NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
    ) WHERE rank <= 5
    """,
)
def op11(read):
    return angular.embeddings_negatives(read("embeddings"))


@query("op12_weighted_medians")
def op12(read):
    return importance.resampled(read("documents"), read("benchmark"))


@query(
    "op13_rarest_token_rules",
    r"""
    WITH parts AS (
      SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
      FROM pages
    ), fitted AS (
      SELECT *, CASE
          WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
          WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
          WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
          WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
        END AS rule,
        CASE
          WHEN regexp_matches(host || path, '(?si)/responsible-gambling/') THEN '/responsible-gambling/*'
          WHEN regexp_matches(host || path, '(?si)/wp-admin/') THEN '/wp-admin/*'
          WHEN regexp_matches(host || path, '(?si)(^|[^a-z0-9])viagra([^a-z0-9]|$)') THEN '^viagra^'
          WHEN regexp_matches(host || path, '(?si)(^|[^a-z0-9])casino([^a-z0-9]|$)') THEN '^casino^'
          WHEN regexp_matches(host || path, '(?si)(^|[^a-z0-9])poker([^a-z0-9]|$)') THEN '^poker^'
          WHEN regexp_matches(host || path, '(?si)(^|[^a-z0-9])pills([^a-z0-9]|$)') THEN '^pills^'
          WHEN regexp_matches(host || path, '(?si)/login([^a-z0-9]|$)') THEN '/login^'
          WHEN regexp_matches(host || path, '(?si)(^|[^a-z0-9])porn([^a-z0-9]|$)') THEN '^porn^'
          WHEN regexp_matches(host || path, '(?si)(^|[^a-z0-9])bets([^a-z0-9]|$)') THEN '^bets^'
          WHEN regexp_matches(host || path, '(?si)^([^/]*\.)?ads\.') THEN '||ads.*'
          WHEN regexp_matches(host || path, '(?si)/cart([^a-z0-9]|$)') THEN '/cart^'
        END AS fit
      FROM parts
    )
    SELECT page_id, host, path, rule,
      CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
        WHEN fit IS NULL OR fit = '/responsible-gambling/*' THEN 'allow' ELSE 'block' END AS verdict,
      CASE WHEN rule IS NULL THEN fit END AS pattern
    FROM fitted
    """,
)
def op13(read):
    return url_rules.verdicts(read("pages"))
