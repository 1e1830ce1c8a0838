"""The registered queries of the text operators and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cuelattice.llm import bpe, exact, hosts, packing, passages, pieces, quality, sharding, simhash, sketch
from cuelattice.llm.common import table


def vocabulary(name: str) -> str:
    """A public vocabulary file: under CUELATTICE_TOKENIZERS if that is set, else where its package keeps it."""
    if folder := os.environ.get("CUELATTICE_TOKENIZERS"):
        return f"{folder.rstrip('/')}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=16)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"), size=3)


def op4_sentencepiece_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), dropout=0.1, seed=2024)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge(table(spark, sf_dir, "pages"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=512)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(table(spark, sf_dir, "documents"))


def hosts_sql() -> str:
    """The rules and the shrinkage of op6 in SQL."""
    moments = """
        SELECT CASE WHEN g < 2 OR p * (1 - p) <= 0 OR n - nn / n - (g - 1) <= 0 THEN 1000.0
                    WHEN kk - n * p * p - p * (1 - p) * (g - 1) <= 0 THEN 1000.0
                    ELSE least(1000.0, greatest(0.5, (1 - rho) / rho)) END AS m
        FROM (SELECT *, (kk - n * p * p - p * (1 - p) * (g - 1)) / (p * (1 - p) * (n - nn / n - (g - 1))) AS rho
              FROM (SELECT count(*)::DOUBLE AS g, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE / sum(n) AS p,
                           sum(n * n)::DOUBLE AS nn, sum(bad::DOUBLE * bad / n) AS kk FROM {} WHERE n > 0))"""
    fits = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
    rules = sorted(hosts.RULES, key=lambda r: -len(r.text))
    rule = " ".join(f"WHEN {fits.format(r.host, r.path)} THEN '{r.text}'" for r in rules)
    verdict = " ".join(f"WHEN rule = '{r.text}' THEN '{r.verdict}'" for r in rules)
    long_suffixes = ", ".join(f"'{x}'" for x in hosts.LONG_SUFFIXES)
    return rf"""
        WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)([^?#]*)', 1), ''), '{hosts.UPPER}', '{hosts.LOWER}') AS host,
                          coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
        r AS (SELECT *, CASE {rule} END AS rule, regexp_replace(regexp_replace(regexp_replace(host, '\A.*@', ''), ':[0-9]*\z', ''), '\.+\z', '') AS site FROM u),
        v AS (SELECT *, CASE {verdict} END AS by_rule FROM r),
        h0 AS (SELECT site AS host, count(by_rule) AS n, count(*) FILTER (by_rule = 'block') AS bad, string_split(site, '.') AS d, regexp_matches(site, '{hosts.ADDRESS}') AS address FROM v GROUP BY site),
        h1 AS (SELECT host, n, bad, address, CASE WHEN address THEN host ELSE array_to_string(CASE WHEN array_to_string(d[-2:], '.') IN ({long_suffixes}) THEN d[-3:] ELSE d[-2:] END, '.') END AS domain FROM h0),
        h AS (SELECT *, CASE WHEN address THEN '' ELSE regexp_replace(domain, '\A[^.]*\.', '') END AS suffix FROM h1),
        d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
        s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
        ms AS ({moments.format("s")}), md AS ({moments.format("d")}), mh AS ({moments.format("h")}),
        t AS (SELECT CASE WHEN sum(n) > 0 THEN sum(bad)::DOUBLE / sum(n) ELSE 0 END AS p FROM s),
        s2 AS (SELECT suffix, (bad + ms.m * t.p) / (n + ms.m) AS p FROM s, ms, t),
        d2 AS (SELECT domain, (bad + md.m * s2.p) / (n + md.m) AS p FROM d JOIN s2 USING (suffix), md),
        h2 AS (SELECT host, bad + mh.m * d2.p AS a, n - bad + mh.m * (1 - d2.p) AS b FROM h JOIN d2 USING (domain), mh),
        h3 AS (SELECT host, a / (a + b) - 1.645 * sqrt((a / (a + b)) * (1 - a / (a + b)) / (a + b + 1)) AS lower FROM h2)
        SELECT page_id, v.host, path, rule, coalesce(by_rule, CASE WHEN lower >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict
        FROM v JOIN h3 ON v.site = h3.host"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hilbert_sharding": op1_hilbert_sharding,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_sentencepiece_merge_dropout": op4_sentencepiece_merge_dropout,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_url_filters": op6_url_filters,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_token_counts": op8_token_counts,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_document_fingerprints": op10_document_fingerprints,
}

#: SQL for the operators that SQL can express; the others are tested against brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op5_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY norm)""",
    "op6_url_filters": hosts_sql(),
}
