"""The registered queries of the operators on text, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm import (
    common, conversation_trie, decontaminate, language_profiles, lattice_lm, length_buckets, periodic_runs, quality_ratio, simhash, substring_index, suffix_levels, token_files, toxicity, url_rules,
)

URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def table(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{which}.parquet")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.working_folder(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, byte_bpe())
    return token_files.read_tokens(spark, folder)


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_levels.report(table(spark, sf_dir, "documents"))


def op4_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ratio.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_substring_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_index.report(table(spark, sf_dir, "documents"))


def op6_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_buckets.report(table(spark, sf_dir, "documents"), byte_bpe())


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_profiles.report(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op11_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score(table(spark, sf_dir, "documents"), piece_bpe(), group="lang")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.report(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_url_rules, op3_suffix_levels, op4_quality_ratio, op5_substring_index, op6_length_buckets, op7_decontaminate, op8_toxicity,
    op9_language_profiles, op10_simhash, op11_lattice_lm, op12_periodic_runs, op13_conversation_trie,
)}

ORACLE = {
    "op2_url_rules": """
WITH a AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), b AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a
), c AS (
  SELECT page_id, coalesce(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path FROM b
), r(action, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM (
  SELECT c.page_id, c.host, c.path, r.rule_host || r.rule_path AS rule, r.action,
         row_number() OVER (PARTITION BY c.page_id ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS k
  FROM c LEFT JOIN r ON (c.host = r.rule_host OR ends_with(c.host, '.' || r.rule_host)) AND starts_with(c.path, r.rule_path)
) WHERE k = 1
""",
    "op13_conversation_trie": """
WITH turns AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1
), hashed AS (
  SELECT c, own, c - c % 100 AS lead, xor(4294967295, list_reduce(
    list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda crc, byte: list_reduce(
      CAST([1, 2, 3, 4, 5, 6, 7, 8] AS BIGINT[]),
      lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(crc, byte)),
    CAST(4294967295 AS BIGINT))) % 6 AS h FROM turns
), rebuilt AS (
  SELECT a.c, list_concat(coalesce(b.own, [])[1:a.h], a.own[a.h + 1:]) AS seq FROM hashed a LEFT JOIN turns b ON a.lead = b.c
), members AS (
  SELECT c, len(seq) AS n, unnest(range(0, len(seq) + 1)) AS d, seq FROM rebuilt
), prefixes AS (
  SELECT c, n, d, seq[1:d] AS p, CASE WHEN d > 0 THEN seq[1:d - 1] END AS up FROM members
), nodes AS (
  SELECT p, d, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(length(any_value(p[d].t)), 0) AS own_saved,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM prefixes GROUP BY p, d
), below AS (
  SELECT up AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), counted AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN below USING (p)
), above AS (
  SELECT p[1:k] AS top, own_saved, n_children = 0 AS leaf FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM counted)
), sums AS (
  SELECT top AS p, CAST(count(*) FILTER (WHERE leaf) AS BIGINT) AS n_leaves, CAST(sum(own_saved) AS BIGINT) AS saved_tokens FROM above GROUP BY 1
)
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, b.conv_id AS parent_conv_id, a.n_convs, a.n_children, n_leaves, saved_tokens, a.ends_sha256
FROM counted a JOIN sums USING (p) LEFT JOIN nodes b ON a.d > 0 AND a.up = b.p
""",
}
