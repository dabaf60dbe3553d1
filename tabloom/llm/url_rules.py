"""URL filters: host-suffix and path-prefix expressions joined with rules on short hash prefixes.

Only built-in functions run on the main path. Edge cases: a null url or one without `://` has an empty host and path and
gets the default verdict; repeated rows are judged once and returned as often as they came; of two rules on one host and
path `block` wins; an empty rule table leaves the default for all; a url of any length gives as many expressions as there are shapes of
rules; columns other than id and url are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.frames import name
from tabloom.session import small_table

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of a digest that the join is keyed on; full digests are compared afterwards.
SHORT = 8
#: Rules up to this number are broadcast (about 200 bytes each); more are joined by a shuffle.
BROADCAST_RULES = 100_000


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rows (action, host, path) of driver-held rules."""
    return small_table(spark, rules, "action string, host string, path string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lowered) after the first `://` and the path up to `?` or `#`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWERED), path


def judge(
    pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url: str = "url", default: str = "allow",
) -> DataFrame:
    """Rows (id, url, host, path, rule, verdict), one per row of `pages`.

    A rule fits its host and all its subdomains where the path starts with the rule's; the longest text host + path
    wins, then the longer host, then `block`.
    """
    rules = (
        rules.select(F.lower("action").alias("action"), F.translate("host", UPPER, LOWERED).alias("rule_host"),
                     F.coalesce("path", F.lit("")).alias("rule_path"))
        .where("rule_host != '' AND action IN ('allow', 'block')")
        .groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"))
        .withColumn("rule", F.concat("rule_host", "rule_path"))
        .withColumn("rule_digest", F.sha2(F.concat(F.length("rule_path").cast("string"), F.lit(":"), "rule"), 256))  # the length tells host from path
        .withColumn("short", F.substring("rule_digest", 1, SHORT))
    )
    labels, width = F.size(F.split("rule_host", r"\.")), F.length("rule_path")
    # Numbers of host labels and path characters that occur in rules: other expressions cannot match any.
    shapes = rules.agg(F.count("*").alias("n"), F.collect_set(F.struct(labels.alias("k"), width.alias("m"))).alias("s")).first()
    host, path = host_and_path(F.col("own_url"))
    judged = (
        pages.select(name(id_column).alias("own_id"), name(url).alias("own_url"))
        .groupBy("own_id", "own_url").agg(F.count("*").alias("times"))
        .withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))
    )
    if shapes["s"]:
        parts = F.split("host", r"\.")
        expressions = F.array_compact(F.array(*[
            F.when(
                (F.size(parts) >= k) & (F.length("path") >= m),
                F.concat(F.lit(f"{m}:"), F.array_join(F.slice(parts, F.size(parts) - k + 1, F.lit(k)), "."), F.substring("path", 1, m)),
            )
            for k, m in sorted((s["k"], s["m"]) for s in shapes["s"])
        ]))
        digests = F.sha2(F.col("expression").cast("binary"), 256)
        expanded = (
            judged.withColumn("expression", F.explode_outer(expressions))
            .withColumn("digest", digests).withColumn("key", F.substring("digest", 1, SHORT))
        )
        side = F.broadcast(rules) if shapes["n"] <= BROADCAST_RULES else rules
        hit = (F.col("key") == F.col("short")) & (F.col("digest") == F.col("rule_digest"))
        order = F.struct(F.length("rule"), F.length("rule_host"), F.col("action") == "block", F.col("rule"), F.col("action"))
        judged = (
            expanded.join(side, hit, "left")
            .groupBy("own_id", "own_url")
            .agg(F.first("times").alias("times"), F.first("host").alias("host"), F.first("path").alias("path"),
                 F.max(F.when(F.col("rule").isNotNull(), order)).alias("best"))
            .withColumn("rule", F.col("best.rule")).withColumn("verdict", F.coalesce("best.action", F.lit(default)))
        )
    else:
        judged = judged.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    once = judged.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return once.select(F.col("own_id").alias(id_column), F.col("own_url").alias(url), "host", "path", "rule", "verdict")
