"""URL rules by hashed host-suffix and path-prefix expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingofold.llm.common import text_or_empty
from lingofold.operators.lookup import measured_bytes

#: Verdict, host and path of the rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DEFAULT_VERDICT = "allow"
HASH_CHARS = 8
RULE_BYTES = 64 << 20


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host and path as they stand in the url; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.regexp_extract(text_or_empty(url), pattern, 1)
    return F.translate(host, upper, upper.lower()), F.regexp_extract(text_or_empty(url), pattern, 2)


def hashed_rules(rules: DataFrame) -> DataFrame:
    """Rules (verdict, host, path) with their digest; of equal expressions a block wins."""
    return (
        rules.withColumn("rule", F.concat("host", "path"))
        .where(F.col("rule").isNotNull())
        .groupBy("rule", F.col("host").alias("rule_host"), F.col("path").alias("rule_path"))
        .agg(F.max("verdict").alias("rule_verdict"))
        .withColumn("digest", F.sha2("rule", 256))
        .withColumn("short", F.substring("digest", 1, HASH_CHARS))
    )


def expressions(addresses: DataFrame, path_lengths: list[int]) -> DataFrame:
    """Every host suffix with every path prefix of a length that some rule has."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    lengths = F.filter(F.array(*[F.lit(n) for n in path_lengths]), lambda n: n <= F.length("path"))
    prefixes = F.transform(lengths, lambda n: F.col("path").substr(F.lit(1), n))
    pairs = F.flatten(
        F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p)))
    )
    return (
        addresses.select("host", "path", F.explode_outer(F.array_distinct(pairs)).alias("expression"))
        .where(F.col("expression").isNotNull())
        .withColumn("full", F.sha2("expression", 256))
        .withColumn("short", F.substring("full", 1, HASH_CHARS))
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    A rule fits its host and all subdomains where the path starts with the rule's path. The longest
    rule wins, then the one with the longer host, then a block. Without a fitting rule, and for
    null, empty and malformed urls, the rule is null and the verdict is ``default``. Repeated rows
    are judged alike; other columns are not read; an empty table gives no rows.

    Distinct (host, path) pairs are expanded, so a hot url is expanded once. Expressions meet the
    rules on the first ``HASH_CHARS`` hex digits and are confirmed on the whole digest.
    """
    host, path = host_and_path(url_col)
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    table = hashed_rules(rules)
    # distinct lengths of rule paths: bounded by the longest rule, not by the number of rules
    lengths = sorted(r["n"] for r in table.select(F.length("rule_path").alias("n")).distinct().toLocalIterator())
    if not lengths:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    if measured_bytes(table) <= RULE_BYTES:
        table = F.broadcast(table)
    rank = F.struct(F.length("rule"), F.length("rule_host"), F.col("rule_verdict"), F.col("rule"))
    best = (
        expressions(rows.select("host", "path").distinct(), lengths)
        .join(table, "short")
        .where(F.col("full") == F.col("digest"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "rule_verdict"), rank).alias("hit"))
        .select("host", "path", F.col("hit.rule").alias("rule"), F.col("hit.rule_verdict").alias("verdict"))
    )
    return rows.join(best, ["host", "path"], "left").select(
        id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
