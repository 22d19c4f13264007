"""URL filters: host-suffix and path-prefix expressions, joined with the rules on short hash prefixes.

As in safe-browsing lists, a URL becomes the set of its host suffixes crossed with its path prefixes, and a rule is found
by the first four bytes of its expression's SHA-256. The full digest and the rest of the rule's path then confirm it, and
the longest rule decides. Only DataFrame functions are used. The rules join as Spark's size rule says: broadcast while
they are small, by a shuffle on the prefix beyond that.

Defined results. Null URL, or one without "://": host and path empty, no rule fits. Only A-Z of the host are lower-cased;
ports and user names are part of the host. An empty path starts with no rule path but the empty one. Rules with a null or
empty host fit nothing; a null rule path is empty. Of equal rules with different actions, the alphabetically last
("block" after "allow") counts; of different rules of one length, the one with the longer host. Rows with equal or null
ids are judged one by one. Other columns of the input are not read.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
PREFIX_HEX = 8


def rules_of(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(rule_host, rule_path, action) of literal rules."""
    if not rules:
        return spark.sql("SELECT '' AS rule_host, '' AS rule_path, '' AS action WHERE false")
    names = {f"v{i}_{k}": value for i, rule in enumerate(rules) for k, value in enumerate(rule)}
    rows = ", ".join(f"(:v{i}_0, :v{i}_1, :v{i}_2)" for i in range(len(rules)))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(rule_host, rule_path, action)", args=names)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, PARTS, 1)), F.regexp_extract(url, PARTS, 2)


def _prefix(digest: Column) -> Column:
    return F.substring(digest, 1, PREFIX_HEX)


def _keyed(rules: DataFrame) -> DataFrame:
    host, path = lower_ascii(F.col("rule_host")), F.coalesce("rule_path", F.lit(""))
    stem = F.regexp_extract(path, r"(?s)^(.*/)?", 1)  # up to the last slash: the part that is hashed
    return (
        rules.filter(F.length("rule_host") > 0)
        .groupBy(host.alias("rule_host"), path.alias("rule_path"))
        .agg(F.max("action").alias("action"))
        .select("rule_host", "rule_path", "action", F.sha2(F.concat(F.col("rule_host"), stem), 256).alias("rule_digest"),
                F.size(F.split("rule_host", r"\.")).alias("labels"), (F.size(F.split(stem, "/")) - 1).alias("slashes"))
    )


def expressions(host: Column, path: Column, labels: int, slashes: int) -> Column:
    """Host suffixes of up to `labels` labels, each followed by "" and by the path up to each of `slashes` slashes."""
    names, parts = F.split(host, r"\."), F.split(path, "/")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(names), F.lit(labels))),
        lambda n: F.array_join(F.slice(names, F.size(names) - n + 1, n), "."),
    )
    depth = F.least(F.size(parts) - 1, F.lit(slashes))
    stems = F.transform(F.sequence(F.lit(0), depth), lambda n: F.when(n > 0, F.concat(F.array_join(F.slice(parts, 1, F.greatest(n, F.lit(1))), "/"), F.lit("/"))).otherwise(""))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(stems, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, *, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: key, host, path, rule (null if none fits), verdict.

    The number of labels and slashes in the longest rules (one row of two numbers) bounds the expressions; none beyond
    could be any rule's.
    """
    keyed = _keyed(rules)
    labels, slashes = keyed.agg(F.max("labels"), F.max("slashes")).first()
    host, path = host_and_path(F.col(url))
    judged = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    found = (
        judged.select("host", "path")
        .filter(F.length("host") > 0)
        .withColumn("digest", F.explode(F.transform(expressions(F.col("host"), F.col("path"), labels or 1, slashes or 0), lambda e: F.sha2(e, 256))))
        .withColumn("prefix", _prefix(F.col("digest")))
        .join(keyed.withColumn("prefix", _prefix(F.col("rule_digest"))), "prefix")
        .filter((F.col("digest") == F.col("rule_digest")) & F.col("path").startswith(F.col("rule_path")))
    )
    rule = F.concat("rule_host", "rule_path")
    best = found.groupBy("host", "path").agg(
        F.max(F.struct(F.length(rule), F.length("rule_host"), rule.alias("rule"), "action")).alias("best")
    )
    return judged.join(best, ["host", "path"], "left").select(
        key, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict")
    )
