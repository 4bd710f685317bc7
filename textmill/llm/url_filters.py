"""URL filters: host-suffix and path-prefix expressions against a table of rules.

Each distinct URL is expanded into the expressions a rule could have (every
suffix of its host at a dot, every prefix of its path with the length of some
rule path). Expressions meet the rules in an equi-join on the first 32 bits of
their SHA-256; the full digest decides. The longest fitting rule wins. Only
DataFrame functions are used, and only URLs and digests travel.

Defined results
    null URL, or one without "://": empty host and path, no rule, ``default``.
    Rules of equal length: the longer path, then block before allow.
    Repeated URLs and rows: judged once, every row gets the verdict.
    Empty tables (pages or rules): no rows, or ``default`` for all.
    Columns host, path, rule and verdict of the input are replaced.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textmill.llm.rows import left_lookup

RULE_SCHEMA = "verdict string, host string, path string"
PREFIX_HEX = 8


class UrlRule(NamedTuple):
    verdict: str
    host: str
    path: str


def rule_table(spark: SparkSession, rules: list[UrlRule]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], RULE_SCHEMA)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty when it has no "://"."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def _suffixes(host: Column, most_labels: int) -> Column:
    labels = F.split(host, "\\.")
    n = F.size(labels)
    first = F.greatest(n - (most_labels - 1), F.lit(1))
    return F.transform(F.sequence(first, n), lambda i: F.array_join(F.slice(labels, i, n), "."))


def _prefixes(path: Column, lengths: list[int]) -> Column:
    fitting = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda k: k <= F.length(path))
    return F.transform(fitting, lambda k: F.substr(path, F.lit(1), k))


def expressions(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """One row per URL and expression: its digest and the digest's short prefix.

    Longer host suffixes than any rule has, and path prefixes of other lengths,
    cannot equal a rule and are not made. That shape of the rules is one number
    and the distinct lengths of their paths, at most as many as the longest has characters.
    """
    shape = rules.agg(
        F.coalesce(F.max(F.size(F.split("host", "\\."))), F.lit(1)), F.sort_array(F.collect_set(F.length("path")))
    ).first()
    host, path = split_url(F.col(url))
    parts = urls.select(url, host.alias("_host"), path.alias("_path")).where("_host <> ''")
    by_host = parts.select(url, "_path", F.explode(_suffixes(F.col("_host"), shape[0])).alias("_h"))
    by_path = by_host.select(url, "_h", F.explode(_prefixes(F.col("_path"), shape[1])).alias("_p"))
    digest = F.sha2(F.concat("_h", "_p"), 256)
    return by_path.select(url, digest.alias("_digest")).withColumn("_short", F.substring("_digest", 1, PREFIX_HEX))


def matching_rules(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The winning rule of each distinct URL that some rule fits."""
    name = F.concat("host", "path")
    listed = rules.where("host is not null and path is not null").select(
        name.alias("_rule"),
        F.col("verdict").alias("_verdict"),
        F.length("path").alias("_path_len"),
        F.sha2(name, 256).alias("_rule_digest"),
    ).withColumn("_short", F.substring("_rule_digest", 1, PREFIX_HEX))
    met = expressions(urls.select(url).where(F.col(url).isNotNull()).distinct(), rules, url).join(listed, "_short")
    confirmed = met.where("_digest = _rule_digest")
    rank = F.struct(F.length("_rule"), "_path_len", F.col("_verdict") == "block", "_rule", "_verdict")
    won = confirmed.groupBy(url).agg(F.max(rank).alias("_won"))
    return won.select(url, F.col("_won._rule").alias("rule"), F.col("_won._verdict").alias("verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule (null when none fits) and verdict to every row."""
    pages = pages.drop("host", "path", "rule", "verdict")
    host, path = split_url(F.col(url))
    spread = F.struct(*[c for c in pages.columns if c != url][:1] or [url])
    judged = left_lookup(pages, matching_rules(pages, rules, url), [url], spread)
    order = [c for c in judged.columns if c not in ("rule", "verdict")]
    return judged.select(
        *order,
        host.alias("host"),
        path.alias("path"),
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
