"""URL filters: rules of hosts and paths, and pattern rules found by their rarest token.

Both kinds are looked up by key, never tried one after the other. A host rule's key is
its host, fetched by the hosts above and including that of the URL. A pattern's key is
the token of its text that the fewest distinct URLs contain; a URL fetches by its own
tokens, and only what it fetched runs a regular expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path, verdict); fixed values of the query.
HOST_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

#: (pattern, verdict): ``*`` is any text, line ends too, ``^`` a sign other than a letter or digit, or an end.
PATTERN_RULES = [
    ("^casino^", "block"),
    ("^casino-win^", "block"),
    ("^free-bets^", "block"),
    ("^poker^", "block"),
    ("^xxx^", "block"),
    ("^payday*loan^", "block"),
    ("^utm_source=spam^", "block"),
    ("^archive^pdf^", "allow"),
]

DEFAULT = "allow"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, CAPITALS, SMALL)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; empty without ``://`` or URL."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def pattern_regex(pattern: str) -> str:
    """The regular expression of a pattern, for lower-case URLs."""
    special = {"*": "(?s:.*)", "^": "(?:[^0-9a-z]|^|$)"}
    return "".join(special.get(c) or re.escape(c) for c in pattern.lower())


def pattern_tokens(pattern: str) -> list[str]:
    """Runs of letters and digits that every matching URL has as whole tokens."""
    return sorted(set(re.findall(r"(?<=[^0-9a-z*])[0-9a-z]+(?=[^0-9a-z*])", pattern.lower())))


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lower_ascii(url), F.lit("[0-9a-z]+"), 0))


def pattern_index(urls: DataFrame, patterns: DataFrame) -> DataFrame:
    """``key, pattern, regex, verdict``: each pattern under its rarest token, counted over all ``urls`` (url).

    Ties go to the token first in order. A pattern without a whole token gets the key
    ``''``, which every URL fetches.
    """
    wanted = patterns.select("pattern", F.explode("tokens").alias("key"))
    seen = urls.select(F.explode(url_tokens(F.col("url"))).alias("key"))
    counts = seen.join(wanted.select("key").distinct(), "key").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    rarest = wanted.join(counts, "key", "left").groupBy("pattern").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key")).getField("key").alias("key")
    )
    return patterns.join(rarest, "pattern", "left").select(
        F.coalesce("key", F.lit("")).alias("key"), "pattern", "regex", "verdict"
    )


def pattern_table(spark: SparkSession, patterns: Iterable[tuple[str, str]]) -> DataFrame:
    rows = [(p, pattern_tokens(p), pattern_regex(p), v) for p, v in patterns]
    return spark.createDataFrame(rows, "pattern string, tokens array<string>, regex string, verdict string")


def host_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, rule, verdict`` of the longest rule that fits, for URLs that some rule fits.

    Of rules of equal length the one with the longer host wins.
    """
    labels = F.split("_host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )
    keyed = urls.select("url", host_of(F.col("url")).alias("_host"), path_of(F.col("url")).alias("_path")).filter(
        "_host <> ''"
    )
    keyed = keyed.select("url", "_path", F.explode(F.array_distinct(above)).alias("host"))
    rule = F.concat("host", "path")
    order = F.struct(F.length(rule).alias("n"), F.length("host").alias("n_host"), rule.alias("rule"), "verdict")
    return keyed.join(rules, "host").filter(F.col("_path").startswith(F.col("path"))).groupBy("url").agg(
        F.max(order).alias("best")
    ).select("url", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))


def pattern_verdicts(urls: DataFrame, index: DataFrame) -> DataFrame:
    """``url, pattern, verdict`` of the longest pattern that matches, for URLs that some pattern matches."""
    keyed = urls.select("url", F.explode(F.array_append(url_tokens(F.col("url")), "")).alias("key"))
    matched = keyed.join(index, "key").filter(F.rlike(lower_ascii(F.col("url")), F.col("regex")))
    order = F.struct(F.length("pattern").alias("n"), "pattern", "verdict")
    return matched.groupBy("url").agg(F.max(order).alias("best")).select(
        "url", F.col("best.pattern").alias("pattern"), F.col("best.verdict").alias("pattern_verdict")
    )


def judged(pages: DataFrame, hosts: DataFrame, patterns: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``page_id, url, host, path, rule, pattern, verdict`` for every row of ``pages`` (other columns are ignored).

    The verdict is that of the host rule; without one that of the pattern; else ``default``.
    Every distinct URL is judged once, however many rows have it. A null URL, or one
    without ``://``, has an empty host and path and fits no rule; patterns see the whole
    URL. Repeated rows stay. No size is assumed for either set of rules: Spark broadcasts
    them below its own threshold and shuffles them above it.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    urls = rows.select("url").filter("url is not null").distinct()
    by_host = host_verdicts(urls, hosts)
    by_pattern = pattern_verdicts(urls, pattern_index(urls, patterns))
    verdicts = by_host.join(by_pattern, "url", "full")
    return rows.join(verdicts, "url", "left").select(
        "page_id", "url",
        F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"),
        "rule", "pattern",
        F.coalesce("rule_verdict", "pattern_verdict", F.lit(default)).alias("verdict"),
    )
