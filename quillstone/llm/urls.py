"""URL filter: host-suffix and path-prefix expressions joined to rules on short hash prefixes.

DataFrame functions only. A URL becomes one expression for each pair of a host suffix (cut at
dots) and a path prefix, of the sizes that rules have. Expressions meet rules on the first
digits of a SHA-256 digest; the full digest is compared afterwards, and the longest rule wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of a digest that make the join key.
PREFIX_DIGITS = 8
#: Rules are broadcast up to this number; more are joined by a shuffle.
MAX_BROADCAST_RULES = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)


def url_host(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, with A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ? or #; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_suffixes(host: Column, sizes: Sequence[int]) -> Column:
    """The host's suffixes of these numbers of labels, as far as it has so many; none for an empty host.

    Only numbers that rules have can fit, so a long host makes no more suffixes than a short one.
    """
    labels = F.length(host) - F.length(F.translate(host, ".", "")) + 1
    each = F.array(*[F.when(labels >= n, F.substring_index(host, ".", -n)) for n in sizes]).cast("array<string>")
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_compact(each))


def path_prefixes(path: Column, lengths: Sequence[int]) -> Column:
    """The path's prefixes of these lengths, as far as it is long enough."""
    every = F.array(*[F.lit(n) for n in lengths])
    return F.transform(F.filter(every, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\x00"), path), 256)


def judge_urls(
    df: DataFrame,
    rules: Sequence[Rule] = RULES,
    url: str = "url",
    keep: Sequence[str] = (),
    default: str = "allow",
) -> DataFrame:
    """The `keep` columns of `df` with host, path, rule (host and path of the winning rule) and verdict.

    One row for each row of `df`, repeated rows too. A null URL or one without :// has an empty
    host and path, and no rule; `default` is the verdict where no rule fits. Of fitting rules the
    longest text wins, then the one that sorts first. Only `keep` and the URL are read.
    The only shuffle is by row, after the matches of a row have been reduced to one number.
    """
    spark = df.sparkSession
    ranked = sorted(dict.fromkeys(Rule(*r) for r in rules), key=lambda r: (len(r.host + r.path), r), reverse=True)
    ranked = [r._replace(host=r.host.lower()) for r in ranked]
    # a smaller number is a stronger rule
    table = spark.createDataFrame(
        [(i, r.verdict, r.host, r.path) for i, r in enumerate(ranked)], "rule_no int, rule_verdict string, rule_host string, rule_path string"
    ).withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
    table = table.withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
    small = F.broadcast if len(ranked) <= MAX_BROADCAST_RULES else (lambda x: x)

    own = [f"_keep{i}" for i in range(len(keep))]  # so that no column clashes with the new ones
    rows = df.select(*[df[f"`{c}`"].alias(o) for c, o in zip(keep, own, strict=True)], df[f"`{url}`"].alias("_url"))
    rows = rows.select(*own, url_host(F.col("_url")).alias("host"), url_path(F.col("_url")).alias("path")).withColumn("_row", F.monotonically_increasing_id())

    lengths, sizes = sorted({len(r.path) for r in ranked}), sorted({r.host.count(".") + 1 for r in ranked})
    pairs = F.flatten(
        F.transform(host_suffixes(F.col("host"), sizes), lambda h: F.transform(path_prefixes(F.col("path"), lengths), lambda p: _digest(h, p)))
    )
    expressions = rows.withColumn("_digest", F.explode_outer(pairs)).withColumn("_short", F.substring("_digest", 1, PREFIX_DIGITS))
    hits = expressions.join(small(table.select("short", "digest", "rule_no")), F.col("_short") == F.col("short"), "left")
    best = F.min(F.when(F.col("_digest") == F.col("digest"), F.col("rule_no"))).alias("_best")
    found = hits.groupBy("_row", *own, "host", "path").agg(best)
    named = small(table.select("rule_no", "rule_verdict", F.concat("rule_host", "rule_path").alias("rule")))
    return found.join(named, F.col("_best") == F.col("rule_no"), "left").select(
        *[F.col(o).alias(c) for c, o in zip(keep, own, strict=True)],
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", F.lit(default)).alias("verdict"),
    )


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    from quillstone.llm.common import load

    return judge_urls(load(spark, sf_dir, "pages"), keep=["page_id"])


#: The first :// is found by position, so no pattern crosses lines differently in the two engines.
OP10_SQL = r"""
WITH cut AS (
  SELECT page_id, url, strpos(url, '://') AS pos FROM pages
), rest AS (
  SELECT page_id, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS r FROM cut
), parts AS (
  SELECT page_id, regexp_extract(r, '^([^/?#]*)([^?#]*)', 1) AS h, regexp_extract(r, '^([^/?#]*)([^?#]*)', 2) AS path FROM rest
), hosts AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts
), judged AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/7') THEN 'example.com/en/7'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/de/8') THEN 'example.net/de/8'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/en/') THEN 'com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/de/') THEN 'net/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/es/') THEN 'org/es/'
  END AS rule FROM hosts
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/en/', 'example.net/de/8', 'org/es/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""
