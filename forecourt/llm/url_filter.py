"""Operator 2: URL filters by hash-prefix lookup of host-suffix and path-prefix expressions.

Each distinct (host, path) is expanded into expressions: every suffix of the host at a dot that has no
more labels than the longest rule host (so a host of many labels costs no more than its length), joined with every prefix of the path whose length some rule's path has.  Expressions and rules meet in an
equi-join on the first four bytes of their SHA-256 digests; a match counts only if the full digests
agree.  Of the rules that fit, the longest (host and path together) decides, then the one with the
longer host, then ``block``.

The join carries digests, not texts.  Addresses are made distinct first and verdicts are joined back
on (host, path), an ordinary join whose hot partitions Spark splits, so a host or an address with a
third of all rows is looked up once.  The rule table may be of any size; the driver only sees the
distinct lengths of rule paths, at most ``MAX_RULE_PATH`` numbers, and the labels of the longest rule host.

Cases: a null url, or one without ``://``, has an empty host and path, which no rule with a host fits;
repeated rows and ids stay; an empty table gives an empty result; an empty rule table gives the
default verdict everywhere; rules with a null host, path or verdict are left out; equal rules with
both verdicts count as ``block``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import literal_table, lower_ascii

#: Longest rule path; a longer one is refused with an error, not cut.
MAX_RULE_PATH = 4096
PREFIX_DIGITS = 8
CONTRACT_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def verdicts(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the deciding rule) and ``verdict``.

    ``rules(host, path, verdict)``.  Columns of those four names in ``pages`` are replaced.
    """
    usable = rules.select(lower_ascii(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")).dropna()
    lengths = sorted(r[0] for r in usable.select(F.least(F.length("r_path"), F.lit(MAX_RULE_PATH + 1))).distinct().collect())
    if lengths and lengths[-1] > MAX_RULE_PATH:
        raise ValueError(f"a rule's path is longer than {MAX_RULE_PATH}")
    deepest = usable.agg(F.max(F.size(F.split("r_host", r"\.")))).first()[0] or 1
    book = (
        usable.groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
        .withColumn("digest", _digest(F.col("r_host"), F.col("r_path")))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )
    at = pages.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))}).drop("rule", "verdict")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - deepest + 1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.lit(deepest)), "."))
    prefixes = F.filter(F.array(*(F.lit(n) for n in lengths)).cast("array<int>"), lambda n: n <= F.length("path"))
    expressions = (
        at.select("host", "path").distinct()
        .select("host", "path", F.explode(suffixes).alias("suffix"))
        .select("host", "path", "suffix", F.explode(F.transform(prefixes, lambda n: F.substring(F.col("path"), F.lit(1), n))).alias("start"))
        .select("host", "path", _digest(F.col("suffix"), F.col("start")).alias("full"))
        .withColumn("prefix", F.substring("full", 1, PREFIX_DIGITS))
    )
    order = F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"), F.col("r_verdict") == "block", "r_host", "r_path")
    decided = (
        expressions.join(book, "prefix").filter(F.col("full") == F.col("digest"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")), order).alias("won"))
        .select(F.col("host").alias("__host"), F.col("path").alias("__path"), "won.rule", "won.verdict")
    )
    return (
        at.join(decided, (F.col("host") == F.col("__host")) & (F.col("path") == F.col("__path")), "left")
        .drop("__host", "__path")
        .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = literal_table(spark, CONTRACT_RULES, "host string, path string, verdict string")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return verdicts(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(r_host, r_path, r_verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT p.*, r_host || r_path AS rule, r_verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(r_host || r_path) DESC) AS n
  FROM parts p LEFT JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
)
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM fits WHERE n = 1
"""
