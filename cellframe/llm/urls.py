"""URL filters: host-suffix and path-prefix expressions, joined to rules on short hash prefixes.

A rule (host, path, verdict) fits a URL if the URL's host is the rule's or a subdomain of it and the URL's path starts with the
rule's; the longest fitting rule decides. Only DataFrame functions, no Python on the executors:

1. A rule is stored under its head, its host and its path up to the last slash; the head's digest is cut to ``PREFIX`` hex digits.
   With the head goes how many characters of path its rules have behind it.
2. Every distinct URL is expanded into the suffixes of its host and the prefixes of its path that end at a slash. Their digests
   are equi-joined to the heads on the short prefix, and confirmed on all 256 bits.
3. A confirmed head with the next characters of the path, as many as one of its rules has, is a full expression, and is joined to
   the rules in the same way. So a URL never meets all rules of a head, and a rule may end anywhere in a path.
4. The longest confirmed rule of each URL is kept (an aggregate with partial results), and joined back to the rows by the URL and
   its hash: both sides are shuffled for this join alone, so hot URLs, nulls among them, can be split.

Hosts and paths are cut to the longest of the rules before they are expanded: a longer suffix or prefix fits none. The joins leave
it to Spark whether the rules are small enough to be broadcast (by measured size); if not, adaptive execution splits hot hash
prefixes and hot URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm.registry import query

#: Hex digits of a digest that the joins compare first: 32 bits.
PREFIX = 8

#: Rules of the query: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case; empty for a null or another URL."""
    return F.translate(F.coalesce(F.regexp_extract(_behind_scheme(url), r"^[^/?#]*", 0), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """Behind the host, up to ``?`` or ``#``; empty for a null or another URL."""
    return F.coalesce(F.regexp_extract(_behind_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _head(path: Column) -> Column:
    return F.regexp_extract(path, r"^(?s:.*/)?", 0)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def _short(digest: Column) -> Column:
    return F.substring(digest, 1, PREFIX)


def rules(spark: SparkSession, given: list[tuple[str, str, str]]) -> DataFrame:
    """A table of rules that is made in the JVM."""
    rows = F.array(*(F.struct(*(F.lit(x) for x in r)) for r in given))
    return spark.range(1).select(F.inline(rows.cast("array<struct<host:string,path:string,verdict:string>>")))


def _best_rules(given: DataFrame) -> DataFrame:
    """(host, path, verdict), each host and path once. Rules that can fit no URL and those with a null are left out."""
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    known = F.col("verdict").isin("allow", "block") & F.col("path").isNotNull() & ~F.col("host").rlike("[/?#]")
    possible = (F.col("path") == "") | F.col("path").startswith("/")
    kept = given.filter(known & possible & ~F.col("path").rlike("[?#]")).select(host.alias("host"), "path", "verdict")
    return kept.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # 'block' comes after 'allow'


def match(urls: DataFrame, given: DataFrame) -> DataFrame:
    """(url, rule, verdict) of the distinct URLs in the column ``url`` that some rule fits."""
    best = _best_rules(given)
    keyed = best.select("*", _digest(F.col("host"), F.col("path")).alias("digest")).select("*", _short(F.col("digest")).alias("short"))
    head = best.select("host", _head(F.col("path")).alias("head"), "path")
    heads = head.groupBy("host", "head").agg(F.collect_set(F.length("path") - F.length("head")).alias("more"))
    heads = heads.select(_digest(F.col("host"), F.col("head")).alias("digest"), "more")
    heads = heads.select(_short(F.col("digest")).alias("short"), F.col("digest").alias("head_digest"), "more")
    longest = best.agg(F.coalesce(F.max(F.length("host")), F.lit(0)).alias("h"), F.coalesce(F.max(F.length("path")), F.lit(0)).alias("p"))
    h, p = longest.select("h").scalar(), longest.select("p").scalar()

    url = F.col("url")
    one = urls.select("url").filter(url.isNotNull()).distinct().select("url", host_of(url).alias("host"), path_of(url).alias("path"))
    tail = F.substr("host", F.greatest(F.length("host") - h, F.lit(1)), h + 1)  # one more: what is cut off must not look like a host
    labels = F.split(tail, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size("labels")), lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))
    steps = F.split(F.substr("path", F.lit(1), p), "/", -1)
    prefixes = F.transform(F.sequence(F.lit(0), F.size("steps") - 1), lambda i: F.when(i == 0, "").otherwise(
        F.concat(F.array_join(F.slice("steps", 1, i), "/"), F.lit("/"))))
    expanded = one.select("url", "path", labels.alias("labels"), steps.alias("steps"))
    expanded = expanded.select("url", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
    expanded = expanded.select("url", "path", "suffix", F.explode("prefixes").alias("prefix"))
    expanded = expanded.select("*", _digest(F.col("suffix"), F.col("prefix")).alias("digest")).select("*", _short(F.col("digest")).alias("short"))

    found = expanded.join(heads, "short").filter(F.col("digest") == F.col("head_digest"))
    full = found.select("url", "suffix", "path", F.length("prefix").alias("n"), F.explode("more").alias("more"))
    full = full.filter(F.col("n") + F.col("more") <= F.length("path")).select(
        "url", _digest(F.col("suffix"), F.substr("path", F.lit(1), F.col("n") + F.col("more"))).alias("full_digest")
    ).select("*", _short(F.col("full_digest")).alias("short"))
    fits = full.join(keyed, "short").filter(F.col("digest") == F.col("full_digest"))
    order = F.struct(F.length("host") + F.length("path"), F.length("host"))
    decided = fits.groupBy("url").agg(F.max_by(F.struct(F.concat("host", "path").alias("rule"), "verdict"), order).alias("r"))
    return decided.select("url", "r.rule", "r.verdict")


def judge(df: DataFrame, given: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """``df`` with host, path, rule and verdict of its URLs by the rules (host, path, verdict 'allow' or 'block').

    The longest fitting rule by characters of host and path decides; of two, the one with the longer host; of equal ones with both
    verdicts, 'block'. Where no rule fits, the rule is null and the verdict ``otherwise``. A null URL, or one without ``://``, has an
    empty host and path, and only a rule with an empty host and path fits it if it isn't null. Repeated rows are judged alike and
    stay; a rule with a null, an unknown verdict, or a host or path that no URL can have fits nothing; without rows no rows, without
    rules ``otherwise`` for all. Raises if a column of the result's names exists.
    """
    if clash := {"host", "path", "rule", "verdict"} & {c.lower() for c in df.columns}:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    decided = match(df.select(F.col(url).alias("url")), given).alias("decided")
    rows = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).alias("rows")
    a, b = F.col(f"rows.`{url}`"), F.col("decided.url")
    joined = rows.join(decided, (a == b) & (F.xxhash64(a) == F.xxhash64(b)), "left")
    verdict = F.coalesce("decided.verdict", F.lit(otherwise)).alias("verdict")
    return joined.select("rows.*", "decided.rule", verdict)


_SQL_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
SQL = rf"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_SQL_RULES}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
cut AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS k FROM rest),
fits AS (SELECT k, rule_host || rule_path AS rule, rule_verdict,
  row_number() OVER (PARTITION BY k ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM cut JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM cut LEFT JOIN fits ON fits.k = cut.k AND place = 1"""


@query("op12_url_filters", SQL)
def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, rules(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")
