"""URL rules by a sort-merge range join over reversed hosts; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import pinned

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows of one rule host that are swept together.
SWEEP_ROWS = 50_000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str


# The rules of the registered query.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    found = F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", 2), F.lit(""))


def reversed_host(host: Column) -> Column:
    """The labels of a host from the last to the first."""
    return F.concat_ws(".", F.reverse(F.split(host, r"\.")))


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    rows = [(r.host, r.path, r.verdict) for r in rules]
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def _canonical(rules: DataFrame) -> DataFrame:
    """One row per (reversed host, path) with the stack of rules open from there on.

    A rule covers every path that starts with its own: an interval of paths. Two such intervals
    of a host are nested or apart, so the rules open at a rule's start are those whose path is a
    prefix of its path: a window over the shorter prefixes of each path finds them.
    """
    named = rules.where("host is not null and path is not null").select(
        F.translate("host", UPPER, LOWER).alias("host"), "path", F.lower("verdict").alias("verdict")
    )
    # max: block is later in the alphabet than allow, and wins if a rule is given both ways.
    single = named.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    keyed = pinned(single.withColumn("domain", reversed_host(F.col("host"))), "rules")
    # Only prefixes as long as some rule of the domain can be a rule.
    sizes = keyed.select("domain", F.length("path").alias("n")).distinct()
    prefixes = keyed.join(sizes, "domain").where(F.col("n") <= F.length("path")).select(
        "domain", F.col("path").alias("inner"), F.substring("path", F.lit(1), F.col("n")).alias("path")
    )
    opened = prefixes.join(keyed, ["domain", "path"]).select(
        "domain",
        "inner",
        F.struct(F.length("path").alias("size"), "path", "host", "verdict").alias("rule"),
    )
    return opened.groupBy("domain", F.col("inner").alias("path")).agg(
        F.sort_array(F.collect_list("rule"), asc=False).alias("stack")
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    row_id: str = "page_id",
    default: str = "allow",
    sweep_rows: int = SWEEP_ROWS,
) -> DataFrame:
    """(row_id, host, path, rule, verdict) for every row of ``pages``.

    ``rules`` has (host, path, verdict). A rule fits its host and all subdomains if the path
    starts with its path; the longest host and path together win, then the longer host. Hosts are
    compared by reversed labels, so a rule's host is a prefix of all it fits: a page is a point
    under each of the domains above it that has rules. Points and rules of a domain are sorted by
    path and swept once: a rule opens with the stack of rules it lies in, the latest opened stack
    is carried on, and at a point the innermost rule of the stack that still covers it is the
    answer. A domain with many points is swept in shares, each with all rules of the domain.

    Hosts and paths of any length are compared whole; the work for a host grows with its length
    and the labels of the deepest rule.

    Null urls and those without ``://`` have an empty host and path, which no rule fits; such
    pages, and those no rule fits, get ``default``. Repeated rows each get a row, rows without an
    id too. Other columns are ignored. Without rules every page gets the default; an empty table
    gives an empty result.
    """
    split = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(row_id).alias("row_id"),
        url_host(F.col(url)).alias("host"),
        url_path(F.col(url)).alias("path"),
    )
    rows = pinned(split, "urls")
    starts = pinned(_canonical(rules), "stacks")
    labels = F.split(reversed_host(F.col("host")), r"\.")
    # No domain deeper than the deepest rule can have one, however many labels a host has.
    deepest = starts.agg(F.max(F.size(F.split("domain", r"\.")))).first()[0] or 1
    above = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest))),
        lambda n: F.concat_ws(".", F.slice(labels, F.lit(1), n)),
    )
    points = rows.select("row", "path", F.explode(above).alias("domain"))
    points = points.join(starts.select("domain").distinct(), "domain", "left_semi")
    shares = points.groupBy("domain").agg(F.ceil(F.count(F.lit(1)) / F.lit(sweep_rows)).alias("shares"))
    shares = pinned(shares, "shares")
    share = F.pmod(F.xxhash64("row"), F.col("shares"))
    no_stack = F.lit(None).cast(starts.schema["stack"].dataType).alias("stack")
    swept = points.join(shares, "domain").select(
        "domain", share.alias("share"), "path", F.lit(1).alias("point"), "row", no_stack
    )
    opened = starts.join(shares, "domain").select(
        "domain",
        F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
        "path",
        F.lit(0).alias("point"),
        F.lit(None).cast("bigint").alias("row"),
        "stack",
    )
    sweep = Window.partitionBy("domain", "share").orderBy("path", "point")
    carried = F.last("stack", ignorenulls=True).over(sweep.rowsBetween(Window.unboundedPreceding, 0))
    at = swept.unionByName(opened).withColumn("open", carried).where("point = 1")
    covering = F.filter("open", lambda r: F.startswith(F.col("path"), r["path"]))
    hits = at.select("row", F.get(covering, F.lit(0)).alias("rule")).where("rule is not null")
    rank = F.struct(
        (F.length("rule.host") + F.col("rule.size")).alias("size"),
        F.length("rule.host").alias("labels"),
        F.col("rule.host").alias("host"),
        F.col("rule.path").alias("path"),
        F.col("rule.verdict").alias("verdict"),
    )
    best = hits.groupBy("row").agg(F.max(rank).alias("best"))
    return rows.join(best, "row", "left").select(
        F.col("row_id").alias(row_id),
        "host",
        "path",
        F.concat("best.host", "best.path").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
