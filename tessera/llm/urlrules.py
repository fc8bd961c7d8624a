"""Allow and block rules on URLs by a sort-merge range join.

A rule's host, its labels reversed, is a prefix of the reversed hosts it fits:
an interval of the sorted keys.  A sorted sweep over keys and rule starts gives
every key the last rule that starts before it; that rule's stack of enclosing
rules holds every rule that can fit the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, partitions, stored

# (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DEFAULT_VERDICT = "allow"
SEPARATOR = "\x01"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?:(?!://).)*+://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?:(?!://).)*+://[^/?#]*+(/[^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels last first, each followed by a dot: a prefix for each parent domain."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules) -> DataFrame:
    return spark.createDataFrame([(h, p, v) for h, p, v in rules], "rule_host string, rule_path string, verdict string")


def _stacks(spark: SparkSession, rules: DataFrame) -> DataFrame:
    """``(key, stack)``: for each rule start its enclosing rules, itself last.
    Rules are prefixes, so the enclosing ones are found by equality with the
    rule's own shorter prefixes at label ends."""
    keyed = rules.select(F.concat("rule_path", F.lit(SEPARATOR), host_key(ascii_lower(F.col("rule_host")))).alias("key"),
                         F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict").alias("rule"))
    # Two rules of one host and path: the first by verdict ("allow" before "block").
    keyed = keyed.groupBy("key").agg(F.min("rule").alias("rule"))
    ends = F.sequence(F.lit(1), F.length("key"))
    up = keyed.select("key", F.explode(F.filter(ends, lambda i: F.substr(F.col("key"), i, F.lit(1)) == ".")).alias("n"))
    up = up.select("key", F.substr(F.col("key"), F.lit(1), F.col("n")).alias("outer"))
    return (up.join(keyed.select(F.col("key").alias("outer"), "rule"), "outer")
            .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("outer", "rule"))).alias("stack")))


def sweep(spark: SparkSession, points: DataFrame, stacks: DataFrame) -> DataFrame:
    """``points(key)``, distinct, -> ``(key, stack)`` of the last rule start at or
    before the key (null where there is none)."""
    n = partitions(spark)
    events = (points.select("key", F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"))
              .unionByName(stacks.select("key", "stack"))
              .repartitionByRange(n, "key").withColumn("part", F.spark_partition_id()))
    events = stored(spark, events, "url_events")     # the partition of a key stays what it is
    # What is open where a partition starts: the last start of all partitions before it.
    last = events.filter("stack is not null").groupBy("part").agg(F.max_by("stack", "key").alias("last"))
    parts = spark.range(n).select(F.col("id").cast("int").alias("part")).join(last, "part", "left")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    carried = parts.select("part", F.last("last", ignorenulls=True).over(before).alias("carried"))
    inside = (Window.partitionBy("part").orderBy("key", F.col("stack").isNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = events.withColumn("open", F.last("stack", ignorenulls=True).over(inside)).filter("stack is null")
    return swept.join(carried, "part", "left").select("key", F.coalesce("open", "carried").alias("stack"))


def judge_urls(spark: SparkSession, pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row.

    ``rules(rule_host, rule_path, verdict)``: a rule fits its host and all
    subdomains if the path starts with the rule's; the rule of the longest host
    and path together wins, then the longest path.  A null or scheme-less url has
    an empty host and path, which no rule with a path fits.  No rule: ``default``.
    Repeated rows each give a row, an empty table none; other columns are ignored.

    A url is a point once for each length that rule paths have (its path's prefix,
    then its reversed host).  Points are made distinct before the sweep, so a hot
    host is one point for each of its path prefixes.
    """
    urls = pages.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    lengths = F.broadcast(rules.select(F.length("rule_path").alias("n")).distinct())   # at most one row per path length
    per_url = (urls.select("host", "path").distinct().join(lengths, F.length("path") >= F.col("n"))
               .select("host", "path", F.concat(F.substr(F.col("path"), F.lit(1), F.col("n")), F.lit(SEPARATOR),
                                                host_key(F.col("host"))).alias("key")))
    swept = sweep(spark, per_url.select("key").distinct(), _stacks(spark, rules))
    fits = F.filter("stack", lambda s: F.startswith(F.col("key"), s["outer"]))
    inner = swept.select("key", F.try_element_at(fits, F.lit(-1)).alias("hit")).filter("hit is not null")
    best = (per_url.join(inner, "key")
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("hit.rule.rule").alias("n"), F.instr("hit.outer", SEPARATOR).alias("path_n"),
                                F.col("hit.rule").alias("rule"))).alias("best"))
            .select("host", "path", F.col("best.rule.rule").alias("rule"), F.col("best.rule.verdict").alias("verdict")))
    return (urls.join(best, ["host", "path"], "left")
            .select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))
