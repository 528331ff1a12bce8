"""URL rules as a sort-merge range join, with DataFrame functions only.

A rule (host, path) becomes the key of its reversed host and path. Below one host, the paths that start with a
rule's path are one interval of the sorted order, and such intervals are nested or apart. Each url is a point in
the order of every host that it lies under; a sorted sweep remembers the stack of rules that were open at the last
rule seen, and the innermost one that still covers the point fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import c

SLICE_ROWS = 20_000
#: Tables with a row per rule host are broadcast up to this many rows, and shuffled beyond.
BROADCAST_HOSTS = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a url; both empty where it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def _reversed(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Rules with ``rhost`` and ``stack``: the rule itself and the rules around it, innermost first.

    The rules around a rule have a path that is a prefix of its path, of a length that occurs at its host; they
    are found by an equality join on (host, prefix). Of rules with one host and path, block wins.
    """
    named = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("rhost", _reversed(F.split("host", "\\.")))
    )
    lengths = named.groupBy("rhost").agg(F.collect_set(F.length("path")).alias("lengths"))
    probes = (
        named.join(lengths, "rhost")
        .select("rhost", F.col("path").alias("inner"), F.explode("lengths").alias("n"))
        .where(F.col("n") <= F.length("inner"))
        .select("rhost", "inner", F.expr("substring(inner, 1, n)").alias("path"))
    )
    around = probes.join(named, ["rhost", "path"])
    entry = F.struct(F.length("path").alias("n"), "path", "host", "verdict")
    return around.groupBy("rhost", F.col("inner").alias("path")).agg(
        F.reverse(F.array_sort(F.collect_list(entry))).alias("stack")
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per row of ``pages``: the key, ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits its host and all hosts below it,
    where the path starts with the rule's path. The longest rule (host and path together, then host) wins; urls
    without one get ``default``. Null and malformed urls have an empty host and path. Repeated rows are judged
    once and returned as often as they occur; null keys are kept. A host with many urls is swept in slices of
    about ``slice_rows`` urls, each with a copy of that host's rules.
    """
    urls = pages.select(c(key).alias("key"), c(url).alias("url")).groupBy("key", "url").agg(F.count(F.lit(1)).alias("n"))
    host, path = host_and_path(F.col("url"))
    base = urls.select("key", "url", "n", host.alias("host"), path.alias("path"))
    stacks = rule_stacks(rules)
    # No rule has more labels than this, so longer hosts are probed by their last labels only.
    deepest = stacks.agg(F.max(F.size(F.split("rhost", "\\.")))).first()[0] or 0
    labels = F.reverse(F.split("host", "\\."))
    hosts = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(deepest, 1)))),
        lambda k: F.array_join(F.slice(labels, F.lit(1), k), "."),
    )
    probes = base.select("key", "url", "path", F.explode(hosts).alias("rhost"))
    ruled = stacks.select("rhost").distinct()
    small = F.broadcast if ruled.count() <= BROADCAST_HOSTS else lambda df: df
    crowded = (
        probes.join(small(ruled), "rhost", "left_semi")
        .groupBy("rhost")
        .agg(F.ceil(F.count(F.lit(1)) / slice_rows).cast("long").alias("slices"))
    )
    slice_of = F.pmod(F.xxhash64("key", "url"), F.col("slices"))
    points = probes.join(small(crowded), "rhost").select(
        "rhost", slice_of.alias("slice"), "path", F.lit(1).alias("kind"), "key", "url", F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack")
    )
    opened = (
        stacks.join(crowded, "rhost")
        .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
        .select("rhost", "slice", "path", F.lit(0).alias("kind"), F.lit(None).cast(points.schema["key"].dataType).alias("key"), F.lit(None).cast("string").alias("url"), "stack")
    )
    order = Window.partitionBy("rhost", "slice").orderBy("path", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = opened.unionByName(points).withColumn("open", F.last("stack", ignorenulls=True).over(order)).where("kind = 1")
    best = F.struct(
        (F.length("fit.host") + F.col("fit.n")).alias("n"),
        F.length("fit.host").alias("m"),
        F.concat("fit.host", "fit.path").alias("rule"),
        F.col("fit.verdict").alias("verdict"),
    )
    found = (
        swept.where(F.size("open") > 0)
        .withColumn("fit", F.try_element_at(F.filter("open", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(1)))
        .where(F.col("fit").isNotNull())
        .select("key", "url", F.lit(0).cast("long").alias("n"), best.alias("best"))
    )
    all_rows = base.select("key", "url", "n", F.lit(None).cast(found.schema["best"].dataType).alias("best"))
    judged = all_rows.unionByName(found).groupBy("key", "url").agg(F.max("n").alias("n"), F.max("best").alias("best"))
    return judged.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(
        F.col("key").alias(key),
        host.alias("host"),
        path.alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
