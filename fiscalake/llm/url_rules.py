"""URL filters as a range join: prefixes become intervals of sorted keys, and a sweep over
the sorted keys keeps the stack of rules that are open.

A host is written label by label from the right (``net.example.www``), so that a rule's
host is an anchor that all its subdomains share. A URL is one point per anchor it has (its
host's own and each parent's): anchor, a separator, path. A rule is the interval of the
points that start with its anchor and path. Intervals of prefixes nest, so at any point
the open rules are among the stack of the last rule that starts at or before it: the sweep
carries that stack along the sorted points and keeps those entries the point starts with.

Only DataFrame functions are used. Points are distinct before they are sorted, so a host
or URL with any share of the rows is one of few points; no rule list is broadcast by hand.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, staged, table

SEPARATOR = "\u0000"  # sorts before all characters that labels and paths hold

# The rules of the registered query.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def url_part(url: Column, group: int) -> Column:
    """1: host, what follows the first ``://`` up to ``/``, ``?`` or ``#``; 2: path, what
    follows up to ``?`` or ``#``. Empty for null and for text without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def _lower(host: Column) -> Column:
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _stacks(rules: DataFrame) -> DataFrame:
    """One row per interval: its start and the rules open there, outermost first."""
    own = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("action").isin("allow", "block"))
        .withColumn("anchor", F.array_join(_labels(_lower(F.col("host"))), "."))
        .groupBy("anchor", "path")
        .agg(F.max("action").alias("action"), F.min(_lower(F.col("host"))).alias("host"))
    )
    entry = F.struct(
        F.length("path").alias("depth"),
        F.concat("anchor", F.lit(SEPARATOR), "path").alias("start"),
        F.concat("host", "path").alias("rule"),
        F.col("action"),
    )
    outer = own.select("anchor", F.col("path").alias("prefix"), entry.alias("entry"))
    prefixes = own.select(
        "anchor", "path", F.explode(F.expr("transform(sequence(0, length(path)), n -> substring(path, 1, n))")).alias("prefix")
    )
    return (
        prefixes.join(outer, ["anchor", "prefix"])
        .groupBy("anchor", "path")
        .agg(F.array_sort(F.collect_list("entry")).alias("stack"))
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Verdicts for all rows of ``pages`` (page_id, url) by ``rules`` (host, path, action).

    A rule fits its host and the host's subdomains where the URL's path starts with the
    rule's path, compared character by character. Of the rules that fit, the one with the
    longest host wins, then the one with the longest path. Returns page_id, host, path,
    rule (host and path of the winner, else null) and verdict (its action, else
    ``default``).

    A null URL or one without ``://`` has an empty host and path, which no rule fits. Rules
    with a null part or an unknown action are ignored; of equal rules, a block wins.
    Repeated pages each get their row; an empty table gives an empty result.
    """
    rows = pick(pages, "page_id", "url").select(
        "page_id", _lower(url_part(F.col("url"), 1)).alias("host"), url_part(F.col("url"), 2).alias("path")
    )
    stacks = _stacks(pick(rules, "host", "path", "action"))
    # No rule has a host of more labels, so the anchors of a very long host are few.
    deepest = F.coalesce(stacks.agg(F.max(F.size(F.split("anchor", r"\.")))).scalar(), F.lit(1))
    points = (
        rows.select("host", "path")
        .distinct()
        .where(F.col("host") != "")
        .withColumn("labels", F.slice(_labels(F.col("host")), 1, deepest))
        .select("host", "path", F.posexplode(F.expr("transform(sequence(1, size(labels)), n -> array_join(slice(labels, 1, n), '.'))")).alias("level", "anchor"))
        .join(stacks.select("anchor").distinct(), "anchor", "left_semi")
    )
    columns = [F.concat("anchor", F.lit(SEPARATOR), "path").alias("key"), "path"]
    starts = stacks.select(*columns, F.lit(0).alias("kind"), "stack", F.lit(None).cast("string").alias("host"), F.lit(0).alias("level"))
    events = starts.unionByName(
        points.select(*columns, F.lit(1).alias("kind"), F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"), "host", "level")
    )
    # The sweep: sorted ranges, the open stack carried along each and from one to the next.
    ranges = staged(
        events.repartitionByRange("key", "kind", "host").withColumn("part", F.spark_partition_id()), "url-sweep"
    )
    seen = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranges.groupBy("part")
        .agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("end"))
        .select("part", F.last("end", True).over(before).alias("carried"))
    )
    winner = F.try_element_at(F.filter(F.coalesce(F.last("stack", True).over(seen), "carried"), lambda s: F.startswith("key", s["start"])), F.lit(-1))
    best = (
        ranges.join(carried, "part")
        .select("kind", "host", "path", "level", winner.alias("winner"))
        .where((F.col("kind") == 1) & F.col("winner").isNotNull())
        .groupBy("host", "path")
        .agg(F.max(F.struct("level", "winner")).alias("best"))
    )
    return rows.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.winner.rule").alias("rule"),
        F.coalesce("best.winner.action", F.lit(default)).alias("verdict"),
    )


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    fixed = F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in zip(("host", "path", "action"), r))) for r in RULES))
    rules = spark.range(1).select(F.inline(fixed))
    return judge(table(spark, folder, "pages"), rules)


OP2_SQL = r"""
WITH parts AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
    FROM pages
), rules(rule_host, rule_path, action) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), urls AS (SELECT DISTINCT host, path FROM parts
), best AS (
    SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        arg_max(action, length(rule_host || rule_path)) AS action
    FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY host, path
)
SELECT page_id, parts.host, parts.path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN best USING (host, path)
"""
