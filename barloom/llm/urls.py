"""Allow and block rules over URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import lower_ascii, only


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules ``(verdict, host, path)`` as a table."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def split_url(url):
    """Host and path of a URL; both empty where it has no ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(text, shape, 1)), F.regexp_extract(text, shape, 2)


def _key(host):
    """The host's labels from the last to the first, each ended by a full stop.

    A host and all its subdomains are then the keys that begin with the host's key: the interval from
    the key itself up to the key whose last character is the next one, ``/``.
    """
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for each row.

    A rule fits its host and all subdomains of it where the path begins with the rule's path. The rule
    with the longest host and path wins, of equal ones a blocking rule, then the smaller text; where
    none fits, ``rule`` is null and the verdict ``default``.

    Every rule host is an interval of keys, and intervals are nested or apart. Rule starts and the
    distinct hosts of the pages are merged in key order, and one sweep carries along the stack of rules
    that enclose the last start; of it, those whose interval has not ended are the host's active rules.
    An interval never leaves its last label, so the sweep runs within (last label, salt): a last label
    with most hosts is spread over salts, each of which gets that label's rules. Pages meet their host's
    stack in a plain join that Spark can split for a host with very many pages.

    A null url, or one without ``://``, has an empty host and path and no rule. Rules without a host or
    path, with nulls, or with another verdict than allow or block raise no error and fit nothing. All
    rules of one host travel as one array. Repeated rows are judged one by one; other columns are ignored.
    """
    host, path = split_url(F.col("url"))
    pages = only(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    salts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    nodes = (only(rules, "verdict", "host", "path").where("verdict IN ('allow', 'block') AND host <> '' AND path <> ''")
             .withColumn("host", lower_ascii(F.col("host")))
             .select(_key(F.col("host")).alias("key"), F.struct(
                 (F.char_length("host") + F.char_length("path")).alias("size"), (F.col("verdict") == "block").alias("block"),
                 F.concat("host", "path").alias("rule"), "path", "verdict").alias("r"))
             .groupBy("key").agg(F.collect_set("r").alias("rules"))
             .withColumn("end", F.concat(F.expr("left(key, char_length(key) - 1)"), F.lit("/"))))
    labels = F.split(F.expr("left(key, char_length(key) - 1)"), r"\.", -1)
    prefixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))
    stacks = (nodes.select("key", F.explode(prefixes).alias("outer"))
              .join(nodes.select(F.col("key").alias("outer"), "end", "rules"), "outer")
              .groupBy("key").agg(F.collect_list(F.struct("end", "rules")).alias("stack")))

    first = F.substring_index("key", ".", 1)
    starts = stacks.select(first.alias("top"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
                           "key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"), "stack")
    hosts = pages.where("host <> ''").select("host").distinct().withColumn("key", _key(F.col("host")))
    points = hosts.select(first.alias("top"), F.pmod(F.xxhash64("host"), F.lit(salts)).cast("int").alias("salt"),
                          "key", F.lit(1).alias("kind"), "host")
    sweep = Window.partitionBy("top", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = (starts.unionByName(points, allowMissingColumns=True)
             .withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1"))
    active = swept.select("host", F.flatten(F.transform(
        F.filter("stack", lambda node: F.col("key") < node["end"]), lambda node: node["rules"])).alias("active"))

    judged = pages.join(active, "host", "left")
    best = F.array_max(F.transform(
        F.filter("active", lambda r: F.startswith(F.col("path"), r["path"])),
        lambda r: F.struct(r["size"].alias("size"), r["block"].alias("block"), r["rule"].alias("rule"),
                           r["verdict"].alias("verdict"))))
    return (judged.withColumn("best", best)
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
