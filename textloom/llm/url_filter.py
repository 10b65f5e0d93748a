"""URL filtering against host and path rules.

Each URL is expanded into expressions: every host suffix of as many labels as
some rule has, joined with every path prefix of a length that some rule has, so
a long URL makes no more of them than a short one. Expressions and rules meet in an
equi-join on the first 32 bits of their SHA-256; the full digest then confirms
a hit, and of the confirmed rules the longest wins. The rules may be many:
they are sent to all tasks only if there are at most ``broadcast_rules`` of
them; beyond that both sides are shuffled on the hash prefix, with the URLs'
side dealt over ``salts`` so that a host with a third of all URLs is spread.

Everything is DataFrame operations. Rows are first counted by (keys, url), so
the expansion and the choice of a rule need a single shuffle of the URLs.

Defined results: a null URL or one without ``://`` has empty host and path; a
host is compared after lower-casing A-Z and otherwise as written, port
included, and the same for hosts and paths of any length; rows with a null key
are judged too; repeated rows are returned as often as they come in; an empty table
gives an empty result; columns other than the keys and the URL are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.words import lower_ascii

#: Hex digits of a digest that the join compares.
SHORT = 8


def with_host_path(df: DataFrame, url: str) -> DataFrame:
    """Adds ``host`` and ``path``."""
    at = F.instr(F.coalesce(F.col(url), F.lit("")), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))
    df = df.withColumn("_rest", rest)
    host = lower_ascii(F.regexp_extract("_rest", r"^[^/?#]*", 0))
    path = F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)
    return df.withColumns({"host": host, "path": path}).drop("_rest")


def host_suffixes(host: Column, labels: list[int]) -> Column:
    """The last labels of a host, as many as in ``labels``; as long as it has so many."""
    has = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    each = [F.when(has >= n, F.substring_index(host, ".", -n)) for n in labels]
    return F.array_compact(F.array(*each)) if each else F.array().cast("array<string>")


def judge_urls(pages: DataFrame, rules: DataFrame, keys: list[str], url: str = "url", default: str = "allow", broadcast_rules: int = 200_000, salts: int = 64) -> DataFrame:
    """One row for each row of ``pages``: keys, host, path, rule, verdict.

    ``rules`` has columns host, path and action ('allow' or 'block'). A rule
    fits its host and all subdomains of it if the URL's path starts with the
    rule's. The longest rule (host and path together) wins, then the one with
    the longer host; if one rule is listed with both actions, block wins.
    """
    rules = rules.select(lower_ascii(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "action")
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"))
    rules = rules.withColumn("rule", F.concat("rule_host", "rule_path")).withColumn("digest", F.sha2("rule", 256))
    rules = rules.select(F.substring("digest", 1, SHORT).alias("short"), F.col("digest").alias("rule_digest"), "rule", F.length("rule_host").alias("host_length"), F.size(F.split("rule_host", r"\.")).alias("labels"), "action").where(F.col("digest").isNotNull())
    # Distinct lengths of rule paths: as many as the longest rule path has characters, at most.
    sizes = sorted(r[0] for r in rules.select((F.length("rule") - F.col("host_length")).alias("n")).distinct().collect())

    urls = with_host_path(pages.groupBy(*keys, url).agg(F.count("*").alias("_copies")), url)
    prefixes = F.array(*[F.when(F.length("path") >= n, F.left("path", F.lit(n))) for n in sizes]) if sizes else F.array().cast("array<string>")
    labels = sorted(r[0] for r in rules.select("labels").distinct().collect())  # as many as the longest rule host has labels, at most
    hosts = host_suffixes(F.col("host"), labels)
    expressions = F.flatten(F.transform(hosts, lambda h: F.transform(F.filter(prefixes, lambda p: p.isNotNull()), lambda p: F.sha2(F.concat(h, p), 256))))
    asked = urls.withColumn("digest", F.explode_outer(expressions)).withColumn("short", F.substring("digest", 1, SHORT))
    if rules.limit(broadcast_rules + 1).count() <= broadcast_rules:
        met = asked.join(F.broadcast(rules), "short", "left")
    else:
        asked = asked.withColumn("_salt", F.pmod(F.xxhash64(url, *keys), F.lit(salts)).cast("int"))
        dealt = rules.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = asked.join(dealt, ["short", "_salt"], "left")
    fits = F.col("digest") == F.col("rule_digest")
    best = F.max(F.when(fits, F.struct(F.length("rule").alias("n"), "host_length", "action", "rule"))).alias("best")
    # Grouped by what the rows are dealt by already.
    judged = met.groupBy(*keys, url, "host", "path", "_copies").agg(best)
    judged = judged.withColumn("_copy", F.explode(F.expr("sequence(1, _copies)")))
    return judged.select(*keys, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
