"""URL filter: rules indexed by their rarest literal token, verified by regular expression.

A rule is (host, path, action, tier); a rule of a lower tier decides before any of a higher one. ``host`` fits a url's host and its subdomains, empty fits any host.
``path`` is a prefix of the url's path, in which ``*`` stands for any characters. Its literal tokens
are the labels of its host and those segments of its path that stand between two slashes without a
``*``. The rule waits under the token that fewest urls hold. A url fetches the rules that wait under
its own tokens, and only those run their regular expression. Native columns throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPECIAL = r"([\\.\[\]{}()+?^$|#&~\-])"
ANY = ""  # the token of rules without a literal token; every url holds it once


def rules_table(spark: SparkSession, rules) -> DataFrame:
    """Rules given as (host, path, action, tier) as a table whose size Spark knows."""
    if not rules:
        return spark.range(0).select(*(F.lit("").alias(c) for c in ("host", "path", "action")), F.lit(0).alias("tier"))
    rows = [F.struct(*(F.lit(v).alias(n) for n, v in zip(("host", "path", "action", "tier"), rule))) for rule in rules]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(host: Column, inner_segments: Column) -> Column:
    """Distinct tokens: ``h:label`` of the host, ``p:segment`` of the path."""
    labels = F.transform(F.split(host, r"\.", -1), lambda x: F.concat(F.lit("h:"), x))
    segments = F.transform(inner_segments, lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.filter(F.concat(labels, segments), lambda x: F.length(x) > 2))


def _inner_segments(path: Column) -> Column:
    """Segments with a slash on both sides."""
    parts = F.split(path, "/", -1)
    return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0)))


def _rule_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Each distinct rule with its pattern and its rarest token over all urls (ties: the smallest token)."""
    literal = F.filter(_inner_segments(F.col("path")), lambda x: ~F.contains(x, F.lit("*")))
    pieces = F.transform(
        F.split(F.col("path"), r"\*", -1), lambda x: F.regexp_replace(x, SPECIAL, r"\\$1")
    )
    host = F.regexp_replace("host", SPECIAL, r"\\$1")
    pattern = F.concat(
        F.lit("(?s)^"), F.when(F.col("host") == "", F.lit("[^/]*")).otherwise(F.concat(F.lit(r"(?:[^/]*\.)?"), host)),
        F.when(F.col("path") == "", F.lit("(?:/|$)")).otherwise(F.array_join(pieces, ".*")),
    )
    rules = rules.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("host", "path", "action")), F.coalesce("tier", F.lit(0)).alias("tier")).distinct()
    rules = rules.select("host", "path", "action", "tier", pattern.alias("pattern"), _tokens(F.col("host"), literal).alias("tokens"))
    waiting = rules.select("host", "path", "action", "tier", "pattern", F.explode("tokens").alias("token"))
    # Only tokens of rules are counted; the counts combine before they are sent.
    wanted = waiting.select("token").distinct()
    seen = urls.select(F.explode("tokens").alias("token")).join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    best = (
        waiting.join(seen, "token", "left")
        .groupBy("host", "path", "action", "tier", "pattern")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rarest"))
        .select("host", "path", "action", "tier", "pattern", F.col("rarest.token").alias("token"))
    )
    free = rules.where(F.size("tokens") == 0).select("host", "path", "action", "tier", "pattern", F.lit(ANY).alias("token"))
    return best.unionByName(free)


def match_urls(urls: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """The rule that fits each url: ``key``, host, path, rule (host then path), action, tier, n_candidates.

    One row per input row, repeated rows included; other columns are not read. The lowest tier wins, in it
    the longest host and path together; of equally long rules one that blocks, then the greatest text. No rule, a null url
    or one without ``://``: rule and action null. ``n_candidates`` counts the rules whose expression ran.

    Two shuffles: the token counts, and one row per url and map task. A url's candidates never meet other
    urls, so a token that a third of all urls hold makes no large group.
    """
    parsed = urls.select(F.col(key).alias("_key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    parsed = parsed.withColumn("tokens", _tokens(F.col("host"), _inner_segments(F.col("path"))))
    index = _rule_index(rules, parsed).select(
        "token", "pattern", "action", "tier", F.concat("host", "path").alias("rule")
    )
    # Every url comes once with the token ANY, under which one row without a rule waits.
    none = index.sparkSession.range(1).select(
        F.lit(ANY).alias("token"), *(F.lit(None).cast(t).alias(c) for c, t in (("pattern", "string"), ("action", "string"), ("tier", "int"), ("rule", "string")))
    )
    asked = parsed.select("_key", "host", "path", F.explode(F.concat(F.array(F.lit(ANY)), "tokens")).alias("token"))
    met = asked.join(index.unionByName(none), "token")
    fits = F.col("rule").isNull() | F.expr("concat(host, path) rlike pattern")
    order = F.struct((-F.col("tier")).alias("first"), F.length("rule").alias("n"), (F.col("action") == "block").alias("blocks"), F.col("rule"), F.col("action"), F.col("tier"))
    one = met.groupBy("_key", "host", "path").agg(
        F.max(F.when(F.col("rule").isNotNull() & fits & (F.col("host") != ""), order)).alias("best"),
        F.count("rule").alias("n_candidates"),
        F.count(F.when(F.col("rule").isNull(), 1)).alias("copies"),
    )
    one = one.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return one.select(
        F.col("_key").alias(key), "host", "path", F.col("best.rule").alias("rule"), F.col("best.action").alias("action"), F.col("best.tier").alias("tier"),
        (F.col("n_candidates") / F.col("copies")).cast("bigint").alias("n_candidates"),
    )
