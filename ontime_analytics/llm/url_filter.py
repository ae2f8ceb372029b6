"""URL allow and block lists by host-suffix / path-prefix expressions (DataFrame functions only).

Each URL is expanded into expressions: a suffix of its host at a label
boundary and a prefix of its path.  Only the shapes (labels in the host,
characters in the path) that occur among the rules are expanded, so a URL
gives at most one expression for each shape, however long it is.  Expressions
meet the rules in an equi-join on the first ``prefix_chars`` hex digits of
their SHA-256; the full digest then confirms, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_analytics.llm.common import ascii_lower

MAX_HOST, MAX_PATH = 253, 2048


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def rule_table(rules: DataFrame, prefix_chars: int = 8) -> DataFrame:
    """``host``, ``path``, ``verdict`` rows with digests; of equal rules ``block`` wins over ``allow``.

    A host of over 253 or a path of over 2048 characters, an empty host, a path
    not starting with ``/`` or an unknown verdict fails the job."""
    bad = (F.length("host") < 1) | (F.length("host") > MAX_HOST) | (F.length("path") > MAX_PATH) \
        | ~F.col("path").startswith("/") | ~F.col("verdict").isin("allow", "block")
    one = rules.select(ascii_lower(F.col("host").cast("string")).alias("host"), F.col("path").cast("string").alias("path"),
                       F.col("verdict").cast("string").alias("verdict"))
    checked = one.filter(F.when(F.coalesce(bad, F.lit(True)), F.raise_error(
        F.concat_ws(" ", F.lit("bad url rule:"), "host", "path", "verdict"))).otherwise(F.lit(True)).cast("boolean"))
    return checked.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        F.concat("host", "path").alias("rule"), "verdict",
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_chars"), F.length("host").alias("host_chars"),
        F.sha2(F.concat("host", "path"), 256).alias("digest"),
    ).withColumn("prefix", F.substring("digest", 1, prefix_chars))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", broadcast_bytes: int = 8 << 20, salts: int = 16,
               prefix_chars: int = 8) -> DataFrame:
    """One row per row of ``pages``: ``<id_col>, host, path, rule, verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``allow`` / ``block``); a
    rule fits its host and all subdomains if the URL's path starts with the
    rule's.  The longest rule string wins; of two as long, the one with the
    longer host.  Without a fitting rule, ``rule`` is null and the verdict is
    ``default``.  A null URL or one without ``://`` has empty host and path;
    null and repeated ids keep their rows; other columns are ignored; an empty
    table gives no rows.

    The rule table is measured first: up to ``broadcast_bytes`` it is broadcast,
    beyond that it is replicated ``salts`` times, so that an expression common
    to most URLs (a top-level domain) is dealt to as many tasks.
    """
    table = rule_table(rules, prefix_chars)
    shapes = [(r.labels, r.path_chars) for r in table.select("labels", "path_chars").distinct().collect()]  # at most 127 x 2048
    width = table.agg(F.sum(F.length("rule") + 2 * 64 + 100)).first()[0] or 0

    url = F.col(url_col).cast("string")
    parts = pages.select(F.col(id_col).alias("id"), F.coalesce(url_host(url), F.lit("")).alias("host"),
                         F.coalesce(url_path(url), F.lit("")).alias("path")) \
        .withColumn("row", F.monotonically_increasing_id())
    labels = F.size(F.split("host", r"\."))
    expressions = [F.when((F.length("host") > 0) & (labels >= n) & (F.length("path") >= k),
                          F.sha2(F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, k)), 256)) for n, k in shapes]
    found = parts.withColumn("digest", F.explode_outer(F.array_compact(F.array(*expressions)) if expressions
                                                       else F.array().cast("array<string>")))
    found = found.withColumn("prefix", F.substring("digest", 1, prefix_chars))
    listed = table.select("prefix", F.struct(F.length("rule").alias("chars"), "host_chars", "rule", "verdict").alias("hit"),
                          F.col("digest").alias("full"))
    if width <= broadcast_bytes:
        met = found.join(F.broadcast(listed), "prefix", "left")
    else:
        met = found.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts))).join(
            listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>"))),
            ["prefix", "salt"], "left")
    best = met.groupBy("row").agg(F.first("id").alias(id_col), F.first("host").alias("host"), F.first("path").alias("path"),
                                  F.max(F.when(F.col("digest") == F.col("full"), F.col("hit"))).alias("hit"))
    return best.select(id_col, "host", "path", F.col("hit.rule").alias("rule"),
                       F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
