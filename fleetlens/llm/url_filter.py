"""URL rules and a list of blocked URLs.

Listed URLs are compared in a canonical form. A blocked Bloom filter of the
list lets through what may be listed; an exact hash join then removes its
false positives, so the verdict does not depend on the filter's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .shared import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a leading ``www.`` and default port, path without
    ``.html`` or slashes at its end; scheme, query and fragment are dropped.
    Null for a url without ``://``."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"(\.html?)?/*$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls when none does.
    A rule ``host/path`` fits its host, all subdomains and every path that
    starts with its path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        top, slash, rest = text.partition("/")
        fits = ((host == top) | host.endswith("." + top)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", listed_col: str = "url", most_bits: int = bloom.MOST_BITS) -> DataFrame:
    """pages, listed URLs -> (page_id, host, path, rule, verdict, listed).

    ``verdict`` is the longest fitting rule's, else ``block`` for a URL whose
    canonical form is listed and ``allow`` for all others. ``listed`` says
    whether it is, whatever the rules say. Null URLs and URLs without ``://``
    have an empty host and path, fit no rule and are never listed. Repeated
    rows are judged each; an empty table gives no rows; an empty list blocks
    nothing. Other columns are ignored.
    """
    spark = pages.sparkSession
    names = stored(listed.select(canonical(F.col(listed_col)).alias("name")).where("name is not null").distinct(), "listed")
    held = spark.sparkContext.broadcast(bloom.build(names.select(F.xxhash64("name")), names.count(), most_bits))

    @F.pandas_udf("boolean")
    def maybe(key):
        import pandas as pd

        return pd.Series(bloom.might_hold(held.value, key.to_numpy("int64")))

    url = F.col("url")
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"))
    rows = rows.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("name"))
    rows = rows.withColumn("maybe", maybe(F.xxhash64("name")) & F.col("name").isNotNull())
    rows = stored(rows, "urls")
    hits = rows.where("maybe").join(names.withColumn("listed", F.lit(True)), "name", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    rows = hits.select("page_id", "host", "path", "listed").unionByName(rows.where("not maybe").select("page_id", "host", "path", F.lit(False).alias("listed")))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")
