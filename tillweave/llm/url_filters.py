"""URL filters by temporal lists: an as-of join of captures with dated list entries.

A list is a table of dated entries (kind, pattern, action, day). An entry is in force from its day until the next entry
of the same kind and pattern, so entries become intervals by a window over each pattern; entries of one pattern and day
are reduced to one first (block before allow before remove), which bounds a pattern's window by the number of days. A
capture asks for the patterns its URL falls under, and gets those whose interval holds the day it was fetched:

- ``domain``: the host or any domain above it; ``host``: the host alone;
- ``prefix``: the host and the first segments of the path, for the numbers of segments that the list uses.

Of the entries in force the most specific decides: longer prefixes, then the host, then longer domains. A pattern that
was removed decides nothing. All of it is DataFrame functions; joins are on hashes of kind and pattern with a range of
days, and leave hot hosts to the skew handling of Spark's joins, whose list side is small for every key.

A null URL, one without a host, or a capture without a day meets no entry: host or action are null. Entries with a null
in any column are ignored. Repeated captures are judged alike, repeated entries count once. Only the named columns are
read; an empty list decides nothing, and no captures give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The parts of an absolute URL.
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"
RANK = {"remove": 0, "allow": 1, "block": 2}


def host_of(url: Column) -> Column:
    """The host of an absolute URL in lower case, else null."""
    return F.nullif(F.rtrim(F.regexp_extract(F.lower(url), HOST, 1), F.lit(".")), F.lit(""))


def segments_of(url: Column) -> Column:
    """The non-empty segments of a URL's path."""
    return F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda x: x != "")


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, pattern, action, since, until) of entries (kind, pattern, action, day); ``until`` is exclusive or null."""
    rank = F.coalesce(*(F.when(F.col("action") == name, n) for name, n in RANK.items()))
    daily = (
        entries.select("kind", "pattern", "day", rank.alias("rank"))
        .dropna()
        .groupBy("kind", "pattern", "day")
        .agg(F.max("rank").alias("rank"))
    )
    until = F.lead("day").over(Window.partitionBy("kind", "pattern").orderBy("day"))
    named = F.element_at(F.array(*(F.lit(name) for name in RANK)), F.col("rank") + 1)
    return daily.select("kind", "pattern", named.alias("action"), F.col("day").alias("since"), until.alias("until"))


def _asked(host: Column, segments: Column, depths: Column) -> Column:
    """The (kind, pattern, specificity) that a URL falls under."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    ask = lambda kind, pattern, rank: F.struct(
        F.lit(kind).alias("kind"), pattern.alias("pattern"), rank.cast("int").alias("specificity")
    )
    domains = F.transform(
        F.sequence(F.lit(1), n), lambda i: ask("domain", F.concat_ws(".", F.slice(labels, n - i + 1, i)), i)
    )
    fitting = F.filter(depths, lambda d: d <= F.size(segments))
    prefixes = F.transform(
        fitting,
        lambda d: ask("prefix", F.concat_ws("/", F.concat(F.array(host), F.slice(segments, 1, d))), d + F.lit(1000)),
    )
    return F.concat(domains, F.array(ask("host", host, F.lit(999))), prefixes)


def judge_urls(
    captures: DataFrame, entries: DataFrame, *, key: str = "page_id", url: str = "url", day: str = "day"
) -> DataFrame:
    """(key, host, day, action, kind, pattern, since) of every capture; action to since are null without an entry."""
    spans = intervals(entries)
    depth = F.when(F.col("kind") == "prefix", F.size(F.split("pattern", "/")) - 1)
    depths = spans.agg(F.array_sort(F.collect_set(depth))).scalar()  # a few numbers
    rows = captures.select(
        F.xxhash64(F.col(url), F.col(day)).alias("_row"),
        F.col(key).alias("_key"),
        host_of(F.col(url)).alias("_host"),
        F.col(day).alias("_day"),
        segments_of(F.col(url)).alias("_segments"),
    )
    # Equal URLs of a day are asked for once.
    asked = (
        rows.where(F.col("_host").isNotNull() & F.col("_day").isNotNull())
        .select("_row", "_host", "_day", "_segments")
        .dropDuplicates(["_row"])
        .withColumn("_depths", depths)
        .select("_row", "_day", F.explode(_asked(F.col("_host"), F.col("_segments"), F.col("_depths"))).alias("a"))
        .select("_row", "_day", "a.kind", "a.pattern", "a.specificity")
    )
    in_force = (F.col("_day") >= F.col("since")) & (F.col("until").isNull() | (F.col("_day") < F.col("until")))
    decided = (
        asked.join(spans, ["kind", "pattern"])
        .where(in_force & (F.col("action") != "remove"))
        .groupBy("_row")
        .agg(F.max_by(F.struct("action", "kind", "pattern", "since"), "specificity").alias("found"))
        .select("_row", "found.*")
    )
    return rows.drop("_segments").join(decided, "_row", "left").select(
        F.col("_key").alias(key), F.col("_host").alias("host"), F.col("_day").alias(day), "action", "kind", "pattern", "since"
    )
