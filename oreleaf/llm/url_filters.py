"""URL filters by a temporal join with dated lists.

A list is a log of dated entries: a pattern (a domain, or a host with the first part of a
path) is added to or removed from a block or allow list. Entries become validity intervals, each
cut at the borders of periods of `PERIOD` days. A capture asks for all patterns its URL could match,
in the period of its fetch, so the join is by equality of pattern and period and meets, of a pattern with many entries,
only those of that time; a host that a third of all captures come from is spread over its periods, and what
is left of its skew is for Spark's split of skewed join partitions. Captures of the same URL and day ask once.

Of the entries active at the time of the fetch the one with the longest pattern decides, allow before block.

Defined results: an interval holds from the day of its entry to the day before the next change; on one day,
adding comes after removing, and repeated entries are one; captures without URL or day match nothing;
entries without pattern or day do not count; repeated captures keep their rows; empty tables: nothing is blocked, or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreleaf.llm.common import staged

PERIOD = 32


def host(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def first_part(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, since, until): from `entries` with list, pattern, action (add or remove) and day (number); until is null while it holds."""
    last_of_day = entries.where("pattern is not null and day is not null").groupBy("list", "pattern", "day").agg(F.max((F.col("action") == "add").cast("int")).alias("_on"))
    order = Window.partitionBy("list", "pattern").orderBy("day")
    changes = last_of_day.withColumn("_was", F.lag("_on", 1, 0).over(order)).where("_on <> _was")
    return changes.withColumn("until", F.lead("day").over(order)).where("_on = 1").select("list", "pattern", F.col("day").alias("since"), "until")


def asked(captures: DataFrame, url_col: str) -> DataFrame:
    """(url, day, pattern): every pattern that could match a capture: its host, the domains above it up to the last label, host and first path part."""
    domains = F.expr("transform(sequence(1, size(_labels)), i -> array_join(slice(_labels, i, size(_labels)), '.'))")
    return (
        captures.select(F.col(url_col).alias("_url"), F.col("day").alias("_day")).where("_url is not null and _day is not null").distinct()
        .withColumn("_labels", F.split(host("_url"), r"\."))
        .select("_url", "_day", F.explode(F.array_union(
            domains,
            F.when(first_part("_url") != "", F.array(F.concat(host("_url"), F.lit("/"), first_part("_url")))).otherwise(F.array().cast("array<string>")),
        )).alias("_pattern"))
    )


def judge(captures: DataFrame, entries: DataFrame, url_col: str = "url") -> DataFrame:
    """All columns of `captures` (which has `url_col` and day) and pattern, list, since (null: no active entry), blocked."""
    names = {"pattern", "list", "since", "blocked"}
    wanted = asked(captures, url_col).withColumn("_period", F.expr(f"_day div {PERIOD}"))
    span = staged(wanted.agg(F.max("_period").alias("_latest")), "latest")
    latest = span.first()["_latest"]
    valid = (
        intervals(entries).withColumn("_open", F.coalesce(F.expr(f"(until - 1) div {PERIOD}"), F.lit(latest).cast("long")))
        .where(f"since div {PERIOD} <= _open")
        .select("list", "pattern", "since", "until", F.explode(F.expr(f"sequence(since div {PERIOD}, _open)")).alias("_in"))
    )
    active = wanted.join(valid, (F.col("_pattern") == F.col("pattern")) & (F.col("_period") == F.col("_in")) & (F.col("_day") >= F.col("since")) & (F.col("until").isNull() | (F.col("_day") < F.col("until"))))
    best = active.groupBy("_url", "_day").agg(F.max(F.struct(
        F.length("pattern").alias("n"), (F.col("list") == "allow").alias("allow"), F.col("pattern").alias("pattern"), F.col("list").alias("list"), F.col("since").alias("since"),
    )).alias("_best"))
    kept = [F.col(f"`{c}`") for c in captures.columns if c not in names]
    return captures.join(best, (F.col(url_col) == F.col("_url")) & (F.col("day") == F.col("_day")), "left").select(
        *kept, "_best.pattern", "_best.list", "_best.since", F.coalesce(F.col("_best.list") == "block", F.lit(False)).alias("blocked"),
    )
