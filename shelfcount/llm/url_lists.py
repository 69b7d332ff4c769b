"""URL filters: an as-of join of captures with list entries that were active when they were fetched.

Lists are kept as dated changes: an entry is added to a list or removed from it on a day. The changes of an
entry become validity intervals that do not overlap, each up to the next change. A capture is held against
its host, every parent domain of it, and every leading part of its path; it counts as listed where the last
change by its fetch time added the entry.

Both sides meet by an equi-join on the entry and the month. An interval is dealt out to the months that it
touches, so a capture meets only what changed in its month, however long the history of an entry is; a host
with a third of all captures is split by the planner like any skewed side of a join, and has a salt besides.
The counts that come out are aggregated by partial sums. No cross join, no window over a host.

Captures without URL or fetch time are listed nowhere. Changes without entry, list or day are left out; of
several changes of an entry on one day, a removal counts. Repeated captures give equal rows.

Empty captures give no rows; without changes nothing is listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT = 8


def host(url: Column) -> Column:
    """Lower-case host without port and user."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def names(url: Column) -> Column:
    """Entries that could list the URL: its host, the domains above it, and host and every leading part of its path."""
    labels = F.split(host(url), r"\.")
    parts = F.filter(F.split(path(url), "/"), lambda p: p != "")
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), lambda i: i <= F.size(parts)),
                           lambda i: F.concat(host(url), F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")))
    return F.when(host(url) != "", F.array_distinct(F.concat(domains, prefixes)))


def intervals(changes: DataFrame) -> DataFrame:
    """(list, entry, since, until) of (list, entry, day, added): active on since <= day < until; open ends are null."""
    per_day = (changes.filter("list IS NOT NULL AND entry IS NOT NULL AND day IS NOT NULL")
               .groupBy("list", "entry", "day").agg(F.min(F.coalesce("added", F.lit(False))).alias("added")))
    order = Window.partitionBy("list", "entry").orderBy("day")
    return (per_day.withColumn("until", F.lead("day").over(order)).filter("added")
            .select("list", "entry", F.col("day").alias("since"), "until"))


def listed(captures: DataFrame, changes: DataFrame, horizon: Column | None = None) -> DataFrame:
    """(url, fetched, list, entry, since) of every different capture and entry active at its fetch time.

    ``horizon`` is the last day that matters for open intervals; by default the last fetch.
    """
    if horizon is None:
        horizon = F.lit(captures.agg(F.max("fetched")).first()[0])
    valid = (intervals(changes).filter(F.col("since") <= horizon)
             .withColumn("last", F.least(F.coalesce(F.date_sub("until", 1), horizon), horizon))
             .withColumn("month", F.explode(F.sequence(F.trunc("since", "month"), F.trunc("last", "month"),
                                                       F.expr("INTERVAL 1 MONTH"))))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))))
    asked = captures.select("url", "fetched").distinct().select(
        "url", "fetched", F.trunc("fetched", "month").alias("month"),
        F.pmod(F.xxhash64("url"), F.lit(SALT)).cast("int").alias("salt"), F.explode(names(F.col("url"))).alias("entry"))
    return (asked.join(valid, ["entry", "month", "salt"])
            .filter((F.col("since") <= F.col("fetched"))
                    & (F.isnull("until") | (F.col("fetched") < F.col("until"))))
            .select("url", "fetched", "list", "entry", "since"))


def evaluate(captures: DataFrame, changes: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, url, fetched, n_entries, lists), one row for each row of captures; lists are comma-joined by name."""
    hits = (listed(captures, changes).groupBy("url", "fetched")
            .agg(F.count("*").alias("n_entries"),
                 F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists")))
    return captures.select(key, "url", "fetched").join(hits, ["url", "fetched"], "left").select(
        key, "url", "fetched", F.coalesce("n_entries", F.lit(0).cast("long")).alias("n_entries"),
        F.coalesce("lists", F.lit("")).alias("lists"))
