"""The frequency table kept up to date after a load, from what changed.

A load replaces a few slices. OCNs whose counts differ before and after name the record clusters that they are on;
only the items of these clusters are worked out, once with the holdings of before and once with those of after, and
the difference is added to the table. All other items keep their place in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.functions.rights import is_ic
from shelfcount.operators.frequency import frequencies, merge
from shelfcount.operators.overlap import COUNTERS, count_by_enum, overlap
from shelfcount.session import materialize


def changed_ocns(gone: DataFrame, come: DataFrame) -> DataFrame:
    """(ocn) whose counts by organisation and enumeration are not the same in both: rows of the replaced slices before
    and after. A holding that came again as it was changes nothing."""
    keys = ("ocn", "organization", "n_enum")
    signed = count_by_enum(come).unionByName(count_by_enum(gone).select(
        *keys, *[(-F.col(c)).alias(c) for c in COUNTERS]))
    differs = F.exists(F.array(*COUNTERS), lambda c: c != 0)
    return (signed.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTERS]).filter(differs)
            .select("ocn").distinct())


def touched_clusters(changed: DataFrame, cluster_ocns: DataFrame) -> DataFrame:
    """(cluster_id) of the clusters with one of the OCNs."""
    return cluster_ocns.join(changed.select("ocn"), "ocn", "left_semi").select("cluster_id").distinct()


def frequency_change(items: DataFrame, cluster_ocns: DataFrame, before: DataFrame, after: DataFrame, changed: DataFrame,
                     organizations: DataFrame) -> DataFrame:
    """What to add to the table of in-copyright items, with negative frequencies where items leave a bucket.

    ``before`` and ``after`` are all holdings; only those on OCNs of the touched clusters are counted.
    """
    touched = materialize(touched_clusters(changed, cluster_ocns), "touched")
    own_items = items.join(touched, "cluster_id", "left_semi")
    own_ocns = materialize(cluster_ocns.join(touched, "cluster_id", "left_semi"), "touched_ocns")

    def table(holdings: DataFrame) -> DataFrame:
        rows = overlap(own_items, own_ocns, holdings, narrowed=True)
        return frequencies(rows.filter(is_ic("rights")), organizations)

    return updated(table(after), table(before).withColumn("frequency", -F.col("frequency")))


def updated(table: DataFrame, change: DataFrame) -> DataFrame:
    """The table with a change added; a place that nothing is left in goes."""
    return merge(table, change).filter("frequency != 0")
