"""Non-current holdings: items an organisation holds only brittle, lost or withdrawn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.functions.rights import is_ic
from shelfcount.operators.overlap import all_current_brittle, any_current_brittle, overlap

CONDITIONS = ("withdrawn", "lost_missing", "brittle", "multiple")


def non_current_items(items: DataFrame, cluster_ocns: DataFrame, holdings: DataFrame) -> DataFrame:
    """(item_id, rights, organization, condition); none where a sound copy is current."""
    rows = overlap(items, cluster_ocns, holdings).filter(all_current_brittle())
    found = F.array_compact(F.array(
        F.when(any_current_brittle(), "brittle"),
        F.when(F.col("lm_count") > 0, "lost_missing"),
        F.when(F.col("wd_count") > 0, "withdrawn"),
    ))
    return (rows.withColumn("found", found).filter(F.size("found") > 0)
            .select("item_id", "rights", "organization",
                    F.when(F.size("found") > 1, "multiple").otherwise(F.col("found")[0])
                    .alias("condition")))


def non_current_counts(conditions: DataFrame) -> DataFrame:
    """One row per organisation: items by rights (pd, ic) and condition."""
    ic = F.coalesce(is_ic("rights"), F.lit(False))
    return conditions.groupBy("organization").agg(*[
        F.count_if(side & (F.col("condition") == name)).alias(f"{prefix}_{name}")
        for prefix, side in (("pd", ~ic), ("ic", ic)) for name in CONDITIONS
    ])
