"""What a prospective member would pay for in-copyright items, from its OCN list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.functions.rights import is_ic
from shelfcount.operators.counts import item_counts
from shelfcount.operators.overlap import member_counts, overlap

# --- Fixed values: the sentences of the estimate, and the columns that fill them
SENTENCES = (
    ("Total Estimated IC Cost: $%.2f", "estimated_ic_cost"),
    ("In all, we received %d distinct OCLC numbers.", "ocns_total"),
    ("Of those distinct OCLC numbers, %d (%.1f%%) match items in", "ocns_matched", "pct_ocns_matched"),
    ("{library}, corresponding to %d {library} items.", "items_matched"),
    ("Of those items, %d (%.1f%%) are in the public domain,", "items_pd", "pct_items_pd"),
    ("%d (%.1f%%) are in copyright.", "items_ic", "pct_items_ic"),
)
# ----------------------------------------------------------------------------


def estimate(ocns: DataFrame, items: DataFrame, cluster_ocns: DataFrame, holdings: DataFrame,
             organizations: DataFrame, target_cost: float) -> DataFrame:
    """One row of counts, percentages and cost.

    The member joins the holders of every matched in-copyright item, so its
    share of an item is 1 / (members + 1). Only matched clusters are looked at.
    """
    wanted = ocns.select("ocn").distinct()
    hits = cluster_ocns.join(wanted, "ocn", "left_semi").select("cluster_id").distinct()
    near = cluster_ocns.join(hits, "cluster_id", "left_semi")
    matched = items.join(hits, "cluster_id", "left_semi")
    counts = matched.select("item_id", F.coalesce(is_ic("rights"), F.lit(False)).alias("ic"))

    ic_rows = overlap(matched, near, holdings, narrowed=True).filter(is_ic("rights"))
    holders = member_counts(ic_rows, organizations)
    shares = counts.filter("ic").join(holders, "item_id", "left").agg(
        F.coalesce(F.sum(1.0 / (F.coalesce("n_members", F.lit(0)) + 1)), F.lit(0.0)).alias("h_share"))
    totals = counts.agg(F.count("*").alias("items_matched"), F.count_if("ic").alias("items_ic"),
                        F.count_if(~F.col("ic")).alias("items_pd"))
    listed = wanted.join(near.select("ocn").distinct().withColumn("hit", F.lit(1)), "ocn", "left").agg(
        F.count("*").alias("ocns_total"), F.count("hit").alias("ocns_matched"))
    # each side is a single row
    row = totals.crossJoin(shares).crossJoin(listed).crossJoin(item_counts(items).select("n_items"))

    def percent(part: str, whole: str):
        return F.round(F.try_divide(F.col(part), F.col(whole)) * 100, 1)

    return row.select(
        "ocns_total", "ocns_matched", percent("ocns_matched", "ocns_total").alias("pct_ocns_matched"),
        "items_matched",
        "items_pd", percent("items_pd", "items_matched").alias("pct_items_pd"),
        "items_ic", percent("items_ic", "items_matched").alias("pct_items_ic"),
        "h_share",
        F.round(F.try_divide(F.col("h_share") * target_cost, F.col("n_items")), 2)
        .alias("estimated_ic_cost"),
    )


def as_text(row: DataFrame, library: str) -> DataFrame:
    """The six lines handed to the prospective member."""
    return row.select(F.explode(F.array(*(
        F.format_string(text.replace("{library}", library.replace("%", "%%")), *columns) for text, *columns in SENTENCES
    ))).alias("value"))
