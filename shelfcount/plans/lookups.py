"""Lookups in batch: a table of requests in, a table of answers out.

Access and holder lookups use OCN clusters; record lookups use the record's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.operators.clusters import item_clusters
from shelfcount.operators.dimensions import mapped_organizations, resolve_mapto
from shelfcount.operators.overlap import overlap, overlap_of, prepare
from shelfcount.session import checked_broadcast, materialize

MISSING = "missing required param: "
UNKNOWN = "no matching data"


def check_requests(requests: DataFrame, items: DataFrame, organizations: DataFrame) -> DataFrame:
    """Requests (organization, item_id) with mapto and the error, if any."""
    known = items.select("item_id").distinct().withColumn("__hit", F.lit(True))
    joined = resolve_mapto(requests, organizations).join(known, "item_id", "left")

    def absent(name: str):
        return F.when(F.coalesce(F.col(name), F.lit("")) == "", f"{MISSING}{name}")

    missing = F.concat_ws("; ", absent("organization"), absent("item_id"))
    unknown = F.when(F.col("mapto").isNull() | F.col("__hit").isNull(), UNKNOWN)
    return joined.withColumn("error", F.when(missing != "", missing).otherwise(unknown)).drop("__hit")


def item_access(requests: DataFrame, overlap_rows: DataFrame, items: DataFrame,
                organizations: DataFrame, formats: DataFrame) -> DataFrame:
    """Can the organisation access the item? Counts are summed over all
    organisations with the same parent id. ``formats`` is (item_id, cluster_format)."""
    good = materialize(check_requests(requests, items, organizations).filter("error is null").drop("error"), "good")
    facts = items.select("item_id", F.col("billing_entity").alias("organization"), "n_enum",
                         F.sort_array("ocns").alias("ocns"))
    owners = resolve_mapto(facts, organizations).select(
        "item_id", "n_enum", "ocns", F.col("mapto").alias("owner"))
    parents = mapped_organizations(organizations).select(
        F.col("mapto_inst_id").alias("mapto"), F.col("inst_id").alias("organization"))
    wanted = overlap_rows.join(good.select("item_id"), "item_id", "left_semi")
    summed = (wanted.join(checked_broadcast(parents), "organization").groupBy("item_id", "mapto")
              .agg(F.sum("access_count").alias("brlm_count"), F.sum("copy_count").alias("copy_count"),
                   F.sum("current_holding_count").alias("currently_held_count")))
    return (good.join(owners, "item_id").join(formats, "item_id")
            .join(summed, ["item_id", "mapto"], "left")
            .select("item_id", "organization",
                    *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                      for c in ("brlm_count", "copy_count", "currently_held_count")],
                    F.when(F.col("owner") == F.col("mapto"), 1).otherwise(0).alias("deposited"),
                    F.col("cluster_format").alias("format"), "n_enum", "ocns"))


def _asked(requests: DataFrame) -> DataFrame:
    """(item_id) of the requests, each once; written, since clusters and answers are both made from it."""
    return materialize(requests.select("item_id").distinct(), "asked")


def item_held_by(requests: DataFrame, overlap_rows: DataFrame,
                 constraint: str | None = None) -> DataFrame:
    """(item_id, organizations); ``brlm`` keeps holders with access copies only.

    An item is held by at most all organisations, which bounds each list.
    """
    if constraint not in (None, "brlm"):
        raise ValueError("Invalid constraint.")
    asked = _asked(requests)
    rows = overlap_rows.join(asked, "item_id", "left_semi")
    held = F.lit(True) if constraint is None else F.col("access_count") > 0
    listed = rows.groupBy("item_id").agg(F.sort_array(
        F.collect_list(F.when(held, F.col("organization")))).alias("organizations"))
    empty = F.array().cast("array<string>")
    return (asked.join(listed, "item_id", "left")
            .select("item_id", F.coalesce("organizations", empty).alias("organizations")))


def record_held_by(records: DataFrame, items: DataFrame, cluster_ocns: DataFrame, holdings: DataFrame) -> DataFrame:
    """(item_id, organizations) for the items of the asked records (cluster_id) that anyone holds.

    Only items, OCNs and holdings of these records are read on.
    """
    asked = records.select("cluster_id").distinct()
    rows = overlap(items.join(asked, "cluster_id", "left_semi"), cluster_ocns.join(asked, "cluster_id", "left_semi"),
                   holdings, narrowed=True)
    return rows.groupBy("item_id").agg(
        F.sort_array(F.collect_list("organization")).alias("organizations"))


def lookup_model(requests: DataFrame, items: DataFrame, concordance: DataFrame,
                 holdings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Home items with formats, and overlap rows, of the OCN clusters of the requested items (item_id).

    The work follows the requests: clusters grow from their items, and only holdings on the OCNs of these
    clusters are counted.
    """
    placed, ocns = item_clusters(items.drop("cluster_id"), concordance, _asked(requests))
    parts = prepare(placed, ocns, holdings, narrowed=True)
    return parts.home, overlap_of(parts)
