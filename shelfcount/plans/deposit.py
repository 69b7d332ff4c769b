"""Deposit holdings analysis: does the depositor still hold what it deposited?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcount.functions.rights import is_ic_or_icus
from shelfcount.operators.overlap import overlap
from shelfcount.session import checked_broadcast


def status_of(held: str, current: str, lost: str, withdrawn: str) -> Column:
    return (F.when(F.coalesce(held, F.lit(0)) == 0, "not_held")
            .when(F.col(current) > 0, "held")
            .when(F.col(lost) > 0, "lost_missing")
            .when(F.col(withdrawn) > 0, "withdrawn")
            .otherwise("unknown"))


def deposit_analysis(items: DataFrame, cluster_ocns: DataFrame, holdings: DataFrame,
                     organizations: DataFrame) -> DataFrame:
    """Per in-copyright or icus item: status for its depositor, and for all organisations
    with the same parent id. Items of a record without OCN are ``no_ocn``."""
    rows = overlap(items, cluster_ocns, holdings).filter(is_ic_or_icus("rights"))
    parents = organizations.select(F.col("inst_id").alias("organization"),
                                   F.col("mapto_inst_id").alias("parent"))
    wanted = items.filter(is_ic_or_icus("rights") & F.col("billing_entity").isNotNull()).select(
        "item_id", "rights", "billing_entity", (F.size("ocns") == 0).alias("no_ocn"))
    owners = parents.select(F.col("organization").alias("billing_entity"),
                            F.col("parent").alias("mapto_inst_id"))
    wanted = wanted.join(checked_broadcast(owners), "billing_entity", "left")

    related = (rows.join(checked_broadcast(parents), "organization").join(wanted, "item_id")
               .filter(F.col("parent") == F.col("mapto_inst_id")))
    own = F.col("organization") == F.col("billing_entity")
    counters = {"held": "matching_count", "cur": "current_holding_count",
                "lm": "lm_count", "wd": "wd_count"}
    summed = related.groupBy("item_id").agg(
        *[F.sum(c).alias(f"mapped_{n}") for n, c in counters.items()],
        *[F.sum(F.when(own, F.col(c)).otherwise(0)).alias(f"own_{n}") for n, c in counters.items()])
    joined = wanted.join(summed, "item_id", "left")

    def status(side: str) -> Column:
        held = status_of(*(f"{side}_{n}" for n in counters))
        return F.when(F.col("no_ocn"), "no_ocn").otherwise(held)

    return joined.select("item_id", "rights", "billing_entity",
                         status("own").alias("holdings_status"), "mapto_inst_id",
                         status("mapped").alias("mapped_holdings_status"))
