"""What each member pays.

Everybody shares the cost of public-domain items by weight; holders share the
cost of each in-copyright item equally; what falls to the central organisation
is spread over the members.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.functions.rights import is_ic
from shelfcount.operators.counts import item_counts
from shelfcount.operators.dimensions import members
from shelfcount.operators.frequency import frequencies, hscores
from shelfcount.operators.overlap import overlap


@dataclass(frozen=True)
class CostReport:
    summary: DataFrame
    by_member: DataFrame
    frequency: DataFrame


def ic_frequencies(items: DataFrame, cluster_ocns: DataFrame, holdings: DataFrame,
                   organizations: DataFrame) -> DataFrame:
    """Frequency table over the in-copyright items."""
    rows = overlap(items, cluster_ocns, holdings).filter(is_ic("rights"))
    return frequencies(rows, organizations)


def summary(counts: DataFrame, organizations: DataFrame, target_cost: float) -> DataFrame:
    """One row of report facts from the item counts (n_items, n_pd)."""
    active = members(organizations).agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("total_weight"),
                                        F.count("*").alias("n_members"))
    per_volume = F.try_divide(F.lit(float(target_cost)), F.col("n_items"))
    return counts.crossJoin(active).select(
        F.lit(float(target_cost)).alias("target_cost"),
        F.col("n_items").alias("num_volumes"),
        F.col("n_pd").alias("num_pd_volumes"),
        per_volume.alias("cost_per_volume"),
        "total_weight",
        (per_volume * F.col("n_pd")).alias("pd_cost"),
        F.col("n_members").alias("num_members"),
    )


def by_member(table: DataFrame, facts: DataFrame, organizations: DataFrame, central: str,
              organization: str | None = None) -> DataFrame:
    """One row per member: format costs, public-domain share, weight, extra, total.

    ``extra`` is added to every row, also to the central organisation's own.
    """
    scores = hscores(table)
    spread = (members(organizations).agg(F.count_if(F.col("inst_id") != central).alias("payers"))
              .crossJoin(scores.filter(F.col("organization") == central)
                         .agg(F.coalesce(F.sum("total"), F.lit(0.0)).alias("central_total"))))
    # facts and spread are single rows
    constants = facts.crossJoin(spread).select(
        "cost_per_volume", "pd_cost", "total_weight",
        F.try_divide(F.col("central_total") * F.col("cost_per_volume"),
                     F.col("payers")).alias("extra"))
    rows = (members(organizations).select(F.col("inst_id").alias("organization"), "weight")
            .join(scores, "organization", "left").na.fill(0.0, ["spm", "mpm", "ser", "total"])
            .crossJoin(F.broadcast(constants)))
    if organization is not None:
        rows = rows.filter(F.col("organization") == organization)
    per_volume = F.col("cost_per_volume")
    pd = F.try_divide(F.col("pd_cost"), F.col("total_weight")) * F.col("weight")
    return rows.select(
        F.col("organization").alias("member_id"),
        (F.col("spm") * per_volume).alias("spm"),
        (F.col("mpm") * per_volume).alias("mpm"),
        (F.col("ser") * per_volume).alias("ser"),
        pd.alias("pd"),
        "weight",
        "extra",
        (F.col("total") * per_volume + pd + F.col("extra")).alias("total"),
    ).orderBy("member_id")


def from_frequencies(table: DataFrame, counts: DataFrame, organizations: DataFrame,
                     target_cost: float, central: str,
                     organization: str | None = None) -> CostReport:
    """The report from a given frequency table and item counts."""
    facts = summary(counts, organizations, target_cost)
    return CostReport(facts, by_member(table, facts, organizations, central, organization), table)


def cost_report(items: DataFrame, cluster_ocns: DataFrame, holdings: DataFrame,
                organizations: DataFrame, target_cost: float, central: str,
                organization: str | None = None) -> CostReport:
    """The whole report from items and holdings."""
    table = ic_frequencies(items, cluster_ocns, holdings, organizations)
    return from_frequencies(table, item_counts(items), organizations, target_cost, central,
                            organization)


def as_text(report: CostReport) -> DataFrame:
    """The header facts as lines of text."""
    labels = {"target_cost": "Target cost", "num_volumes": "Num volumes",
              "num_pd_volumes": "Num pd volumes", "cost_per_volume": "Cost per volume",
              "total_weight": "Total weight", "pd_cost": "PD Cost", "num_members": "Num members"}
    lines = F.array(*[F.concat(F.lit(f"{label}: "), F.col(c).cast("string"))
                      for c, label in labels.items()])
    return report.summary.select(F.posexplode(lines).alias("line", "value")).orderBy("line")
