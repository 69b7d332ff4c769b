"""Organisations and collections: lookups and their quality checks.

Both tables are hand-kept lists of institutions. They are broadcast after their
rows have been counted, see ``checked_broadcast``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.session import checked_broadcast


def members(organizations: DataFrame) -> DataFrame:
    return organizations.filter(F.col("status"))


def member_list(organizations: DataFrame) -> DataFrame:
    return members(organizations).select("inst_id").orderBy("inst_id")


def with_billing_entity(items: DataFrame, collections: DataFrame, strict: bool = True) -> DataFrame:
    """Billing entity by collection code. An unknown code is an error, or NULL if not ``strict``."""
    if strict:
        require_none(missing_collections(items, collections), "collections without an entry")
    lookup = collections.select(F.col("collection").alias("collection_code"), "billing_entity")
    return items.join(checked_broadcast(lookup), "collection_code", "left")


def with_organization_attributes(rows: DataFrame, organizations: DataFrame) -> DataFrame:
    """Country and weight of the organisation on each row."""
    lookup = organizations.select(F.col("inst_id").alias("organization"), "country_code", "weight")
    return rows.join(checked_broadcast(lookup), "organization", "left")


def mapped_organizations(organizations: DataFrame) -> DataFrame:
    """(mapto_inst_id, inst_id): which organisations answer for a parent id."""
    return organizations.select("mapto_inst_id", "inst_id")


def resolve_mapto(requests: DataFrame, organizations: DataFrame) -> DataFrame:
    """Add mapto: the id itself if it is a parent id, else its organisation's parent id."""
    parents = (organizations.select(F.col("mapto_inst_id").alias("organization")).distinct()
               .withColumn("__parent", F.col("organization")))
    own = organizations.select(F.col("inst_id").alias("organization"),
                               F.col("mapto_inst_id").alias("__own"))
    return (requests.join(checked_broadcast(parents), "organization", "left")
            .join(checked_broadcast(own), "organization", "left")
            .withColumn("mapto", F.coalesce("__parent", "__own")).drop("__parent", "__own"))


def add_temporary(organizations: DataFrame, extra: DataFrame) -> DataFrame:
    """What-if organisations; one with a known id replaces it. Nothing is stored."""
    kept = organizations.join(extra.select("inst_id"), "inst_id", "left_anti")
    return kept.select(organizations.columns).unionByName(extra, allowMissingColumns=True)


def invalid_organizations(organizations: DataFrame) -> DataFrame:
    """Rows that break the rules, with the reason."""
    weight = F.coalesce(F.col("weight").cast("double"), F.lit(0.0))
    reason = (F.when(F.col("inst_id").isNull(), "Must have institution id")
              .when((weight < 0) | (weight > 10), "Weight must be between 0 and 10"))
    return organizations.withColumn("reason", reason).filter("reason is not null")


def missing_organizations(rows: DataFrame, organizations: DataFrame,
                          column: str = "organization") -> DataFrame:
    """Organisation ids in use that the dimension does not know."""
    used = rows.select(F.col(column).alias("inst_id")).filter("inst_id is not null").distinct()
    return used.join(organizations.select("inst_id"), "inst_id", "left_anti")


def missing_collections(items: DataFrame, collections: DataFrame) -> DataFrame:
    """Collection codes in use that the dimension does not know."""
    used = items.select(F.col("collection_code").alias("collection")).distinct()
    return used.join(collections.select("collection"), "collection", "left_anti")


def require_none(violations: DataFrame, what: str) -> None:
    """Fail the job when a quality check found anything."""
    found = violations.limit(5).collect()
    if found:
        raise ValueError(f"{what}: {', '.join(str(tuple(r)) for r in found)}")
