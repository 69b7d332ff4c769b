"""Scans over the holdings, item, concordance and dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.functions.enum_chron import with_enum_chron
from shelfcount.functions.rights import record_access, table_access
from shelfcount.functions.scrub import int_list
from shelfcount.schemas import MAX_STORED_OCN


def holdings(raw: DataFrame) -> DataFrame:
    """The holdings table with n_enum, n_chron and n_enum_chron derived, never trusted."""
    return with_enum_chron(raw)


def holdings_of(table: DataFrame, organization: str) -> DataFrame:
    return table.filter(F.col("organization") == organization)


def holdings_with_ocns(table: DataFrame, ocns: DataFrame, organization: str | None = None) -> DataFrame:
    """Holdings on any of the OCNs; numbers beyond the stored integer range never match."""
    wanted = ocns.filter(F.col("ocn") <= MAX_STORED_OCN).select("ocn")
    if organization is not None:
        table = holdings_of(table, organization)
    return table.join(wanted, "ocn", "left_semi")


def items_from_rows(rows: DataFrame) -> DataFrame:
    """Item table rows (flat, comma separated OCNs) to the item model."""
    mapped = rows.select(
        F.col("htid").alias("item_id"),
        F.coalesce(F.col("bib_num").try_cast("bigint"), F.lit(0)).alias("bib_key"),
        F.col("rights_code").alias("rights"),
        table_access("access").alias("access"),
        "bib_fmt",
        F.coalesce("description", F.lit("")).alias("enum_chron"),
        "collection_code",
        F.coalesce(int_list(F.col("oclc")), F.array().cast("array<bigint>")).alias("ocns"),
    )
    return with_enum_chron(mapped)


def items_from_records(items: DataFrame) -> DataFrame:
    """Items parsed from catalogue records; access follows from rights."""
    return with_enum_chron(items.withColumn("access", record_access("rights")))


def item_ocns(items: DataFrame) -> DataFrame:
    """Bridge (item_id, ocn)."""
    return items.select("item_id", F.explode("ocns").alias("ocn")).distinct()


def items_with_ocns(items: DataFrame, bridge: DataFrame, ocns: DataFrame) -> DataFrame:
    """Items having at least one of the OCNs, each once."""
    hit = bridge.join(ocns.select("ocn"), "ocn", "left_semi").select("item_id")
    return items.join(hit, "item_id", "left_semi")


def items_on_records(items: DataFrame, bib_keys: DataFrame) -> DataFrame:
    return items.join(bib_keys.select("bib_key"), "bib_key", "left_semi")


def find_items(requests: DataFrame, items: DataFrame) -> DataFrame:
    """Requested items by id; ``not_found`` marks the ones that do not exist."""
    found = items.withColumn("__hit", F.lit(True))
    return (requests.join(found, "item_id", "left")
            .withColumn("not_found", F.col("__hit").isNull()).drop("__hit"))


def resolutions_with_ocns(concordance: DataFrame, ocns: DataFrame) -> DataFrame:
    """Concordance rows touching an OCN on either side, each once."""
    wanted = ocns.select("ocn").distinct()
    by_variant = concordance.join(wanted, concordance.variant == wanted.ocn, "left_semi")
    by_canonical = concordance.join(wanted, concordance.canonical == wanted.ocn, "left_semi")
    return by_variant.union(by_canonical).distinct()


def organizations(billing: DataFrame, institutions: DataFrame) -> DataFrame:
    """Members joined to their institution data on inst_id."""
    joined = billing.join(institutions, "inst_id")
    return joined.select("inst_id", "country_code", F.col("weight").cast("double").alias("weight"),
                         "oclc_sym", F.col("status").cast("boolean").alias("status"), "mapto_inst_id")


def collections(raw: DataFrame) -> DataFrame:
    return raw.select("collection", "content_provider_cluster", "responsible_entity",
                      "original_from_inst_id", "billing_entity")
