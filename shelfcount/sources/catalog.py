"""Catalogue records: one JSON object per line with the item list nested as text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcount.functions.rights import bib_format, has_ic_item
from shelfcount.schemas import CATALOG_ITEMS, CATALOG_RECORD
from shelfcount.sources.tables import items_from_records


@dataclass(frozen=True)
class Catalog:
    """records(record_id, bib_key, oclc_search, ...), items, and record OCNs."""

    records: DataFrame
    items: DataFrame
    record_ocns: DataFrame


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema(CATALOG_RECORD).json(path)


def parse_records(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("record_id"),
        F.coalesce(F.col("id").try_cast("bigint"), F.lit(0)).alias("bib_key"),
        bib_format("format").alias("bib_fmt"),
        F.coalesce(_longs("oclc"), F.array().cast("array<bigint>")).alias("ocns"),
        _longs("oclc_search").alias("oclc_search"),
        F.coalesce("deleted", F.lit(False)).alias("deleted"),
        F.from_json("ht_json", CATALOG_ITEMS).alias("item_list"),
    )


def _longs(name: str) -> Column:
    """Numbers of a list of texts; what is no number is left out."""
    return F.filter(F.transform(name, lambda x: x.try_cast("bigint")), lambda x: x.isNotNull())


def not_deleted(records: DataFrame) -> DataFrame:
    return records.filter(~F.col("deleted"))


def with_ic_items(records: DataFrame) -> DataFrame:
    return records.filter(has_ic_item("item_list"))


def having_ocns(records: DataFrame, ocns: DataFrame) -> DataFrame:
    """Records whose search OCNs contain any of the given ones, each record once."""
    hit = (records.select("record_id", F.explode("oclc_search").alias("ocn"))
           .join(ocns.select("ocn"), "ocn", "left_semi").select("record_id"))
    return records.join(hit, "record_id", "left_semi")


def record_items(records: DataFrame) -> DataFrame:
    """One row per item, keyed by its record's cluster."""
    exploded = records.select(
        "record_id", "bib_key", "bib_fmt", "ocns", F.explode("item_list").alias("i"))
    flat = exploded.select(
        F.col("record_id").alias("cluster_id"),
        F.col("i.htid").alias("item_id"),
        "bib_key",
        F.col("i.rights")[0].alias("rights"),
        "bib_fmt",
        F.coalesce("i.enumcron", F.lit("")).alias("enum_chron"),
        F.upper("i.collection_code").alias("collection_code"),
        "ocns",
    )
    return items_from_records(flat)


def record_ocns(records: DataFrame) -> DataFrame:
    """(cluster_id, ocn); a record without search OCNs has no rows and so no holdings."""
    return records.select(F.col("record_id").alias("cluster_id"),
                          F.explode("oclc_search").alias("ocn")).distinct()


def load(records: DataFrame) -> Catalog:
    return Catalog(records, record_items(records), record_ocns(records))
