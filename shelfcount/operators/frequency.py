"""Frequency tables: organisation, format, number of holding members, number of items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.operators.overlap import matching_members

KEYS = ("organization", "format", "bucket")


def frequencies(overlap_rows: DataFrame, organizations: DataFrame) -> DataFrame:
    """Table over the items of the given overlap rows."""
    return (matching_members(overlap_rows, organizations)
            .groupBy("organization", F.col("item_format").alias("format"),
                     F.col("n_members").alias("bucket"))
            .agg(F.count("*").alias("frequency")))


def merge(*tables: DataFrame) -> DataFrame:
    """Sum of frequency tables. Summing the parts equals counting the whole."""
    total = tables[0].select(*KEYS, "frequency")
    for table in tables[1:]:
        total = total.unionByName(table.select(*KEYS, "frequency"))
    return total.groupBy(*KEYS).agg(F.sum("frequency").alias("frequency"))


def lookup(table: DataFrame, organization: str, item_format: str) -> DataFrame:
    return (table.filter((F.col("organization") == organization) & (F.col("format") == item_format))
            .select("bucket", "frequency").orderBy("bucket"))


def organizations_of(table: DataFrame) -> DataFrame:
    return table.select("organization").distinct().orderBy("organization")


def as_json(table: DataFrame) -> DataFrame:
    """The whole table as one nested JSON object.

    Its size is bounded by organisations, formats and buckets (at most one per
    organisation), not by items.
    """
    by_bucket = table.groupBy("organization", "format").agg(F.map_from_entries(F.sort_array(
        F.collect_list(F.struct(F.col("bucket").cast("string"), "frequency")))).alias("b"))
    by_format = by_bucket.groupBy("organization").agg(F.map_from_entries(
        F.collect_list(F.struct("format", "b"))).alias("f"))
    return by_format.agg(F.to_json(F.map_from_entries(
        F.collect_list(F.struct("organization", "f")))).alias("value"))


def histogram(table: DataFrame) -> DataFrame:
    return table.select(*KEYS, "frequency").orderBy(*KEYS)


def hscores(table: DataFrame) -> DataFrame:
    """(organization, spm, mpm, ser, total): sum of frequency / bucket per format."""
    share = F.col("frequency") / F.col("bucket")

    def of(kind: str):
        return F.sum(F.when(F.col("format") == kind, share).otherwise(0.0)).alias(kind)

    scored = table.groupBy("organization").agg(of("spm"), of("mpm"), of("ser"))
    return scored.withColumn("total", F.col("spm") + F.col("mpm") + F.col("ser"))
