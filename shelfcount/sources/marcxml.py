"""MARC-XML holdings exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcount.functions.marc import MON_COLUMNS, SER_COLUMNS, marc_holding
from shelfcount.schemas import MARC_RECORD
from shelfcount.session import materialize


def read_marc(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records; leader and control fields are positional, so spaces are kept."""
    return (spark.read.format("xml").schema(MARC_RECORD).option("rowTag", "record")
            .option("ignoreSurroundingSpaces", "false").load(path))


def marc_texts(texts: DataFrame, column: str = "xml") -> DataFrame:
    """The same from a column holding one record per row.

    Written out once parsed: filters on the fields would otherwise parse the
    text again for every field they look at.
    """
    parsed = F.from_xml(F.col(column), MARC_RECORD, {"ignoreSurroundingSpaces": "false"})
    return materialize(texts.withColumn("__r", parsed).select(
        *[c for c in texts.columns if c != column], "__r.*"), "marc")


def convert(records: DataFrame) -> DataFrame:
    """One row per record with its holding cells and, if refused, the error."""
    kept = [c for c in records.columns if c not in MARC_RECORD.names]
    return records.withColumn("__h", marc_holding()).select(*kept, "__h.*")


def monographs(converted: DataFrame) -> DataFrame:
    return _accepted(converted, "mon").select(*MON_COLUMNS)


def serials(converted: DataFrame) -> DataFrame:
    return _accepted(converted, "ser").select(*SER_COLUMNS)


def error_counts(converted: DataFrame) -> DataFrame:
    return (converted.filter(F.col("error").isNotNull())
            .groupBy("error").agg(F.count("*").alias("records")))


def _accepted(converted: DataFrame, kind: str) -> DataFrame:
    return converted.filter(F.col("error").isNull() & (F.col("item_type") == kind))
