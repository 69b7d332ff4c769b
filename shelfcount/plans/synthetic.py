"""Synthetic holdings, items and concordance of any size, the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(seed: str, n: int | Column) -> Column:
    """An integer in 0..n-1 from the row id: the first eight digits of its md5, as any engine computes it."""
    digits = F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{seed}")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % n


def _one_of(seed: str, *values: str | None) -> Column:
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), _pick(seed, len(values)).cast("int"))


def holdings(ids: DataFrame, organization: str, max_ocn: int, date: str) -> DataFrame:
    """One holding per row id."""
    return ids.select(
        _pick("ocn", max_ocn).alias("ocn"),
        _pick("local", 10_000_000).cast("string").alias("local_id"),
        F.lit(organization).alias("organization"),
        _one_of("status", "CH", "LM", "WD", None).alias("status"),
        _one_of("condition", "BRT", "").alias("condition"),
        F.lit("").alias("enum_chron"),
        F.lit("mon").alias("mono_multi_serial"),
        F.lit(None).cast("string").alias("issn"),
        (_pick("gov", 2) == 1).alias("gov_doc_flag"),
        F.concat_ws("-", F.lit(organization), F.sha2(F.col("id").cast("string"), 256)).alias("uuid"),
        F.lit(date).cast("date").alias("date_received"),
    )


def items(ids: DataFrame, max_ocn: int, collections: tuple[str, ...]) -> DataFrame:
    """One item per row id, each on a record of its own."""
    return ids.select(
        F.concat(F.lit("test."), F.col("id").cast("string")).alias("item_id"),
        F.col("id").alias("bib_key"),
        _one_of("rights", "ic", "pd").alias("rights"),
        _one_of("fmt", "BK", "SE").alias("bib_fmt"),
        F.lit("").alias("enum_chron"),
        _one_of("collection", *collections).alias("collection_code"),
        F.array(_pick("ocn", max_ocn)).alias("ocns"),
    )


def concordance(ids: DataFrame, max_ocn: int, deprecated: float = 0.10) -> DataFrame:
    """About a tenth of the ids become variants of a greater OCN, so there is no cycle."""
    chosen = ids.filter((F.col("id") > 0) & (F.col("id") < max_ocn)
                        & (_pick("drop", 10_000) < int(deprecated * 10_000)))
    step = _pick("to", F.lit(max_ocn) - F.col("id")) + 1
    return chosen.select(F.col("id").alias("variant"), (F.col("id") + step).alias("canonical"))
