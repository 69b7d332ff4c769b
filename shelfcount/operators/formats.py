"""Item and cluster formats: ser, mpm, spm, and ser/spm for mixed clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def record_flags(items: DataFrame) -> DataFrame:
    """Per cluster and record: does any item carry an enumeration, is any (not) a serial."""
    serial = F.col("bib_fmt").eqNullSafe("SE")
    return items.groupBy("cluster_id", "bib_key").agg(
        F.max(F.coalesce("n_enum", F.lit("")) != "").alias("has_enum"),
        F.max(serial).alias("any_serial"),
        F.max(~serial).alias("any_other"),
        F.max(F.coalesce("n_enum", F.lit("")) == "").alias("has_blank"),
        F.count("*").alias("n_items"),
    )


def cluster_formats(flags: DataFrame) -> DataFrame:
    """(cluster_id, cluster_format, cluster_blank, cluster_items) from record flags.

    ``cluster_blank`` tells whether some item of the cluster has no
    enumeration, ``cluster_items`` how many items it has.
    """
    seen = flags.groupBy("cluster_id").agg(
        F.max(F.col("any_other") & F.col("has_enum")).alias("mpm"),
        F.max(F.col("any_other") & ~F.col("has_enum")).alias("spm"),
        F.max("any_serial").alias("ser"),
        F.max("has_blank").alias("cluster_blank"),
        F.sum("n_items").alias("cluster_items"),
    )
    kind = (F.when(F.col("mpm"), "mpm")
            .when(F.col("spm") & F.col("ser"), "ser/spm")
            .when(F.col("ser"), "ser")
            .otherwise("spm"))
    return seen.select("cluster_id", kind.alias("cluster_format"), "cluster_blank", "cluster_items")


def with_formats(items: DataFrame) -> DataFrame:
    """Items with item_format, cluster_format, cluster_blank and cluster_items.

    The flags are joined back as one row per record and cluster; a window
    would put a whole cluster into one task.
    """
    flags = record_flags(items)
    both = flags.select("cluster_id", "bib_key", "has_enum").join(cluster_formats(flags), "cluster_id")
    kind = (F.when(F.col("bib_fmt").eqNullSafe("SE"), "ser")
            .when(F.col("has_enum"), "mpm").otherwise("spm"))
    return (items.join(both, ["cluster_id", "bib_key"])
            .withColumn("item_format", kind).drop("has_enum"))
