"""Writers. Each takes a finished DataFrame and a target path."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.errors import PythonException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F

from shelfcount.session import ROWS_PER_TASK, dealt, materialize

STORE_KEYS = ("organization", "mono_multi_serial")
#: Rows of a file on average, below which it is worth a shuffle to have fewer files.
ROWS_PER_FILE = 2_000


def write_store(holdings: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The holdings store: partitioned by organisation and type, sorted by OCN.

    Spread by range with the uuid as tie-breaker: a large organisation, or one
    OCN with very many holdings, is written by many tasks, while a small one
    gets one file. Row groups stay prunable on ocn.
    """
    (holdings.repartitionByRange(*STORE_KEYS, "ocn", "uuid")
     .sortWithinPartitions(*STORE_KEYS, "ocn")
     .write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*STORE_KEYS).parquet(path))


def append_store(holdings: DataFrame, path: str) -> None:
    """Rows of a written table added to the store.

    Each task writes a file for every slice that it has rows of. Where these files would be small, rows are first
    brought together by slice.
    """
    files = holdings.rdd.getNumPartitions() * holdings.select(*STORE_KEYS).distinct().count()
    if holdings.count() < ROWS_PER_FILE * files:
        write_store(holdings, path, "append")
    else:
        holdings.write.mode("append").partitionBy(*STORE_KEYS).parquet(path)


def write_scrubbed(valid: DataFrame, path: str) -> None:
    """Holdings as JSON lines. The uuids are fixed from here on."""
    valid.write.mode("overwrite").json(path)


def write_tsv(report: DataFrame, path: str, by: str | None = None, compress: bool = True) -> None:
    """Tab separated with header; one directory per value of ``by``, large ones in several files."""
    if by is not None:
        report = report.repartitionByRange(by, *[c for c in report.columns if c != by])
    writer = report.write.mode("overwrite")
    if by is not None:
        writer = writer.partitionBy(by)
    writer.csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="",
               compression="gzip" if compress else "none")


def report_name(organization: str, date: str, country_code: str | None) -> str:
    return f"overlap_{organization}_{date}{'' if country_code == 'us' else '_nonus'}"


def write_text(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def write_named_files(lines: DataFrame, folder: str, suffix: str = "", encoding: str | None = None, **options: str) -> None:
    """(file_name, pos, value) as one file for each name, lines in order of pos, added to the folder.

    For deliveries to others, who want a file of a certain name. Names of up to ``ROWS_PER_TASK`` lines are sorted by a
    task each. Those of more are sorted in ranges, by many tasks, and one task for each file writes these one after the
    other: it holds no more than a batch of lines. Files appear when they are whole. ``options`` are those of the text
    writer.
    """
    counts = materialize(lines.groupBy("file_name").agg(F.count("*").alias("n")), "names")
    large = counts.filter(F.col("n") > ROWS_PER_TASK)
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(
        F.when(F.col("n") > ROWS_PER_TASK, F.col("n"))), F.lit(0))).first()  # two numbers
    if totals[1]:
        long = large.select(F.col("file_name").alias("long_name"))
        is_long = lines["file_name"].eqNullSafe(long["long_name"])
        _write_long_files(lines.join(long, is_long, "left_semi"), totals[1], folder, suffix, encoding, options)
        lines = lines.join(long, is_long, "left_anti")
    if totals[0] > totals[1] or not totals[0]:
        parts = f"{folder}_parts-{uuid.uuid4().hex}"
        _write_lines(dealt(lines, totals[0] - totals[1], "file_name").sortWithinPartitions("file_name", "pos")
                     .select("file_name", "value").write.partitionBy("file_name"), parts, encoding, options)
        _move_files(lines.sparkSession, parts, f"{parts}/file_name=*/part-*", folder, suffix)


def _write_lines(writer: DataFrameWriter, path: str, encoding: str | None, options: dict[str, str]) -> None:
    writer = writer.options(**options)
    if encoding is None:
        writer.text(path)
    else:
        writer.csv(path, encoding=encoding, sep="\u0001", quote="", escape="", emptyValue="", nullValue="",
                   ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def _move_files(spark: SparkSession, parts: str, pattern: str, folder: str, suffix: str) -> None:
    """The files of folders file_name=... get their names; ``parts`` is deleted."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(folder))
    for found in system.globStatus(path(pattern)):
        name = unquote(found.getPath().getParent().getName()[len("file_name="):])
        system.rename(found.getPath(), path(f"{folder}/{name}{suffix}"))
    system.delete(path(parts), True)


def sorted_ranges(lines: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` lines (file_name, pos, value), sorted, in partitions of about ROWS_PER_TASK lines each.

    ``place`` ascends over all of them.
    """
    return (lines.repartitionByRange(-(-rows // ROWS_PER_TASK) + 1, "file_name", "pos")
            .sortWithinPartitions("file_name", "pos")
            .select("file_name", F.monotonically_increasing_id().alias("place"), "value"))


def ascending(lines: DataFrame) -> DataFrame:
    """Values of lines (place, value) as they come; an error if places do not ascend, over all that a task reads."""
    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = -1
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column(0).to_numpy()
            if place[0] <= last or (np.diff(place) <= 0).any():
                raise ValueError("lines out of order")
            last = place[-1]
            yield batch.select([1])

    return lines.select("place", "value").mapInArrow(values, "value string")


def _write_long_files(lines: DataFrame, rows: int, folder: str, suffix: str, encoding: str | None,
                      options: dict[str, str]) -> None:
    """A file for each name from ranges that are sorted apart.

    A task that reads several partitions takes them in their order, which is nowhere promised; so it is checked, and
    where it does not hold, the file is sorted by one task after all.
    """
    spark, work = lines.sparkSession, f"{folder}_ranges-{uuid.uuid4().hex}"
    sorted_ranges(lines, rows).write.partitionBy("file_name").parquet(work)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(work).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = f"{folder}_parts-{uuid.uuid4().hex}"
    for own in system.globStatus(path(f"{work}/file_name=*")):
        ranges = sorted(found.getPath().toString() for found in system.listStatus(own.getPath()))
        read = reduce(DataFrame.union, [spark.read.schema("place long, value string").parquet(one) for one in ranges])
        to = f"{parts}/{own.getPath().getName()}"
        try:
            _write_lines(ascending(read.coalesce(1)).write.mode("overwrite"), to, encoding, options)
        except PythonException as error:
            if "lines out of order" not in str(error):
                raise
            _write_lines(ascending(read.repartition(1).sortWithinPartitions("place")).write.mode("overwrite"), to, encoding,
                         options)
    _move_files(spark, parts, f"{parts}/file_name=*/part-*", folder, suffix)
    system.delete(path(work), True)


def write_frequency_json(nested: DataFrame, path: str) -> None:
    """One JSON object in one file; see ``frequency.as_json``."""
    nested.select("value").write.mode("overwrite").text(path)


def write_backup(holdings: DataFrame, organization: str, item_types: list[str], path: str) -> None:
    """What a load is about to replace, as JSON lines ordered by uuid."""
    (holdings.filter((F.col("organization") == organization)
                     & F.col("mono_multi_serial").isin(item_types))
     .orderBy("uuid").write.mode("overwrite").json(path))


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Concordance pairs: validated file, .adds or .deletes."""
    pairs.select("variant", "canonical").write.mode("overwrite").csv(path, sep="\t")


def write_histograms(frequencies: DataFrame, path: str) -> None:
    """(bucket, frequency) files in one directory per organisation and format."""
    (frequencies.select("organization", "format", "bucket", "frequency")
     .repartition("organization", "format")
     .sortWithinPartitions("organization", "format", "bucket")
     .write.mode("overwrite").partitionBy("organization", "format").csv(path, sep="\t"))


def append_ledger(entry: DataFrame, path: str) -> None:
    entry.write.mode("append").parquet(path)


def write_split(holdings: DataFrame, path: str, parts: int) -> None:
    """Sorted by OCN and split into equal ranges of it, a file each."""
    sorted_split(holdings, parts).drop("part").write.mode("overwrite").json(path)


def sorted_split(holdings: DataFrame, parts: int) -> DataFrame:
    """Rows with their ``part``, sorted by OCN within it, a partition for each part.

    Boundaries are exact, from the counts of all OCNs rather than a sample: a part ends where its share of the rows is
    reached, and an OCN is never divided, so sizes differ by less than the most frequent OCN has rows.
    """
    return (holdings.join(ocn_parts(holdings, parts), "ocn")
            .repartition(parts, F.element_at(F.array(*map(F.lit, _keys(holdings.sparkSession, parts))), F.col("part") + 1))
            .sortWithinPartitions("ocn"))


def _keys(spark: SparkSession, parts: int) -> list[int]:
    """For each partition a number that hashes into it, so that every part gets one of its own."""
    found: dict[int, int] = {}
    tried = 0
    while len(found) < parts:
        some = spark.range(tried, tried + 40 * parts).select(F.col("id").cast("int").alias("key"))
        for row in some.groupBy(F.pmod(F.hash("key"), F.lit(parts)).alias("at")).agg(F.min("key").alias("key")).collect():
            found.setdefault(row["at"], row["key"])
        tried += 40 * parts
    return [found[i] for i in range(parts)]


def ocn_parts(holdings: DataFrame, parts: int) -> DataFrame:
    """(ocn, part): equal shares of the rows in the order of OCNs.

    Counts are summed within ranges of OCNs and the totals of the ranges before are added; there are as many totals as
    ranges. An OCN belongs to the part that its middle row falls into.
    """
    counts = materialize(holdings.groupBy("ocn").agg(F.count("*").alias("n")), "counts")
    ordered = materialize(counts.repartitionByRange("ocn").withColumn("range", F.spark_partition_id()), "ordered")
    totals = ordered.groupBy("range").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = totals.withColumn("start", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
    whole = starts.agg(F.sum("total")).first()[0] or 1  # one number
    within = Window.partitionBy("range").orderBy("ocn").rowsBetween(Window.unboundedPreceding, -1)
    return ordered.join(starts, "range").select("ocn", F.floor(
        (F.col("start") + F.coalesce(F.sum("n").over(within), F.lit(0)) + F.col("n") / 2) * parts / whole)
        .cast("int").alias("part"))
