"""Line-oriented inputs other than submissions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcount.functions.enum_chron import with_enum_chron
from shelfcount.operators.concordance import require_well_formed
from shelfcount.schemas import CONCORDANCE, FREQUENCY_JSON, HOLDING, LEGACY_ITEM_TYPES

LEGACY_COLUMNS = ("ocn", "local_id", "organization", "status", "condition", "date_received",
                  "enum_chron", "mono_multi_serial", "issn", "n_enum", "n_chron", "gov_doc", "uuid")
SKIPPED_SUFFIXES = (".log", ".xml", ".tar.gz")


def raw_lines(spark: SparkSession, path: str | list[str], encoding: str | None = None) -> DataFrame:
    """(value) per line; gz, CR and CRLF are handled by the reader.

    Input that is not UTF-8 names its encoding and is decoded by the CSV
    reader with quoting and separation switched off.
    """
    if encoding is None or encoding.upper() in ("UTF-8", "UTF8"):
        return spark.read.text(path)
    return (spark.read.schema("value string").option("encoding", encoding)
            .option("sep", "\u0001").option("quote", "").csv(path))


def file_name() -> Column:
    """Name of the file that a row comes from; the reader gives it as part of a URI."""
    return F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))).alias("file_name")


def read_lines(spark: SparkSession, path: str | list[str], encoding: str | None = None) -> DataFrame:
    """(file_name, value), one row per line."""
    return raw_lines(spark, path, encoding).select(file_name(), "value")


def with_heads(lines: DataFrame) -> DataFrame:
    """Lines (path, start, value, ...) as they were scanned, with ``head``: whether each is the first of its file.

    A task reads the lines of a split in order, and may read several splits. The first line of the split at offset 0
    is the header: where path or offset differ from the line before. Seen in passing, so nothing is numbered, sorted
    or copied. Has to come before anything that moves lines.
    """
    names = lines.columns
    at_path, at_start = names.index("path"), names.index("start")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            path, start = batch.column(at_path), batch.column(at_start)
            new = np.ones(batch.num_rows, bool)
            new[1:] = (pc.not_equal(path[1:], path[:-1]).to_numpy(zero_copy_only=False)
                       | pc.not_equal(start[1:], start[:-1]).to_numpy(zero_copy_only=False))
            new[0] = (path[0].as_py(), start[0].as_py()) != before
            before = path[-1].as_py(), start[-1].as_py()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(new & (start.to_numpy(zero_copy_only=False) == 0))], names=[*names, "head"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema.fields)
    return lines.mapInArrow(mark, f"{fields}, head boolean")


def read_data_lines(spark: SparkSession, path: str | list[str], pattern: str,
                    encoding: str | None = None) -> DataFrame:
    """(file_name, value) without the first line of each file where it matches; later ones that match are data."""
    found = with_heads(raw_lines(spark, path, encoding).select(
        file_name(), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        "value"))
    return found.filter(~(F.col("head") & F.col("value").rlike(pattern))).select("file_name", "value")


def holdings_from_legacy(lines: DataFrame) -> DataFrame:
    """Positional 13-column lines to holdings."""
    cells = F.split("value", "\t", -1)

    def cell(name: str) -> Column:
        return F.get(cells, F.lit(LEGACY_COLUMNS.index(name)))

    kind = F.when(cell("mono_multi_serial") == "", "mix").otherwise(cell("mono_multi_serial"))
    for old, new in LEGACY_ITEM_TYPES.items():
        kind = F.when(cell("mono_multi_serial") == old, new).otherwise(kind)
    typed = lines.select(
        F.coalesce(F.regexp_extract(cell("ocn"), r"^\s*(\d+)", 1).try_cast("bigint"),
                   F.lit(0)).alias("ocn"),
        cell("local_id").alias("local_id"),
        cell("organization").alias("organization"),
        F.when(cell("status") == "", "CH").otherwise(cell("status")).alias("status"),
        cell("condition").alias("condition"),
        cell("enum_chron").alias("enum_chron"),
        kind.alias("mono_multi_serial"),
        cell("issn").alias("issn"),
        (F.coalesce(cell("gov_doc").try_cast("int"), F.lit(0)) != 0).alias("gov_doc_flag"),
        F.coalesce(F.when(cell("uuid") != "", cell("uuid")), F.uuid()).alias("uuid"),
        parse_date(cell("date_received")).alias("date_received"),
    )
    return with_enum_chron(typed)


def parse_date(text: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date")
                        for f in ("yyyy-MM-dd", "yyyyMMdd", "yyyy-MM-dd HH:mm:ss")])


def holdings_from_json(spark: SparkSession, path: str | list[str], *more: str) -> DataFrame:
    """Scrubbed holdings, one JSON object per line; the flag may be "0", "1", true or null.

    ``more`` names further fields of text to read."""
    loose = T.StructType([
        T.StructField(f.name, T.StringType() if f.name == "gov_doc_flag" else f.dataType)
        for f in HOLDING.fields
    ] + [T.StructField(c, T.StringType()) for c in more])
    rows = spark.read.schema(loose).json(path)
    return with_enum_chron(rows.withColumn(
        "gov_doc_flag", F.col("gov_doc_flag").isin("1", "true")))


def read_holdings(spark: SparkSession, path: str) -> DataFrame:
    """Reader by extension: .tsv is the legacy layout, .ndj the scrubbed one."""
    if path.endswith(".tsv"):
        return holdings_from_legacy(read_data_lines(spark, path, "^OCN"))
    if path.endswith(".ndj"):
        return holdings_from_json(spark, path)
    raise ValueError(f"invalid file extension: {path}")


def read_concordance(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pairs of a file; one with a line that is not number, tab, number is refused."""
    lines = spark.read.text(path)
    require_well_formed(lines)
    cells = F.split("value", "\t")
    return lines.select(*[F.get(cells, F.lit(i)).cast(f.dataType).alias(f.name) for i, f in enumerate(CONCORDANCE.fields)])


def read_keyed(spark: SparkSession, path: str, schema: T.StructType, delimiter: str = "\t") -> DataFrame:
    """Header file to named columns; a line of another width fails the job."""
    width = len(schema.fields)
    lines = spark.read.schema(schema).csv(
        path, sep=delimiter, header=True, mode="FAILFAST", enforceSchema=False, quote="")
    if width != len(lines.columns):
        raise ValueError(f"expected {width} columns")
    return lines


def read_ocn_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Distinct integers, one per line; lines without a number are dropped."""
    number = F.regexp_extract("value", r"^\s*(\d+)", 1).try_cast("bigint")
    return (spark.read.text(path).select(number.alias("ocn"))
            .filter(F.col("ocn").isNotNull()).distinct())


def count_non_numeric(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).agg(F.count_if(~F.col("value").rlike(r"^\s*\d")).alias("non_numeric"))


def read_frequency_json(spark: SparkSession, file: str | None = None,
                        directory: str | None = None) -> DataFrame:
    """One frequency file, or every .json of a directory, never both; not yet summed."""
    if file and directory:
        raise ValueError("give either a file or a directory of frequency tables")
    if not (file or directory):
        raise ValueError("no frequency table provided")
    if file:
        texts = spark.read.text(file, wholetext=True)
    else:
        texts = spark.read.option("pathGlobFilter", "*.json").text(directory, wholetext=True)
    return frequency_rows(texts.select("value"))


def frequency_rows(texts: DataFrame) -> DataFrame:
    """JSON text per row to (organization, format, bucket, frequency)."""
    by_org = texts.select(F.explode(F.from_json("value", FREQUENCY_JSON)).alias("organization", "f"))
    by_format = by_org.select("organization", F.explode("f").alias("format", "b"))
    return (by_format.select("organization", "format", F.explode("b").alias("bucket", "frequency"))
            .withColumn("bucket", F.col("bucket").cast("bigint")))


def new_files(listed: DataFrame, seen: DataFrame) -> DataFrame:
    """Listed files (name, is_dir) not seen before; logs, XML and archives are not submissions."""
    wanted = ~F.coalesce(F.col("is_dir"), F.lit(False))
    for suffix in SKIPPED_SUFFIXES:
        wanted = wanted & ~F.col("name").endswith(suffix)
    return listed.filter(wanted).join(seen.select("name"), "name", "left_anti")


def newest_file(listed: DataFrame, organization: str, item_type: str) -> DataFrame:
    """The greatest matching scrubbed file name."""
    pattern = f"^{organization}_{item_type}_.+\\.ndj$"
    return listed.filter(F.col("name").rlike(pattern)).agg(F.max("name").alias("name"))
