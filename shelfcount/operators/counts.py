"""Plain counts and the gates that are decided from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcount.functions.rights import is_ic


def holdings_by_type(holdings: DataFrame) -> DataFrame:
    return (holdings.groupBy("organization", "mono_multi_serial").agg(F.count("*").alias("holdings"))
            .orderBy("organization", "mono_multi_serial"))


def holdings_by_organization(holdings: DataFrame) -> DataFrame:
    return holdings.groupBy("organization").agg(F.count("*").alias("holdings"))


def item_counts(items: DataFrame) -> DataFrame:
    """One row (n_items, n_ic, n_pd); everything not in copyright is public domain here."""
    ic = F.coalesce(is_ic("rights"), F.lit(False))
    return items.agg(F.count("*").alias("n_items"), F.count_if(ic).alias("n_ic"),
                     F.count_if(~ic).alias("n_pd"))


def file_counts(lines: DataFrame) -> DataFrame:
    """(file_name, lines)."""
    return lines.groupBy("file_name").agg(F.count("*").alias("lines")).orderBy("file_name")


def directory_counts(lines: DataFrame, suffix: str = ".tsv") -> DataFrame:
    """Lines per file with the suffix, and a total row whose file_name is NULL."""
    return (lines.filter(F.col("file_name").endswith(suffix))
            .rollup("file_name").agg(F.count("*").alias("lines"))
            .orderBy(F.col("file_name").asc_nulls_last()))


def scrubbed_counts(holdings: DataFrame) -> DataFrame:
    """One row (n_lines, n_ocns)."""
    return holdings.agg(F.count("*").alias("n_lines"), F.count_distinct("ocn").alias("n_ocns"))


def size_gate(loaded: DataFrame, ready: DataFrame, keys: list[str],
              max_line_diff: float, max_ocn_diff: float, force: bool = False) -> DataFrame:
    """Per key: may the ready rows replace the loaded ones?

    Nothing ready is never acceptable, nothing loaded always is. Otherwise
    lines and distinct OCNs may each differ by less than their limit.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count("*").alias(f"{name}_lines"),
                                     F.count_distinct("ocn").alias(f"{name}_ocns"))

    both = counted(loaded, "loaded").join(counted(ready, "ready"), keys, "full").na.fill(0)
    line_diff = _relative(F.col("ready_lines"), F.col("loaded_lines"))
    ocn_diff = _relative(F.col("ready_ocns"), F.col("loaded_ocns"))
    ok = acceptable(F.col("loaded_lines"), F.col("ready_lines"), F.col("loaded_ocns"), F.col("ready_ocns"),
                    max_line_diff, max_ocn_diff)
    return both.select(
        *keys, "loaded_lines", "ready_lines", "loaded_ocns", "ready_ocns",
        line_diff.alias("line_diff"), ocn_diff.alias("ocn_diff"),
        (ok | F.lit(force)).alias("acceptable"))


def acceptable(loaded_lines: Column, ready_lines: Column, loaded_ocns: Column, ready_ocns: Column,
               max_line_diff: float, max_ocn_diff: float) -> Column:
    """Whether so many ready lines and OCNs may replace the loaded ones."""
    lines, ocns = _relative(ready_lines, loaded_lines), _relative(ready_ocns, loaded_ocns)
    return (F.when(ready_lines == 0, F.lit(False))
            .when(loaded_lines == 0, F.lit(True))
            .otherwise((lines < max_line_diff) & (F.coalesce(ocns, F.lit(0.0)) < max_ocn_diff)))


def _relative(new: Column, old: Column) -> Column:
    return F.abs(new - old) / F.when(old != 0, old)


def type_gate(loaded: DataFrame, submitted: DataFrame) -> DataFrame:
    """Per organisation: are the submitted types among those loaded before?

    An organisation without holdings may load anything. Types are few, so the
    sets are collected per organisation.
    """
    old = loaded.groupBy("organization").agg(
        F.sort_array(F.collect_set("mono_multi_serial")).alias("old_types"))
    new = submitted.groupBy("organization").agg(
        F.sort_array(F.collect_set("mono_multi_serial")).alias("new_types"))
    both = new.join(old, "organization", "left")
    diff = F.coalesce(F.array_except("new_types", "old_types"), F.array().cast("array<string>"))
    return both.select("organization", "new_types", "old_types", diff.alias("diff_types"),
                       (F.size(diff) == 0).alias("acceptable"))


def loaded_types(holdings: DataFrame) -> DataFrame:
    return holdings.select("organization", "mono_multi_serial").distinct()


def first_lines(lines: DataFrame, n: int) -> DataFrame:
    return lines.limit(n)


def require_data(lines: DataFrame, path: str) -> None:
    """A file of one line or none has no data."""
    if lines.limit(2).count() <= 1:
        raise ValueError(f"file {path} has no data")
