"""Reports of several dates side by side, and their differences.

Work is done in long form (key, report, value); the sheet is pivoted last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NUMBER = r"^[0-9]+(\.[0-9]+)?$"


def stack(reports: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """(key, report, value) from one DataFrame per report name."""
    parts = [df.select(F.col(key).alias("key"), F.lit(name).alias("report"),
                       F.col(value).cast("string").alias("value")) for name, df in reports.items()]
    return reduce(DataFrame.unionByName, parts)


def complete(long: DataFrame, reports: list[str], na: str = "N/A") -> DataFrame:
    """Every key with every report; a missing value becomes ``na``."""
    names = F.explode(F.array(*[F.lit(r) for r in reports])).alias("report")
    grid = long.select("key").distinct().select("key", names)
    return grid.join(long, ["key", "report"], "left").withColumn("value", F.coalesce("value", F.lit(na)))


def append_sheets(long: DataFrame, reports: list[str], na: str = "N/A") -> DataFrame:
    """One row per key, one column per report."""
    return (long.groupBy("key").pivot("report", reports).agg(F.first("value")).na.fill(na, reports))


def differences(long: DataFrame, reports: list[str], na: str = "N/A") -> DataFrame:
    """(key, report, value): following report minus this one; where either is not
    a number this report's text is kept; the last report has nothing to follow."""
    return _compare(long, reports, na, lambda x, y: _plain(y - x))


def percent_differences(long: DataFrame, reports: list[str], na: str = "N/A") -> DataFrame:
    """(key, report, value): the same in percent of this report; NULL from zero."""
    return _compare(long, reports, na,
                    lambda x, y: F.concat(_plain(F.when(x != 0, 100 * (y - x) / x)), F.lit("%")))


def _compare(long: DataFrame, reports: list[str], na: str, op) -> DataFrame:
    position = F.array_position(F.array(*[F.lit(r) for r in reports]), F.col("report"))
    following = F.lead("value").over(Window.partitionBy("key").orderBy(position))
    numeric = F.col("value").rlike(NUMBER) & F.col("following").rlike(NUMBER)
    x, y = F.col("value").try_cast("double"), F.col("following").try_cast("double")
    return (complete(long, reports, na).withColumn("following", following)
            .select("key", "report",
                    F.when(F.col("following").isNull(), "")
                    .when(numeric, op(x, y)).otherwise(F.col("value")).alias("value")))


def _plain(number: Column) -> Column:
    """Up to ten decimals, without trailing zeros."""
    text = F.format_string("%.10f", number)
    return F.when(number.isNotNull(), F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", ""))


def cost_history(long: DataFrame, reports: list[str], organizations: DataFrame,
                 central: str) -> dict[str, DataFrame]:
    """Totals, differences and percents for members other than the central organisation, and the highlights:
    the last total, difference and percent side by side."""
    ids = organizations.filter(F.col("status") & (F.col("inst_id") != central))
    kept = long.join(ids.select(F.col("inst_id").alias("key")), "key", "left_semi")
    parts = {"total": complete(kept, reports), "diff": differences(kept, reports),
             "percent": percent_differences(kept, reports)}
    named = [df.select("key", F.concat_ws("_", F.lit(name), "report").alias("report"), "value")
             for name, df in parts.items()]
    last = {"total": reports[-1:], "diff": reports[-2:-1], "percent": reports[-2:-1]}  # the last has no follower
    columns = [f"{name}_{r}" for name, of in last.items() for r in of]
    return {**{name: append_sheets(df, reports) for name, df in parts.items()},
            "highlights": append_sheets(reduce(DataFrame.unionByName, named), columns)}


def baseline_change(long: DataFrame, baseline: str, latest: str, organizations: DataFrame,
                    central: str) -> DataFrame:
    """One row per member: both totals, their difference and percent, between a fixed earlier report and the
    latest one."""
    both = long.filter(F.col("report").isin(baseline, latest))
    sheets = cost_history(both, [baseline, latest], organizations, central)
    return sheets["total"].select("key", F.col(f"`{baseline}`").alias(f"total_{baseline}")).join(
        sheets["highlights"], "key")


def report_names(long: DataFrame) -> list[str]:
    """The reports there are, in order; one short string each, a report being a sheet of its own."""
    return [r["report"] for r in long.select("report").distinct().orderBy("report").collect()]
