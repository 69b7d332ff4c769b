import pytest

from shelfcount.functions.enum_chron import with_enum_chron

GOLDEN = {
    "v.1 Jul 1999": ("1", "Jul 1999"),
    "vol 1, 1999": ("vol:1", "1999"),
    "v.1-5 (1901-1905)": ("1-5", "1901-1905"),
    "vol\t1\tAug\t5": ("vol:1", "Aug 5"),
    "1 aug": ("1", "aug"),
    "": ("", ""),
    None: ("", ""),
    # a year-month token stands for itself and its month
    "1999-Jan": ("", "1999-Jan Jan"),
    # only letter and digits survive, then only the digits
    "pt2a": ("2", ""),
    "v.5": ("5", ""),
    "007": ("007", ""),
    "n.s": ("s", ""),
    # a bare year is a chronology, which leaves the enumeration blank
    "1863": ("", "1863"),
    "12345": ("12345", ""),
    "V.1": ("1", ""),
    "v. 1": ("1", ""),
    "summary": ("", "summary"),
    "1999-": ("", "1999"),
    # the leftmost gap closes, not the one that was counted
    "a. 1999 b. c": ("b:c", "a.1999"),
    "no. 3. 1999 v. 2": ("3.1999:v:2", ""),
    "v.1 no.2 Jan 5-7 1990": ("1:2", "Jan 5-7 1990"),
    "Jan-Mar 1990": ("", "Jan-Mar 1990"),
    "[v.2]": ("2", ""),
    "bd.1:t.2": ("1:2", ""),
    "spring 1990 v.3": ("3", "spring 1990"),
    "vol.1410": ("", "vol.1410"),
}


@pytest.fixture(scope="module")
def parsed(spark):
    df = with_enum_chron(spark.createDataFrame([(k,) for k in GOLDEN], "enum_chron string"))
    return {r["enum_chron"]: r for r in df.collect()}


@pytest.mark.parametrize("text", GOLDEN, ids=repr)
def test_golden(parsed, text):
    row = parsed[text]
    assert (row["n_enum"], row["n_chron"]) == GOLDEN[text]
    joined = "\t".join(GOLDEN[text])
    assert row["n_enum_chron"] == ("" if joined == "\t" else joined)


def test_stored_values_are_ignored(spark):
    df = spark.createDataFrame([("v.2", "99", "x")], "enum_chron string, n_enum string, n_chron string")
    assert with_enum_chron(df).first()["n_enum"] == "2"


def test_short_years(spark):
    from pyspark.sql import functions as F
    from shelfcount.functions.enum_chron import _expand_short_year
    df = spark.createDataFrame([("05",), ("11",), ("12",), ("88",), ("1999",)], "c string")
    assert [r[0] for r in df.select(_expand_short_year(F.col("c"))).collect()] == [
        "2005", "2011", "1912", "1988", "1999"]


def test_runs_without_python_workers_or_shuffle(spark):
    plan = with_enum_chron(spark.range(3).selectExpr("cast(id as string) enum_chron"))._jdf \
        .queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_rows_are_not_copied_from_step_to_step(spark):
    """All of the parsing is one expression under a condition, so plain rows pass without its steps."""
    df = with_enum_chron(spark.range(3).selectExpr("concat('v.', id, if(id = 1, ' (1990)', '')) AS enum_chron"))
    assert str(df._jdf.queryExecution().executedPlan()).count("Project") <= 5
    assert sorted((r.n_enum, r.n_chron) for r in df.collect()) == [("0", ""), ("1", "1990"), ("2", "")]
