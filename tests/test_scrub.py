import gzip

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfcount.functions import scrub
from shelfcount.plans import load
from shelfcount.sources import submissions as sub

MAX = 2_000_000_000


@pytest.fixture(scope="module")
def ocns(spark):
    def run(text):
        df = spark.createDataFrame([(text,)], "t string").select(
            scrub.ocn_candidates(F.col("t"), MAX).alias("c"))
        return df.select(scrub.valid_ocns(F.col("c")), scrub.reject_reasons(F.col("c"))).first()
    return run


@pytest.mark.parametrize("text, expected", [
    ("1", [1]), ("1,1", [1]), ("1,2", [1, 2]), ("", []), ("1.0E+10", []), ("a1a", []), ("1a1", []),
    ("foo1", []), ("(foo)1", []), ("999999999999999", []), ("9" * 30, []), ("0", []),
    ("90|81/72;63:54,45 36", [90, 81, 72, 63, 54, 45, 36]),
    ("on41/ocolc32;ocn23 ocm14|oclc5", [41, 32, 23, 14, 5]),
    ("(ON)8;(OcN)7|(oclc)6 (ocm)5", [8, 7, 6, 5]),
    ("88,", [88]), ("88,; ", [88]), (",88", [88]), (" ,", []),
    ("(OCoLC)0012", [12]), ("ocn", []), (None, []), ("2000000001", []),
    # an allowed prefix inside another one is enough; ocl7 has none inside
    ("person1", [1]), ("ocl71", []), ("(ocl7)1", []),
])
def test_ocn(ocns, text, expected):
    assert ocns(text)[0] == expected


def test_reasons(ocns):
    assert ocns("0 x1 (x)1 1x 1e5 on 99999999999")[1] == [
        scrub.ZERO, scrub.BAD_PREFIX, scrub.BAD_PAREN, scrub.MIXED, scrub.IN_EXPONENT, scrub.NO_NUMBER,
        scrub.TOO_LARGE]
    assert ocns("88,;")[1] == [] and ocns("")[1] == [] and ocns(" ,")[1] == [] and ocns(",88")[1] == [scrub.EMPTY]


@pytest.mark.parametrize("rule, text, expected", [
    (scrub.local_id, " a; b,a c ", "a,b,c"),
    (scrub.local_id, "x" * 51 + " y", "y"),
    (scrub.local_id, "", ""),
    (scrub.local_id, ",", ""),
    (scrub.issn, "1234-5678;12345678, 1234-567X bad", "1234-5678;12345678;1234-567X"),
    (scrub.issn, "", ""),
    (scrub.status, " CH\t", "CH"), (scrub.status, "ch", None), (scrub.status, "", None),
    (scrub.condition, "BRT", "BRT"), (scrub.condition, "FINE", None),
    (scrub.gov_doc, "1", "1"), (scrub.gov_doc, "2", None),
])
def test_fields(frame, rule, text, expected):
    assert frame([(text,)], "t string").select(rule(F.col("t"))).first()[0] == expected


def test_int_list(frame):
    df = frame([("1,2",), ("",), ("x,3",)], "t string")
    assert [r[0] for r in df.select(scrub.int_list(F.col("t"))).collect()] == [[1, 2], [], [0, 3]]


@pytest.mark.parametrize("name, valid", [
    ("shelf_mon_full_20200101.tsv", True), ("a-b_ser_partial_20200101_fix_2.tsv.gz", True),
    ("shelf_mon_full_2020.tsv", False), ("shelf_xxx_full_20200101.tsv", False),
    ("Shelf_mon_full_20200101.tsv", False), ("shelf_mon_all_20200101.tsv", False),
    ("shelf_mon_full_20200101.csv", False),
])
def test_file_names(frame, name, valid):
    row = sub.diagnose_file_names(frame([(name,)], "file_name string")).first()
    assert row["valid"] is valid
    checks = [row[c] for c in row.asDict() if c.endswith("_check")]
    assert all(c == "ok" for c in checks) is valid


def test_headers(frame):
    heads = frame([
        ("a_mon_full_20200101.tsv", "OCLC\t local_id \tstatus"),
        ("a_mon_full_20200102.tsv", "oclc\tlocal_id\t22"),
        ("a_mpm_full_20200101.tsv", "﻿oclc\tlocal_id"),
        ("a_ser_full_20200101.tsv", "issn\toclc\tlocal_id\tstatus"),
        ("bad_name.tsv", "oclc\tlocal_id"),
    ], "file_name string, header string")
    found = {r["file_name"]: r for r in sub.analyse_headers(heads).collect()}
    assert (found["a_mon_full_20200101.tsv"]["fault"], found["a_mon_full_20200101.tsv"]["at_status"]) == (None, 2)
    assert "22" in found["a_mon_full_20200102.tsv"]["fault"]
    assert found["a_mpm_full_20200101.tsv"]["missing"] == ["enum_chron"]
    assert found["a_mpm_full_20200101.tsv"]["fault"] is None
    assert "status" in found["a_ser_full_20200101.tsv"]["fault"]
    assert "Invalid filename" in found["bad_name.tsv"]["fault"]


def test_scrub_files(spark, tmp_path):
    (tmp_path / "org_mon_full_20240101.tsv").write_bytes(
        "﻿oclc\tlocal_id\tstatus\tcondition\tenum_chron\n"
        "1\tb1\tCH\tBRT\tv.1 1999\n2,3\tb2\t\t\t\nfoo\tb3\tCH\t\t\n4\tb4\n\n5\tb5\tlost\t\t\n".encode())
    (tmp_path / "org_spm_full_20240101.tsv").write_bytes(b"local_id\toclc\rx\t7\ry\t8")
    with gzip.open(tmp_path / "org-b_ser_full_20240101.tsv.gz", "wb") as f:
        f.write(b"oclc\tlocal_id\tissn\tgovdoc\r\n9\tz\t1234-5678 nope\t1\r\n")
    (tmp_path / "org_mpm_full_20240101.tsv").write_text("oclc\tlocal_id\t22\n1\tb\tc\n")
    done = load.scrub_files(spark, str(tmp_path), "2024-02-01", MAX)
    assert rows(done.valid, "organization", "mono_multi_serial", "ocn", "local_id", "n_enum") == [
        ("org", "mon", 1, "b1", "1"), ("org", "mon", 2, "b2", ""), ("org", "mon", 3, "b2", ""),
        ("org", "mon", 5, "b5", ""), ("org", "spm", 7, "x", ""), ("org", "spm", 8, "y", ""),
        ("org-b", "ser", 9, "z", "")]
    serial = done.valid.filter("mono_multi_serial = 'ser'").first()
    assert (serial["issn"], serial["gov_doc_flag"], serial["status"]) == ("1234-5678", True, None)
    reasons = [r["reason"] for r in done.rejected.collect()]
    assert sorted(reasons) == ["Column not allowed: 22", "No valid OCN",
                               "Wrong number of cols (expected 5, got 2)", "bad line (nil/empty)"]
    stats = dict(rows(done.stats))
    assert stats["bad status value"] == 1 and stats["multi_ocn_record"] == 1
    assert stats["ocn rejected: invalid prefix"] == 1


def test_encoding(spark, tmp_path):
    (tmp_path / "org_mon_full_20240101.tsv").write_bytes(
        "oclc\tlocal_id\tenum_chron\n1\tb1\tBändé 3\n".encode("latin-1"))
    done = load.scrub_files(spark, str(tmp_path), "2024-02-01", MAX, encoding="ISO-8859-1")
    assert rows(done.valid, "ocn", "enum_chron") == [(1, "Bändé 3")]


def test_no_shuffle_of_lines(spark, tmp_path):
    (tmp_path / "org_mon_full_20240101.tsv").write_text("oclc\tlocal_id\n1\tb1\n")
    lines = sub.read_submissions(spark, str(tmp_path)).lines
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan  # headers are told apart as lines pass


def test_judging_a_line_is_whole(spark, frame):
    """A text far beyond any usual length is judged to its end."""
    text = " ".join(f"ocn{n}" for n in range(1, 3001))
    lines = frame([("a_mon_full_20200101.tsv", f"{text}\tb")], "file_name string, value string")
    heads = frame([("a_mon_full_20200101.tsv", "oclc\tlocal_id")], "file_name string, header string")
    done = sub.scrub_lines(sub.Submissions(lines, heads), "2024-01-01", MAX)
    assert (done.valid.count(), done.valid.select("uuid").distinct().count()) == (3000, 3000)


def test_lines_are_judged_without_the_counters_texts(frame):
    """A load asks for holdings and rejected lines only; counters are worked out for those who ask for them."""
    name = "org_mon_full_20240101.tsv"
    lines = frame([(name, "ocn007\tb1"), (name, "foo1\tb2"), (name, "2,3\tb3")], "file_name string, value string")
    done = sub.scrub_lines(sub.Submissions(lines, frame([(name, "oclc\tlocal_id")], "file_name string, header string")),
                           "2024-01-01", 10**9)
    assert "messages" not in done.judged.columns
    assert rows(done.judged, "ocns", "reason") == [([], "No valid OCN"), ([2, 3], ""), ([7], "")]
    assert ("multi_ocn_record", 1) in rows(done.stats) and ("ocn prefix: foo", 1) in rows(done.stats)


@pytest.mark.parametrize("text, expected", [
    ("ocm0012", [(12, None)]), ("(OCoLC)7;on8", [(7, None), (8, None)]), ("ocm0", [(None, "numeric part is zero")]),
    ("ocn99999999999999999999999", [(None, "too large for an ocn")]), ("9223372036854775807", [(None, "too large for an ocn")]),
    ("9223372036854775808", [(None, "too large for an ocn")]), ("ocn", [(None, "numeric part is nil")]), (" ,;", []), ("\t", [
        (None, "ocn is empty")])])
def test_short_cut_gives_what_all_checks_give(frame, text, expected):
    found = frame([(text,)], "t string").select(scrub.ocn_candidates(F.col("t"), 10**9).alias("c")).first()["c"]
    assert [(c["ocn"], c["reason"]) for c in found] == expected


def test_no_number_is_cast_that_cannot_be_one(frame):
    """A cast that fails raises an error inside, for every such line."""
    plan = frame([("x",)], "t string").select(
        scrub.ocn_candidates(F.col("t"), 10**9))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("cast(") and plan.count("length(") >= plan.count("as bigint)")
