import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from shelfcount.functions import rights
from shelfcount.operators import counts, dimensions
from shelfcount.plans import load
from shelfcount.sources import catalog, files, marcxml, sinks, tables

RECORDS = [
    {"id": "000000811", "format": ["Serial", "Newspaper"], "oclc": ["4101"],
     "oclc_search": ["4102", "4101", "4103", "4104"], "deleted": False,
     "ht_json": json.dumps([
         {"htid": "x.1", "newly_open": None, "rights": ["und", None], "collection_code": "qq1", "enumcron": "v.8-9"},
         {"htid": "x.2", "rights": ["icus"], "collection_code": "qq1", "enumcron": "v.10"}])},
    {"id": "7", "format": ["Book"], "ht_json": json.dumps(
        [{"htid": "y.1", "rights": ["pd"], "collection_code": "pu"}])},
    {"id": "8", "format": ["Map"], "oclc": ["5"], "oclc_search": ["5"], "deleted": True, "ht_json": "[]"},
]


@pytest.fixture
def records(spark, tmp_path):
    path = tmp_path / "records.ndj"
    path.write_text("\n".join(json.dumps(r) for r in RECORDS))
    return catalog.parse_records(catalog.read_records(spark, str(path)))


def test_catalog(records):
    loaded = catalog.load(records)
    assert rows(loaded.items, "item_id", "bib_key", "rights", "access", "bib_fmt", "n_enum", "collection_code") == [
        ("x.1", 811, "und", "deny", "SE", "8-9", "QQ1"), ("x.2", 811, "icus", "deny", "SE", "10", "QQ1"),
        ("y.1", 7, "pd", "allow", "BK", "", "PU")]
    assert loaded.record_ocns.filter("cluster_id = '000000811'").count() == 4
    assert loaded.record_ocns.filter("cluster_id = '7'").count() == 0
    assert loaded.items.filter("item_id = 'x.1'").first()["ocns"] == [4101]
    assert rows(catalog.with_ic_items(records), "record_id") == [("000000811",)]
    assert rows(catalog.not_deleted(records), "record_id") == [("000000811",), ("7",)]


def test_records_by_ocn_come_once(records, frame):
    found = catalog.having_ocns(records, frame([(4101,), (4102,), (1,)], "ocn long"))
    assert rows(found, "record_id") == [("000000811",)]


def test_formats_and_rights(frame):
    df = frame([(["Book", "Serial"],), (["Book"],), (["Map"],), (None,)], "f array<string>")
    assert [r[0] for r in df.select(rights.bib_format("f")).collect()] == ["SE", "BK", "XX", "XX"]
    shown = frame([("pdus", "allow", "us"), ("pdus", "allow", "ca"), ("icus", "deny", "ca"), ("icus", "deny", "us"),
                   ("ic", "deny", "ca"), ("pd", "allow", None)], "r string, a string, c string")
    assert [r[0] for r in shown.select(rights.access_for_country("r", "a", "c")).collect()] == [
        "allow", "deny", "allow", "deny", "deny", "allow"]
    states = frame([("CH", ""), (None, "BRT"), ("LM", ""), ("WD", "BRT")], "status string, condition string")
    assert [tuple(r) for r in states.select(rights.is_current(), rights.gives_access()).collect()] == [
        (True, False), (True, True), (False, True), (False, True)]


def test_item_rows(frame):
    raw = frame([("x.1", "000123", "ic", False, "BK", "v.2 1999", "MIU", "1,2"),
                 ("x.2", "5", "pd", True, "SE", None, "PU", "")],
                "htid string, bib_num string, rights_code string, access boolean, bib_fmt string, "
                "description string, collection_code string, oclc string")
    found = tables.items_from_rows(raw)
    assert rows(found, "item_id", "bib_key", "access", "n_enum", "ocns") == [
        ("x.1", 123, "deny", "2", [1, 2]), ("x.2", 5, "allow", "", [])]
    bridge = tables.item_ocns(found)
    assert rows(tables.items_with_ocns(found, bridge, frame([(1,), (2,)], "ocn long")), "item_id") == [("x.1",)]
    asked = frame([("x.1",), ("no",)], "item_id string")
    assert rows(tables.find_items(asked, found), "item_id", "not_found") == [("no", True), ("x.1", False)]
    assert rows(tables.items_on_records(found, frame([(5,)], "bib_key long")), "item_id") == [("x.2",)]


def test_holdings_by_ocn(holdings, frame):
    table = holdings((1, "n1"), (2, "n1"), (2, "n2"))
    asked = frame([(2,), (2,), (2**31 + 5,)], "ocn long")
    assert tables.holdings_with_ocns(table, asked).count() == 2
    assert tables.holdings_with_ocns(table, asked, "n2").count() == 1
    beyond = holdings((2**31 + 5, "n1"))
    assert tables.holdings_with_ocns(beyond, asked).count() == 0


def test_resolutions(frame):
    pairs = frame([(1, 2), (3, 1), (4, 5)], "variant long, canonical long")
    assert rows(tables.resolutions_with_ocns(pairs, frame([(1,), (2,)], "ocn long"))) == [(1, 2), (3, 1)]


def test_legacy_holdings(spark, tmp_path):
    path = tmp_path / "old.tsv"
    path.write_text("OCN\tBIB\tMEMBER_ID\n"
                    "12\tb1\torg\t\tBRT\t2019-10-24\tv.1\tmono\t\t\t\t1\n"
                    "13\tb2\torg\tWD\t\t2019-10-24\t\tserial\t1234-5678\t\t\t0\tu-1\n"
                    "14\tb3\torg\tCH\t\t2019-10-24\t\t\t\t\t\t\n")
    found = files.read_holdings(spark, str(path))
    # only the first line may be a header
    (tmp_path / "again.tsv").write_text("15\tb1\torg\nOCN 16\tb2\torg\n")
    assert rows(files.read_holdings(spark, str(tmp_path / "again.tsv")), "ocn") == [(0,), (15,)]
    assert rows(found, "ocn", "status", "mono_multi_serial", "gov_doc_flag", "n_enum") == [
        (12, "CH", "spm", True, "1"), (13, "WD", "ser", False, ""), (14, "CH", "mix", False, "")]
    assert found.filter("uuid = 'u-1'").count() == 1
    assert str(found.first()["date_received"]) == "2019-10-24"
    with pytest.raises(ValueError):
        files.read_holdings(spark, "x.csv")


def test_json_holdings(spark, tmp_path, holdings):
    path = tmp_path / "h.ndj"
    path.write_text('{"ocn":1,"local_id":"a","organization":"n1","gov_doc_flag":"1","enum_chron":"v.3","uuid":"u",'
                    '"date_received":"2024-01-01","n_enum":"stale"}\n'
                    '{"ocn":2,"gov_doc_flag":true,"uuid":"w"}\n{"ocn":3,"gov_doc_flag":null,"uuid":"z"}\n')
    found = files.read_holdings(spark, str(path))
    assert rows(found, "ocn", "gov_doc_flag", "n_enum") == [(1, True, "3"), (2, True, ""), (3, None, "")]
    assert counts.scrubbed_counts(found).first()["n_ocns"] == 3


def test_small_files(spark, tmp_path):
    (tmp_path / "list.txt").write_text("5\n5\n7\nabc\n\n")
    assert rows(files.read_ocn_list(spark, str(tmp_path / "list.txt"))) == [(5,), (7,)]
    assert files.count_non_numeric(spark, str(tmp_path / "list.txt")).first()[0] == 2
    (tmp_path / "t.tsv").write_text("ocn\tid\n1\ta\n")
    schema = T.StructType([T.StructField("ocn", T.LongType()), T.StructField("id", T.StringType())])
    assert rows(files.read_keyed(spark, str(tmp_path / "t.tsv"), schema)) == [(1, "a")]
    (tmp_path / "bad.tsv").write_text("ocn\tid\n1\ta\tb\n")
    with pytest.raises(Exception):
        files.read_keyed(spark, str(tmp_path / "bad.tsv"), schema).collect()
    lines = files.read_lines(spark, str(tmp_path / "list.txt"))
    assert rows(counts.file_counts(lines)) == [("list.txt", 5)]
    assert counts.first_lines(lines, 2).count() == 2
    counts.require_data(lines, "list.txt")
    with pytest.raises(ValueError):
        counts.require_data(lines.limit(1), "list.txt")


def test_new_and_newest_files(frame):
    listed = frame([("a.tsv", False), ("b.tsv", False), ("c.log", False), ("d.xml", False), ("e.tar.gz", False),
                    ("dir", True)], "name string, is_dir boolean")
    assert rows(files.new_files(listed, frame([("a.tsv",)], "name string")), "name") == [("b.tsv",)]
    scrubbed = frame([("org_mon_2024-01-01.ndj",), ("org_mon_2024-02-01.ndj",), ("org_ser_2025.ndj",)], "name string")
    assert files.newest_file(scrubbed, "org", "mon").first()[0] == "org_mon_2024-02-01.ndj"


def record(kind, fixed, *fields, control="31"):
    """One record: type letter, 008 text (None to leave it out), data fields as (tag, {code: text})."""
    data = "".join(f'<datafield tag="{tag}" ind1=" " ind2=" ">' + "".join(
        f'<subfield code="{c}">{v}</subfield>' for c, v in sub.items()) + "</datafield>" for tag, sub in fields)
    eight = "" if fixed is None else f'<controlfield tag="008">{fixed}</controlfield>'
    one = "" if control is None else f'<controlfield tag="001">{control}</controlfield>'
    return f"<record><leader>00000na{kind} a2200000 a 4500</leader>{eight}{one}{data}</record>"


FEDERAL, FOREIGN = "881130s1987    dcu     x    f00||| und  ", "881130s1987    gw      x    f00||| und  "
XML = '<?xml version="1.0"?><collection>' + "".join([
    record("m", FEDERAL, ("ITM", {"a": "bd. 4", "c": "FRAGILE", "d": "707", "i": "1987", "k": "LOST_LOAN"}),
           ("035", {"a": "(OCoLC)5151"})),
    record("s", FOREIGN, ("022", {"a": "4321-0987"}), ("035", {"a": "(OCoLC)062"}), control="32"),
    record("m", FOREIGN), record("a", None),
    record("m", FOREIGN, ("ITM", {"d": "708"}), ("035", {"z": "6"})),
    record("m", FOREIGN, ("ITM", {"a": "bd. 5"}), ("035", {"a": "7"})),
    record("s", FOREIGN, ("035", {"a": "8"}), control=None)]) + "</collection>"


def test_marc(spark, tmp_path):
    (tmp_path / "in.xml").write_text(XML)
    converted = marcxml.convert(marcxml.read_marc(spark, str(tmp_path / "in.xml")))
    assert rows(marcxml.monographs(converted)) == [("(OCoLC)5151", "707", "LM", "BRT", "bd. 4,1987", "1")]
    assert rows(marcxml.serials(converted)) == [("(OCoLC)062", "32", "4321-0987", "0")]
    errors = load.convert_marc(spark, str(tmp_path / "in.xml"), str(tmp_path / "out"))
    assert rows(errors) == [
        ("Record rejected for an ITM field without local id", 1), ("Record rejected for missing 001 field", 1),
        ("Record rejected for missing 035a (ocn)", 2), ("unexpected item type mix", 1)]
    text = "".join(p.read_text() for p in (tmp_path / "out" / "mon").glob("part-*"))
    assert text == ("oclc\tlocal_id\tstatus\tcondition\tenum_chron\tgovdoc\n"
                    "(OCoLC)5151\t707\tLM\tBRT\tbd. 4,1987\t1\n")


def test_dimensions(frame, organizations, items):
    found = tables.organizations(
        organizations.select("inst_id", "weight", "status", F.lit("S").alias("oclc_sym")),
        organizations.select("inst_id", "country_code", "mapto_inst_id").filter("inst_id != 'guest'"))
    assert found.count() == 7
    asked = frame([("n4",), ("parent",), ("n1",), ("nobody",)], "organization string")
    assert rows(dimensions.resolve_mapto(asked, organizations).na.fill("-")) == [
        ("n1", "n1"), ("n4", "parent"), ("nobody", "-"), ("parent", "parent")]
    extra = frame([("n9", "us", 11.0, True, "n9")], organizations.schema.simpleString()[7:-1].replace(":", " "))
    more = dimensions.add_temporary(organizations, extra)
    assert more.count() == 9
    assert rows(dimensions.invalid_organizations(more), "inst_id") == [("n9",)]
    with pytest.raises(ValueError):
        dimensions.require_none(dimensions.invalid_organizations(more), "weights")
    collections = frame([("MIU", "n1")], "collection string, billing_entity string")
    coded = items(("r", "i", 1, "BK", "")).drop("billing_entity").withColumn("collection_code", F.lit("XX"))
    assert rows(dimensions.missing_collections(coded, collections)) == [("XX",)]
    assert rows(dimensions.with_billing_entity(coded, collections, strict=False), "billing_entity") == [(None,)]
    with pytest.raises(ValueError, match="XX"):
        dimensions.with_billing_entity(coded, collections)
    assert rows(dimensions.missing_organizations(asked, organizations), "inst_id") == [("nobody",), ("parent",)]
    assert rows(dimensions.member_list(organizations)) == [("central",)] + [(f"n{i}",) for i in range(1, 7)]


def test_sinks(spark, frame, holdings, tmp_path):
    rows_ = holdings(*[(n, f"n{n % 2}", "", None, "", f"b{n}", "mon" if n % 3 else "ser") for n in range(20)])
    sinks.write_backup(rows_, "n1", ["mon", "ser"], str(tmp_path / "backup"))
    back = spark.read.json(str(tmp_path / "backup"))
    assert back.count() == 10 and [r[0] for r in back.select("uuid").collect()] == sorted(
        r[0] for r in back.select("uuid").collect())
    sinks.write_split(rows_, str(tmp_path / "split"), 4)
    assert spark.read.json(str(tmp_path / "split")).count() == 20
    report = frame([("n1", 1, ""), ("n2", 2, "x")], "organization string, ocn long, note string")
    sinks.write_tsv(report, str(tmp_path / "tsv"), by="organization")
    assert {p.name for p in (tmp_path / "tsv").iterdir() if p.is_dir()} == {"organization=n1", "organization=n2"}
    assert spark.read.csv(str(tmp_path / "tsv"), sep="\t", header=True).count() == 2
    assert sinks.report_name("n1", "2024-01-01", "us") == "overlap_n1_2024-01-01"
    assert sinks.report_name("n5", "2024-01-01", "ca").endswith("_nonus")
    freq = frame([("n1", "spm", 2, 3)], "organization string, format string, bucket long, frequency long")
    sinks.write_histograms(freq, str(tmp_path / "hist"))
    assert (tmp_path / "hist" / "organization=n1" / "format=spm").is_dir()
    sinks.write_text(frame([("one",)], "value string"), str(tmp_path / "text"))
    ledger = frame([("f",)], "filename string")
    sinks.append_ledger(ledger, str(tmp_path / "ledger"))
    sinks.append_ledger(ledger, str(tmp_path / "ledger"))
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 2


def test_store_spreads_a_hot_ocn(spark, tmp_path):
    """A third of the rows on one OCN: several files, none much larger than the others."""
    rows_ = spark.range(9000).select(
        F.expr("if(id % 3 = 0, 1, id)").alias("ocn"), F.lit("n1").alias("organization"),
        F.lit("mon").alias("mono_multi_serial"), F.sha2(F.col("id").cast("string"), 256).alias("uuid"))
    before = {k: spark.conf.get(k) for k in (
        "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        sinks.write_store(rows_, str(tmp_path / "store"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    per_file = spark.read.parquet(str(tmp_path / "store")).groupBy(F.input_file_name()).count()
    assert max(r[1] for r in rows(per_file)) < 2000 and spark.read.parquet(str(tmp_path / "store")).count() == 9000


@pytest.mark.parametrize("in_order", [True, False])
@pytest.mark.parametrize("suffix, encoding, options", [
    ("", None, {}), (".gz", None, {"compression": "gzip"}), ("", "ISO-8859-1", {})])
def test_long_files_are_sorted_in_ranges(spark, tmp_path, monkeypatch, in_order, suffix, encoding, options):
    monkeypatch.setattr(sinks, "ROWS_PER_TASK", 300)
    if not in_order:  # a task that takes its partitions in another order
        monkeypatch.setattr(sinks, "sorted", lambda found: sorted(found, reverse=True), raising=False)
    given = {"a b.tsv": 2000, "c+d.tsv": 901, "e.tsv": 300, "f.tsv": 1}
    lines = spark.createDataFrame([(name, i * 1237 % 4001, f"{name}\té {i * 1237 % 4001:04}") for name, n in given.items()
                                   for i in range(n)], "file_name string, pos long, value string").repartition(5)
    sinks.write_named_files(lines, f"{tmp_path}/out", suffix, encoding, **options)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]
    found = {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")}
    assert sorted(found) == [name + suffix for name in given]
    for name, n in given.items():
        text = found[name + suffix]
        text = (gzip.decompress(text) if suffix else text).decode(encoding or "utf-8")
        assert text.split("\n") == [*(f"{name}\té {pos:04}" for pos in sorted(i * 1237 % 4001 for i in range(n))), ""]


def test_no_task_sorts_a_long_file(spark, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_TASK", 500)
    lines = spark.range(6000, numPartitions=4).select(F.lit("a").alias("file_name"), (-F.col("id")).alias("pos"),
                                                      F.lit("x").alias("value"))
    sizes = sinks.sorted_ranges(lines, 6000).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 6000 and max(r["count"] for r in sizes) <= 1000
