import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfcount.operators import changes, counts
from shelfcount.plans import load, synthetic
from shelfcount.streaming import ingest


@pytest.fixture
def table(frame):
    def build(*rows_):
        return frame(list(rows_), "uuid string, ocn long, organization string, mono_multi_serial string")
    return build


def test_equality_folds_blank_and_missing(holdings):
    a = holdings((1, "n1", "", None), (1, "n1", "", ""), (1, "n1", "", "CH"))
    assert changes.dedupe(a).count() == 2
    keyed = a.withColumn("gov_doc_flag", F.lit(None).cast("boolean")).withColumn("issn", F.lit(""))
    assert keyed.select(changes.update_key()).distinct().count() == 2
    paired = changes.same(keyed.withColumn("k", F.lit(1)).limit(1), keyed.withColumn("k", F.lit(1)).limit(1), "k")
    assert paired.first()["same"] is True


def test_insert_ignore(table):
    current, new = table(("a", 1, "n1", "mon")), table(("a", 9, "n1", "mon"), ("b", 2, "n1", "mon"), ("b", 2, "n1", "mon"))
    assert rows(changes.insert_ignore(current, new)) == [("b", 2, "n1", "mon")]


def test_delete(table, frame):
    current = table(("aa-1", 1, "n1", "mon"), ("bb-2", 2, "n1", "mon"), ("cc-3", 3, "n2", "mon"))
    lines = frame([("1\tn1\taa-1",), ("x\tn1\tbb-2",), ("2\tn1\tZZ",), ("3\tn2",)], "value string")
    listed = changes.valid_deletions(lines)
    assert rows(listed, "uuid") == [("aa-1",)]
    assert rows(changes.delete_by_uuid(current, listed), "uuid") == [("bb-2",), ("cc-3",)]
    assert rows(changes.deletion_counts(current, listed)) == [("n1", 1)]
    assert changes.delete_rows(current, table(("-", 2, "n1", "-")), ["ocn", "organization"]).count() == 2


def test_replace(table):
    current = table(("a", 1, "n1", "mon"), ("b", 2, "n1", "ser"), ("c", 3, "n2", "mon"))
    new = table(("d", 4, "n1", "mon"), ("e", 5, "n1", "mon"), ("c", 6, "n1", "mon"))
    assert rows(changes.replace_slice(current, new), "uuid") == [("b",), ("c",), ("d",), ("e",)]
    assert rows(changes.replacement_counts(current, new)) == [("n1", "mon", 1, 3)]


def test_types(table):
    assert rows(changes.migrate_item_types(table(("a", 1, "n", "mono"), ("b", 1, "n", "serial"), ("c", 1, "n", "mix"))),
                "mono_multi_serial") == [("mix",), ("ser",), ("spm",)]
    loaded, new = table(("a", 1, "n1", "mon")), table(("b", 1, "n1", "mon"), ("c", 1, "n1", "ser"), ("d", 1, "n2", "mpm"))
    assert rows(counts.type_gate(loaded, new), "organization", "acceptable") == [("n1", False), ("n2", True)]
    assert rows(counts.loaded_types(loaded)) == [("n1", "mon")]


@pytest.mark.parametrize("loaded, ready, force, ok", [
    (0, 10, False, True), (10, 0, False, False), (100, 104, False, True), (100, 105, False, False),
    (100, 200, True, True), (0, 0, False, None),
])
def test_size_gate(table, loaded, ready, force, ok):
    def some(n):
        return table(*[(str(i), i, "n1", "mon") for i in range(n)])
    gate = counts.size_gate(some(loaded), some(ready), ["organization"], 0.05, 0.10, force)
    assert [r["acceptable"] for r in gate.collect()] == ([] if ok is None else [ok])


def test_size_gate_on_distinct_ocns(table):
    old = table(*[(str(i), i, "n1", "mon") for i in range(100)])
    new = table(*[(str(i), i % 80, "n1", "mon") for i in range(100)])
    row = counts.size_gate(old, new, ["organization"], 0.05, 0.10).first()
    assert (row["line_diff"], row["ocn_diff"], row["acceptable"]) == (0.0, 0.2, False)


def test_counts(table, frame):
    t = table(("a", 1, "n1", "mon"), ("b", 1, "n1", "ser"), ("c", 1, "n2", "mon"))
    assert rows(counts.holdings_by_organization(t)) == [("n1", 2), ("n2", 1)]
    assert [tuple(r) for r in counts.holdings_by_type(t).collect()] == [("n1", "mon", 1), ("n1", "ser", 1), ("n2", "mon", 1)]
    lines = frame([("b.tsv",), ("a.tsv",), ("a.tsv",), ("c.log",)], "file_name string")
    assert [tuple(r) for r in counts.directory_counts(lines).collect()] == [("a.tsv", 2), ("b.tsv", 1), (None, 3)]
    assert changes.with_uuid(t.drop("uuid")).select("uuid").distinct().count() == 3


def test_latest_loaded(frame):
    ledger = frame([("f1", "2024-01-01", "n1", "holding"), ("f2", "2024-03-01", "n1", "holding"),
                    ("f3", "2025-01-01", "n2", "holding")], "filename string, produced string, source string, type string")
    assert rows(changes.latest_loaded(ledger), "source", "filename") == [("n1", "f2"), ("n2", "f3")]


def submit(folder, name, lines):
    (folder / name).write_text("oclc\tlocal_id\n" + "\n".join(f"{n}\tb{n}" for n in lines) + "\n")


def test_scrub_and_load(spark, tmp_path):
    folder, store, ledger = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "ledger")
    folder.mkdir()

    def run(**limits):
        done = load.scrub_and_load(spark, str(folder), store, ledger, str(tmp_path / "work"), "2024-01-01",
                                   10**9, load.Limits(**limits))
        return rows(done, "file_name", "outcome", "ready_lines", "old_count")

    def held():
        return rows(spark.read.parquet(store).groupBy("organization", "mono_multi_serial").agg(
            F.count("*"), F.count_distinct("ocn")))

    submit(folder, "org_mon_full_20240101.tsv", range(1, 101))
    submit(folder, "other_ser_full_20240101.tsv", range(1, 6))
    (folder / "scrub.log").write_text("x")
    assert run() == [("org_mon_full_20240101.tsv", "loaded", 100, 0), ("other_ser_full_20240101.tsv", "loaded", 5, 0)]
    assert run() == []                                          # nothing new
    # two files of a slice at once: the later one stays, alone
    submit(folder, "org_mon_full_20240301.tsv", range(1, 106))
    submit(folder, "org_mon_full_20240201.tsv", range(1, 104))
    assert run() == [("org_mon_full_20240201.tsv", "superseded", 103, 100),
                     ("org_mon_full_20240301.tsv", "loaded", 105, 100)]
    assert held() == [("org", "mon", 105, 105), ("other", "ser", 5, 5)]
    # each is held against the one before, and an older file changes nothing
    submit(folder, "org_mon_full_20240401.tsv", range(1, 300))
    submit(folder, "org_mon_full_20240402.tsv", range(1, 108))
    submit(folder, "org_mon_full_20240115.tsv", [900])
    assert run() == [("org_mon_full_20240115.tsv", "superseded", 1, 105),
                     ("org_mon_full_20240401.tsv", "diff too big", 299, 105),
                     ("org_mon_full_20240402.tsv", "loaded", 107, 105)]
    assert run(force=True) == [("org_mon_full_20240401.tsv", "superseded", 299, 107)]
    submit(folder, "org_ser_full_20240401.tsv", range(1, 3))
    assert run() == [("org_ser_full_20240401.tsv", "mismatch in item types", 2, 0)]
    assert run(check_types=False) == [("org_ser_full_20240401.tsv", "loaded", 2, 0)]
    assert held() == [("org", "mon", 107, 107), ("org", "ser", 2, 2), ("other", "ser", 5, 5)]


def test_files_that_cannot_load_stay_out_of_the_ledger(spark, tmp_path):
    folder, store, ledger = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "ledger")
    folder.mkdir()
    submit(folder, "org_mon_full_20240101.tsv", [1, 2])
    submit(folder, "bad_mon_full_20240101.tsv", ["x", "y"])
    (folder / "none_mon_full_20240101.tsv").write_text("oclc\tlocal_id\n")
    (folder / "nocol_mon_full_20240101.tsv").write_text("local_id\nb1\nb2\n")
    (folder / "tab_mon_full_20240101.tsv").write_text("oclc\tlocal_id\t\t\n5\tb5\n")
    submit(folder, "Bad name.tsv", [3])
    done = load.scrub_and_load(spark, str(folder), store, ledger, str(tmp_path / "work"), "2024-01-01", 10**9)
    assert rows(done, "file_name", "outcome") == [
        ("Bad name.tsv", "invalid file name"), ("bad_mon_full_20240101.tsv", "nothing ready"),
        ("nocol_mon_full_20240101.tsv", "nothing ready"), ("none_mon_full_20240101.tsv", "no data"),
        ("org_mon_full_20240101.tsv", "loaded"), ("tab_mon_full_20240101.tsv", "loaded")]
    assert rows(spark.read.parquet(ledger), "filename") == [("org_mon_full_20240101.tsv",), ("tab_mon_full_20240101.tsv",)]
    # no line is lost: all but the headers are held or rejected
    rejected = spark.read.json(str(tmp_path / "work/rejected"))
    assert rows(rejected.groupBy("file_name").count()) == [
        ("Bad name.tsv", 1), ("bad_mon_full_20240101.tsv", 2), ("nocol_mon_full_20240101.tsv", 2)]
    assert spark.read.parquet(store).count() == 3
    with pytest.raises(load.LoadRefused, match="nothing ready"):
        load.require_loaded(done)


@pytest.mark.parametrize("per_batch", [1, 100])
def test_stream_of_submissions(spark, tmp_path, per_batch):
    folder, store, ledger = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "ledger")
    folder.mkdir()

    def run():
        stream = ingest.submission_stream(spark, str(folder), per_batch)
        ingest.scrub_and_replace(stream, store, ledger, str(tmp_path / "staging"), str(tmp_path / "checkpoint"),
                                 "2024-01-01", 10**9, load.Limits(float("inf"), float("inf"))).awaitTermination()
        found = spark.read.parquet(store).groupBy("organization", "mono_multi_serial").agg(F.count("*"), F.max("ocn"))
        return rows(found)

    submit(folder, "org_mon_full_20240101.tsv", [1, 2, 3])
    submit(folder, "org_ser_full_20240101.tsv", [4])
    assert run() == [("org", "mon", 3, 3), ("org", "ser", 1, 4)]
    submit(folder, "org_mon_full_20240201.tsv", [7, 8])
    submit(folder, "org_mon_full_20240115.tsv", [9])           # older than the other new file
    assert run() == [("org", "mon", 2, 8), ("org", "ser", 1, 4)]
    assert spark.read.parquet(ledger).count() == 4


def test_stream_inserts_each_uuid_once(spark, tmp_path, table):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")

    def run(*rows_):
        table(*rows_).write.mode("append").json(source)
        stream = spark.readStream.schema(table().schema).json(source)
        ingest.insert_new(stream, store, str(tmp_path / "checkpoint")).awaitTermination()
        return rows(spark.read.parquet(store), "uuid")

    assert run(("a", 1, "n1", "mon"), ("a", 1, "n1", "mon"), ("b", 2, "n2", "ser")) == [("a",), ("b",)]
    assert run(("b", 2, "n2", "ser"), ("c", 3, "n1", "mon")) == [("a",), ("b",), ("c",)]


def test_synthetic(spark):
    ids = spark.range(5000)
    held = synthetic.holdings(ids, "org", 1000, "2020-01-01")
    assert held.count() == held.select("uuid").distinct().count() == 5000
    assert rows(held) == rows(synthetic.holdings(ids.repartition(7), "org", 1000, "2020-01-01"))
    pairs = synthetic.concordance(ids, 100_000)
    assert 300 < pairs.count() < 700 and pairs.filter("canonical <= variant or canonical > 100000").count() == 0
    assert synthetic.items(ids, 1000, ("PU", "MIU")).select("collection_code").distinct().count() == 2


def test_rows_are_grouped_after_they_are_dealt_out(table):
    """Neither query sorts a whole split of its input before the shuffle, nor moves attributes twice."""
    some = table(("a", 1, "n1", "mon"), ("a", 1, "n1", "mon"), ("b", 1, "n1", "mon"))
    for made in (changes.insert_ignore(some.limit(0), some), changes.dedupe(some)):
        lines = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
        grouped = [i for i, line in enumerate(lines) if "Aggregate" in line and "min(" in line]
        assert grouped and all("RepartitionByExpression" in "".join(lines[i + 1:i + 3]) for i in grouped)
    assert rows(changes.insert_ignore(some.limit(0), some)) == [("a", 1, "n1", "mon"), ("b", 1, "n1", "mon")]
    assert rows(changes.dedupe(some), "uuid") == [("a",)]
