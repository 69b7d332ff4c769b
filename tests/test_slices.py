"""Summaries and the uuid index beside the store, and loads and streams that use them."""

import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from shelfcount.plans import load
from shelfcount.sources import sinks, slices
from shelfcount.sources.slices import Kept
from shelfcount.streaming import ingest
from tests.conftest import rows

HELD = "uuid string, ocn long, organization string, mono_multi_serial string, local_id string"


def held(n, organization="n1", kind="mon", first=0, step=1):
    return [(f"{organization}-{kind}-{i}", i * step % 50_000 * 977, organization, kind, "b") for i in range(first, first + n)]


def by_hand(data):
    out = {}
    for _, ocn, organization, kind, _ in data:
        lines, ocns = out.setdefault((organization, kind), [0, set()])
        out[organization, kind][0] += 1
        if ocn is not None:
            ocns.add(ocn)
    return sorted((*k, n, len(o)) for k, (n, o) in out.items())


@pytest.fixture
def store(tmp_path):
    return str(tmp_path / "store")


def test_summaries_add_up(spark, frame, store):
    first = held(300) + held(120, "n2", "ser", step=3) + [("x", None, "n1", "mon", "b")]
    more = held(300, first=200) + held(10, "n3")
    sinks.write_store(frame(first, HELD), store)
    kept = Kept.of(spark, store)
    assert rows(slices.sizes(kept.summary())) == by_hand(first)
    kept.appended(frame(more, HELD), kept.next_generation())
    assert rows(slices.sizes(kept.summary())) == by_hand(first + more)
    kept.replaced(frame(held(7, "n2", "ser"), HELD), kept.next_generation())
    asked = frame([("n2", "ser"), ("n3", "mon"), ("n9", "mon")], "organization string, mono_multi_serial string")
    assert rows(kept.sizes(asked)) == [("n2", "ser", 7, 7), ("n3", "mon", 10, 10)]
    assert rows(kept.types()) == [("n1", "mon"), ("n2", "ser"), ("n3", "mon")]


def test_index_knows_what_is_stored(spark, frame, store, monkeypatch):
    monkeypatch.setattr(slices, "PER_SLOT", 50)
    monkeypatch.setattr(slices, "SLOTS_PER_FILE", 2)
    data = held(400) + held(300, "n2", "ser")
    sinks.write_store(frame(data, HELD), store)
    kept = Kept.of(spark, store)
    kept.indexed(frame(held(80, "n3"), HELD), kept.next_generation())
    asked = [(f"new-{i}",) for i in range(500)] + [(r[0],) for r in data[::3] + held(80, "n3")[::2]] * 2
    found = rows(kept.known(frame(asked, "uuid string")))
    # n3 is in the index only, its slice has no summary: nothing of it is in the store
    assert found == sorted((r[0], r[2], r[3]) for r in data[::3])
    maybe = kept.candidates(frame([(f"new-{i}",) for i in range(2000)], "uuid string"))
    assert maybe.count() < 40


def test_replaced_entries_do_not_count_and_segments_merge(spark, frame, store, monkeypatch):
    monkeypatch.setattr(slices, "MANY_SEGMENTS", 3)
    sinks.write_store(frame(held(100) + held(50, "n2"), HELD), store)
    kept = Kept.of(spark, store)
    for turn in range(1, 6):
        new = frame(held(20, "n2", first=turn * 100), HELD)
        generation = kept.next_generation()
        sinks.write_store(new, store)
        kept.replaced(new, generation)
        kept.indexed(new, generation)
        found = rows(kept.known(frame([(r[0],) for r in held(1000, "n2") + held(1000)], "uuid string")))
        assert found == sorted((r[0], r[2], r[3]) for r in held(20, "n2", first=turn * 100) + held(100))
    assert len(kept.segments()) <= 3


def test_known_opens_only_files_with_a_candidate(spark, frame, store, monkeypatch):
    monkeypatch.setattr(slices, "PER_SLOT", 20)
    monkeypatch.setattr(slices, "SLOTS_PER_FILE", 1)
    sinks.write_store(frame(held(1000), HELD), store)
    kept = Kept.of(spark, store)
    name, slots = kept.segments()[0]
    assert slots == 50
    plan = kept.known(frame([("n1-mon-7",), ("other",)], "uuid string"))
    scans = re.findall(r"Location: .*?PartitionFilters: \[(.*?)\]", plan._jdf.queryExecution().executedPlan().toString())
    assert any("file#" in s for s in scans)
    read = {f.split("/store")[1].split("/")[0] for f in plan.inputFiles() if "/store" in f}
    assert read == {"_uuids"}
    assert rows(plan) == [("n1-mon-7", "n1", "mon")]


def put(folder, name, lines, at):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as file:
        file.write("\n".join(["OCLC\tLOCAL_ID", *lines]) + "\n")
    os.utime(path, (at, at))


def deliveries(folder):
    """Files of two organisations in the order of arrival, with what becomes of them under limits of a half."""
    os.makedirs(folder)
    begin = time.time() - 1000

    def lines(n, first=1):
        return [f"{i}\tb{i}" for i in range(first, first + n)]

    sent = [
        ("a_mon_full_20240101.tsv", lines(100), load.SUPERSEDED),
        ("a_ser_full_20240101.tsv", lines(40), load.LOADED),         # same date as the first: a type of its own
        ("b_mix_full_20240105.tsv", lines(50), load.SUPERSEDED),
        ("a_mon_full_20240201.tsv", lines(10), load.TOO_BIG),        # against 100
        ("a_spm_full_20240201.tsv", lines(30), load.BAD_TYPE),
        ("a_mon_full_20240301.tsv", lines(120), load.SUPERSEDED),
        ("a_mon_full_20240215.tsv", lines(110), load.SUPERSEDED),    # older than the one before
        ("b_mix_full_20240106.tsv", lines(70, 900), load.LOADED),    # other OCNs, as many
        ("b_mix_full_20240107.tsv", ["x\ty"], load.NOTHING_READY),
        ("a_mon_full_20240401.tsv", lines(175), load.LOADED),        # against 120, not 100
        ("a_mon_full_20240501.tsv", lines(40), load.TOO_BIG),
        ("a_mon_full_20240601.tsv", [], load.NO_DATA),
        ("A_mon_full_20240601.tsv", lines(5), load.BAD_NAME),
    ]
    for i, (name, text, _) in enumerate(sent):
        put(folder, name, text, begin + 10 * i)
    return {name: outcome for name, _, outcome in sent}


@pytest.mark.parametrize("at_once", [2, 100])
def test_gates_hold_however_files_are_cut_into_batches(spark, tmp_path, store, at_once):
    expected = deliveries(str(tmp_path / "in"))
    stream = ingest.submission_stream(spark, str(tmp_path / "in"), at_once)
    ingest.scrub_and_replace(stream, store, str(tmp_path / "ledger"), str(tmp_path / "staging"),
                             str(tmp_path / "checkpoint"), "2024-07-01", 10**9, load.Limits(0.5, 0.75)).awaitTermination()
    outcomes = load.settled(spark.read.parquet(f"{tmp_path}/staging/batch=*/outcomes"))
    assert {r["file_name"]: r["outcome"] for r in outcomes.collect()} == expected
    in_store = spark.read.parquet(store).groupBy("organization", "mono_multi_serial").agg(
        F.count("*"), F.count_distinct("ocn"))
    assert rows(in_store) == [("a", "mon", 175, 175), ("a", "ser", 40, 40), ("b", "mix", 70, 70)]
    assert rows(slices.sizes(Kept.of(spark, store).summary())) == rows(in_store)


def test_load_reads_the_replaced_slices_only(spark, frame, store):
    data = [r for i in range(12) for r in held(5, f"n{i}")]
    sinks.write_store(frame(data, HELD), store)
    wanted = frame([("n3", "mon"), ("n5", "mon")], "organization string, mono_multi_serial string")
    plan = load.slices_of(spark.read.parquet(store), wanted)
    assert plan.count() == 10
    assert "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString()


def test_stream_into_a_filled_store(spark, frame, tmp_path, store):
    """Several batches, each repeating rows of the store, of itself and of earlier ones."""
    schema = "uuid string, ocn long, organization string, mono_multi_serial string, local_id string"
    sinks.write_store(frame(held(200) + held(30, "n2"), schema), store)
    os.makedirs(tmp_path / "in")
    dice = random.Random(4)
    every = held(600) + held(60, "n2") + held(40, "n3")
    for i in range(5):
        frame(dice.choices(every, k=250), schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    ingest.insert_new(stream, store, str(tmp_path / "checkpoint")).awaitTermination()
    arrived = spark.read.schema(schema).json(str(tmp_path / "in"))
    expected = {r[0] for r in arrived.select("uuid").collect()} | {r[0] for r in held(200) + held(30, "n2")}
    stored = spark.read.parquet(store)
    assert stored.count() == len(expected) and {r[0] for r in stored.select("uuid").collect()} == expected
    assert rows(slices.sizes(Kept.of(spark, store).summary())) == rows(
        stored.groupBy("organization", "mono_multi_serial").agg(F.count("*"), F.count_distinct("ocn")))


def test_replayed_batch_adds_nothing_twice(spark, frame, tmp_path, store):
    """A batch that fails after the store was written is run again."""
    schema = "uuid string, ocn long, organization string, mono_multi_serial string, local_id string"
    os.makedirs(tmp_path / "in")
    frame(held(50) + held(20, "n2"), schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    good, broken = Kept.appended, []

    def fails(self, *args):
        broken.append(1)
        raise RuntimeError("lost")

    Kept.appended = fails
    try:
        with pytest.raises(Exception, match="lost"):
            ingest.insert_new(stream, store, str(tmp_path / "checkpoint")).awaitTermination()
    finally:
        Kept.appended = good
    assert broken and spark.read.parquet(store).count() == 70
    ingest.insert_new(stream, store, str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.parquet(store).count() == 70
    kept = Kept.of(spark, store)
    assert rows(slices.sizes(kept.summary())) == [("n1", "mon", 50, 50), ("n2", "mon", 20, 20)]
    assert kept.known(spark.read.parquet(store)).count() == 70


def test_filters_are_those_of_the_uuids(spark, frame, store):
    data = held(6000) + held(10, "n2") + held(10, "n2")
    sinks.write_store(frame(data, HELD), store)
    kept = Kept.of(spark, store)
    (name, slots), = kept.segments()
    want = (frame(data, HELD).select(slices._slot(F.lit(slots)).alias("slot"), F.explode(slices._probes()).alias("bit"))
            .groupBy("slot").agg(F.bitmap_construct_agg("bit").alias("bits")))
    assert rows(spark.read.parquet(f"{store}_uuids/filters/{name}").select("slot", "bits")) == rows(want)


def test_many_uuids_are_looked_up_without_filters(spark, frame, store, monkeypatch):
    data = held(3000) + held(300, "n2", "ser")
    sinks.write_store(frame(data, HELD), store)
    kept = Kept.of(spark, store)
    asked = frame([(f"new-{i}",) for i in range(500)] + [(r[0],) for r in data[::3]] * 2 + [(None,)], "uuid string")
    want = sorted((r[0], r[2], r[3]) for r in data[::3])
    monkeypatch.setattr(slices, "ONE_PASSES", 10 ** 9)
    assert rows(kept.known(asked)) == want
    monkeypatch.setattr(slices, "ONE_PASSES", 1)
    monkeypatch.setattr(Kept, "candidates", lambda *a: 1 / 0)
    assert rows(kept.known(asked)) == want


def test_files_are_judged_from_one_pass_over_lines_and_holdings(spark, frame):
    """What judging goes on with is counted already: its plan reads neither lines nor holdings again."""
    lines = frame([("org-a_mon_full_20240101.tsv",)] * 3, "file_name string")
    ready = frame([("org-a_mon_full_20240101.tsv", 1)], "file_name string, ocn long")
    none = [frame([], s) for s in ("organization string, mono_multi_serial string, loaded_lines long, loaded_ocns long",
                                   "organization string, mono_multi_serial string", "organization string, first date",
                                   load.LEDGER)]
    judged = load.judge_files(lines.distinct(), lines, ready, *none)
    assert rows(judged, "ready_lines", "outcome") == [(1, load.LOADED)]
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "count(distinct" not in plan and "counted-" in "".join(judged.inputFiles())


def test_scrubbed_holdings_are_read_without_a_join(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.sql("SELECT 'f' file_name, 'u' uuid, 7L ocn, 'v.3' enum_chron, true gov_doc_flag").write.json(path)
    found = load.scrubbed_holdings(spark, path)
    assert rows(found, "file_name", "uuid", "ocn", "n_enum", "gov_doc_flag") == [("f", "u", 7, "3", True)]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_appended_rows_do_not_become_a_file_of_each_task(spark, frame, store):
    data = [row for n in range(6) for row in held(40, f"n{n}")]
    many = str(store) + "_rows"
    frame(data, HELD).repartition(12).write.option("maxRecordsPerFile", 20).parquet(many)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        new = spark.read.parquet(many)
        assert new.rdd.getNumPartitions() > 6
        sinks.append_store(new, store)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    back = spark.read.parquet(store)
    assert rows(back, "uuid", "ocn", "organization") == sorted((r[0], r[1], r[2]) for r in data)
    assert len(back.inputFiles()) <= 2 * 6 + 8  # six slices, of which a range may cut some


def test_uuids_are_not_copied_where_all_entries_are_read(spark, frame, store, monkeypatch):
    monkeypatch.setattr(slices, "PER_SLOT", 50)
    monkeypatch.setattr(slices, "ONE_PASSES", 1)
    sinks.write_store(frame(held(400), HELD), store)
    kept, made = Kept.of(spark, store), []
    monkeypatch.setattr(slices, "materialize", lambda df, name="part": made.append(name) or df)
    asked = frame([r[:1] for r in held(40, first=380)] * 2, "uuid string")
    assert rows(kept.known(asked), "uuid") == [(f"n1-mon-{i}",) for i in range(380, 400)]
    assert "asked" not in made


def test_load_reads_its_scrubbed_copy_once(spark, frame, store, tmp_path, monkeypatch):
    """Holdings are counted as they were judged, and those that are loaded go on from a copy in columns."""
    read, judged, scrubbed_holdings, judge_files = [], [], load.scrubbed_holdings, load.judge_files
    monkeypatch.setattr(load, "scrubbed_holdings", lambda *a: read.append(a) or scrubbed_holdings(*a))
    monkeypatch.setattr(load, "judge_files", lambda files, lines, ready, *a: judged.append(
        lines.inputFiles() + ready.inputFiles()) or judge_files(files, lines, ready, *a))
    name = "org_mon_full_20240101.tsv"
    lines = frame([(name, "1\tb1"), (name, "2,3\tb2"), (name, "x\tb3")], "file_name string, value string")
    done = load.load_files(spark, lines.select("file_name").distinct(), load.Submissions(lines, frame(
        [(name, "oclc\tlocal_id")], "file_name string, header string")), store, f"{store}_ledger", str(tmp_path / "work"),
        "2024-01-01", 10**9)
    assert rows(done, "outcome", "ready_lines", "ready_ocns") == [("loaded", 3, 3)] and len(read) == 1
    assert judged[0] and all("/judged-" in path for path in judged[0])
