import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfcount.operators import frequency
from shelfcount.operators.counts import item_counts
from shelfcount.plans import cost, estimate
from shelfcount.sources import files, sinks

TABLE = "organization string, format string, bucket long, frequency long"


@pytest.fixture
def library(items, frame, holdings):
    """A journal, two single volumes, a set of two, and two volumes in the public domain."""
    parts = items(
        ("j", "t.j", 10, "SE", "", "ic", "n2", [11]),
        ("s", "t.s", 20, "BK", "", "ic", "n3", [21]),
        ("u", "t.u", 21, "BK", "", "und", "n1", [22]),
        ("m", "t.m1", 30, "BK", "v.1", "ic", "n4", [31]),
        ("m", "t.m2", 30, "BK", "v.2", "op", "n4", [31]),
        ("p", "t.p", 40, "BK", "", "pd", "n1", [41]),
        ("q", "t.q", 41, "BK", "", "pdus", "n6", [42]))
    ocns = frame([("j", 11), ("s", 21), ("u", 22), ("m", 31), ("p", 41), ("q", 42)], "cluster_id string, ocn long")
    held = holdings((11, "n1"), (11, "n1"), (21, "n6"), (22, "n1"), (31, "n5", "v.1"), (31, "n6", ""), (42, "n2"))
    return parts, ocns, held


def test_all_together(library, organizations):
    """A volume costs 14 / 7 = 2. Shares: t.j n1, n2 1/2; t.s n3, n6 1/2; t.u n1 1; t.m1 n4, n5, n6 1/3; t.m2
    n4, n6 1/2, as n5 has another volume. Public domain: 2 * 2 over a weight of 8."""
    report = cost.cost_report(*library, organizations, 14, "central")
    found = {r["member_id"]: r for r in report.by_member.collect()}
    expected = {"n1": 2 + 1 + .5, "n2": 1 + .5, "n3": 1 + .5, "n4": 5 / 3 + .5, "n5": 2 / 3 + .5,
                "n6": 1 + 5 / 3 + 1.5, "central": 0}
    assert {k: r["total"] for k, r in found.items()} == pytest.approx(expected)
    assert [found["n6"][c] for c in ("spm", "mpm", "ser", "pd", "weight", "extra")] == pytest.approx(
        [1, 5 / 3, 0, 1.5, 3, 0])
    facts = report.summary.first()
    assert (facts["num_volumes"], facts["num_pd_volumes"], facts["num_members"]) == (7, 2, 7)
    assert (facts["cost_per_volume"], facts["total_weight"], facts["pd_cost"]) == (2.0, 8.0, 4.0)
    assert rows(report.frequency) == [
        ("n1", "ser", 2, 1), ("n1", "spm", 1, 1), ("n2", "ser", 2, 1), ("n3", "spm", 2, 1), ("n4", "mpm", 2, 1),
        ("n4", "mpm", 3, 1), ("n5", "mpm", 3, 1), ("n6", "mpm", 2, 1), ("n6", "mpm", 3, 1), ("n6", "spm", 2, 1)]
    assert cost.as_text(report).first()["value"] == "Target cost: 14.0"


def test_costs_add_up(library, organizations):
    report = cost.cost_report(*library, organizations, 14, "central")
    paid = report.by_member.agg(F.sum(F.col("total") - F.col("extra"))).first()[0]
    assert paid == pytest.approx(14)


def test_one_organization_only(library, organizations):
    report = cost.cost_report(*library, organizations, 5, "central", organization="n6")
    assert rows(report.by_member, "member_id") == [("n6",)]


def test_hscores(frame):
    table = frame([("a", "mpm", 3, 1), ("a", "spm", 1, 5), ("a", "spm", 2, 3), ("b", "ser", 1, 2), ("b", "ser", 2, 1)], TABLE)
    scores = {r["organization"]: r["total"] for r in frequency.hscores(table).collect()}
    assert scores == {"a": pytest.approx(5 + 3 / 2 + 1 / 3), "b": pytest.approx(2.5)}


def test_extra_is_spread_and_added_to_every_row(frame, organizations):
    table = frame([("central", "spm", 1, 1)], TABLE)
    counts = frame([(3, 2, 1)], "n_items long, n_ic long, n_pd long")
    report = cost.from_frequencies(table, counts, organizations, 10, "central")
    found = {r["member_id"]: r for r in report.by_member.collect()}
    assert found["n1"]["extra"] == pytest.approx(10 / 3 / 6)
    assert found["central"]["total"] == pytest.approx(10 / 3 + 10 / 3 / 6)


def test_nothing_to_divide_by_gives_missing_values(frame, organizations):
    counts = frame([(0, 0, 0)], "n_items long, n_ic long, n_pd long")
    nobody = organizations.filter("inst_id in ('central', 'guest')")
    report = cost.from_frequencies(frame([], TABLE), counts, nobody, 10, "central")
    assert rows(report.by_member, "member_id", "pd", "extra") == [("central", None, None)]


def test_icus_counts_as_public_domain(items):
    found = item_counts(items(("r", "a", 1, "BK", "", "icus"), ("r", "b", 1, "BK", "", "pd-pvt"))).first()
    assert tuple(found) == (2, 1, 1)


def test_merge_equals_whole_and_survives_json(frame, spark, tmp_path):
    a = frame([("a", "spm", 1, 2), ("a", "spm", 12, 1)], TABLE)
    b = frame([("a", "spm", 1, 3), ("b", "ser", 2, 1)], TABLE)
    expected = [("a", "spm", 1, 5), ("a", "spm", 12, 1), ("b", "ser", 2, 1)]
    assert rows(frequency.merge(a, b)) == expected
    for name, table in (("x", a), ("y", b)):
        sinks.write_frequency_json(frequency.as_json(table), str(tmp_path / name))
    text = frequency.as_json(b).first()["value"]
    assert json.loads(text) == {"a": {"spm": {"1": 3}}, "b": {"ser": {"2": 1}}}
    folder = tmp_path / "all"
    folder.mkdir()
    (folder / "a.json").write_text(frequency.as_json(a).first()["value"])
    (folder / "b.json").write_text(json.dumps(json.loads(text), indent=1))
    assert rows(frequency.merge(files.read_frequency_json(spark, directory=str(folder)))) == expected
    assert rows(files.read_frequency_json(spark, file=str(folder / "b.json"))) == rows(b)
    with pytest.raises(ValueError):
        files.read_frequency_json(spark, "a", "b")
    with pytest.raises(ValueError):
        files.read_frequency_json(spark)


def test_lookup(frame):
    table = frame([("b", "spm", 2, 1), ("a", "spm", 12, 1), ("a", "spm", 2, 4)], TABLE)
    assert [tuple(r) for r in frequency.lookup(table, "a", "spm").collect()] == [(2, 4), (12, 1)]
    assert frequency.lookup(table, "x", "spm").count() == 0
    assert [r[0] for r in frequency.organizations_of(table).collect()] == ["a", "b"]


def test_estimate(items, frame, holdings, organizations):
    """Three of five numbers hit three of four items; shares 1/2 and 1/4 of an item that costs 32 / 4 = 8."""
    four = items(("a", "t.a", 1, "BK", "", "ic", "n1", [61]), ("b", "t.b", 2, "BK", "", "pd", "n1", [62]),
                 ("c", "t.c", 3, "SE", "", "ic", "n2", [63]), ("d", "t.d", 4, "BK", "", "ic", "n2", [99]))
    ocns = frame([("a", 61), ("b", 62), ("c", 63), ("d", 99)], "cluster_id string, ocn long")
    held = holdings((63, "n3"), (63, "n4"), (99, "n3"), (7, "n5"))
    wanted = frame([(61,), (62,), (63,), (70,), (71,), (70,)], "ocn long")
    row = estimate.estimate(wanted, four, ocns, held, organizations, 32)
    assert row.first()["h_share"] == 0.75
    lines = [r["value"] for r in estimate.as_text(row, "Our shelves").collect()]
    assert lines[0].endswith("$6.00") and " 5 distinct " in lines[1] and " 3 (60.0%) " in lines[2]
    assert lines[3] == "Our shelves, corresponding to 3 Our shelves items."
    assert " 1 (33.3%) " in lines[4] and lines[5].startswith("2 (66.7%) ")


def test_only_holdings_near_the_clusters_are_counted(items, frame, holdings, organizations):
    """Holdings are cut down to the asked clusters' numbers before they are grouped."""
    from shelfcount.operators import overlap

    one = items(("a", "t.a", 1, "BK", "", "ic", "n1", [61]))
    ocns = frame([("a", 61)], "cluster_id string, ocn long")
    plan = overlap.count_by_enum(overlap.near(holdings((61, "n3"), (7, "n5")), ocns))
    assert "LeftSemi" in plan._jdf.queryExecution().optimizedPlan().toString()
    parts = overlap.prepare(one, ocns, holdings((61, "n3"), (7, "n5")), narrowed=True)
    assert rows(parts.by_enum, "ocn", "organization") == [(61, "n3")]


def test_numbers_beyond_the_stored_range_have_no_holder(items, frame, holdings):
    from shelfcount.operators import overlap

    far = 2**31 + 5
    one = items(("a", "t.a", 1, "BK", "", "ic", "n1", [far]))
    found = overlap.overlap(one, frame([("a", far)], "cluster_id string, ocn long"), holdings((far, "n3")))
    assert rows(found, "organization") == [("n1",)]            # the depositor alone
