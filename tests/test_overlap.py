import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfcount.operators import formats
from shelfcount.operators.overlap import (cluster_org_counts, count_by_enum, count_by_org, h_shares,
                                          member_counts, overlap, prepare, unmatched_organizations)


@pytest.fixture
def ocns(frame):
    return lambda *pairs: frame(list(pairs), "cluster_id string, ocn long")


def counts(df, org, item):
    found = df.filter((F.col("organization") == org) & (F.col("item_id") == item)).collect()
    return found[0] if found else None


@pytest.fixture
def volumes(items):
    return items(("r", "i1", 1, "BK", "1", "ic", "dep"), ("r", "i3", 1, "BK", "3", "ic", "dep"))


@pytest.mark.parametrize("enums, expected", [
    (["1"], 1),                 # equal
    ([""], 1),                  # blank
    ([None], 1),
    (["v.99", "v.98"], 2),      # no match anywhere in the cluster: all count
    (["1863", "1865"], 2),      # years leave the enumeration blank
    (["v.3", "v.5"], 0),        # matches another volume
    (["v.3", ""], 1),           # the blank one still counts
])
def test_multi_part_matching(volumes, ocns, holdings, enums, expected):
    result = overlap(volumes, ocns(("r", 1)), holdings(*[(1, "n1", e) for e in enums]))
    row = counts(result, "n1", "i1")
    assert (row["copy_count"] if row else 0) == expected


def test_no_match_when_item_is_blank_and_holding_is_not(items, ocns, holdings):
    both = items(("r", "i0", 1, "BK", ""), ("r", "i1", 1, "BK", "1"))
    result = overlap(both, ocns(("r", 1)), holdings((1, "n1", "1")))
    assert counts(result, "n1", "i0") is None
    assert counts(result, "n1", "i1")["copy_count"] == 1


def test_multi_part_states(volumes, ocns, holdings):
    result = overlap(volumes, ocns(("r", 1)), holdings(
        (1, "n1", "1", "LM"), (1, "n1", "1", "WD", "BRT"), (1, "n1", "1", "CH", "BRT"), (1, "n1", "3")))
    row = counts(result, "n1", "i1")
    assert [row[c] for c in ("copy_count", "lm_count", "wd_count", "brt_count", "access_count",
                             "current_holding_count")] == [3, 1, 1, 2, 3, 1]


def test_depositor(volumes, ocns, holdings):
    result = overlap(volumes, ocns(("r", 1)), holdings((1, "dep", "3")))
    assert counts(result, "dep", "i1")["deposited_only"] is True
    assert counts(result, "dep", "i1")["copy_count"] == 1
    assert counts(result, "dep", "i3")["deposited_only"] is False
    alone = overlap(volumes, ocns(("r", 1)), holdings((7, "n1", "3")))
    assert [r[0] for r in rows(alone, "organization")] == ["dep", "dep"]


def test_depositor_without_billing_entity_makes_no_row(items, ocns, holdings):
    result = overlap(items(("r", "i1", 1, "BK", "")), ocns(("r", 1)), holdings((1, None)))
    assert result.count() == 0


def test_serial_is_cut_to_one(items, ocns, holdings):
    serial = items(("r", "s", 1, "SE", "v.1", "ic", "dep"))
    result = overlap(serial, ocns(("r", 1)), holdings(
        (1, "n1", "", "LM", "BRT"), (1, "n1", "", "CH", "BRT"), (1, "n1", "", "WD")))
    row = counts(result, "n1", "s")
    assert [row[c] for c in ("copy_count", "current_holding_count", "brt_count", "wd_count", "lm_count",
                             "access_count")] == [1, 1, 0, 0, 0, 0]
    assert (row["current_brittle"], row["current_not_brittle"]) == (1, 0)
    assert counts(result, "dep", "s")["copy_count"] == 1


def test_mixed_serial_and_single_uses_single_rule(items, ocns, holdings):
    mixed = items(("r", "s", 1, "SE", ""), ("r", "b", 2, "BK", ""))
    result = overlap(mixed, ocns(("r", 1)), holdings((1, "n1"), (1, "n1")))
    assert rows(result, "item_id", "cluster_format", "copy_count") == [
        ("b", "ser/spm", 2), ("s", "ser/spm", 2)]


@pytest.mark.parametrize("given, expected", [
    ([("i", 1, "BK", "1999")], {"i": "spm"}),
    ([("i", 1, "BK", "v.1")], {"i": "mpm"}),
    ([("i", 1, "BK", ""), ("j", 1, "BK", "v.1")], {"i": "mpm", "j": "mpm"}),
    ([("i", 1, "BK", ""), ("j", 2, "BK", "v.1")], {"i": "spm", "j": "mpm"}),
    ([("i", 1, "SE", "v.1"), ("j", 2, "XX", "")], {"i": "ser", "j": "spm"}),
])
def test_item_formats(items, given, expected):
    found = formats.with_formats(items(*[("r", *g) for g in given]))
    assert dict(rows(found, "item_id", "item_format")) == expected


@pytest.mark.parametrize("given, expected", [
    ([("i", 1, "SE", "v.1")], "ser"),
    ([("i", 1, "BK", "")], "spm"),
    ([("i", 1, "BK", "v.1"), ("j", 2, "SE", "")], "mpm"),
    ([("i", 1, "BK", ""), ("j", 2, "SE", "")], "ser/spm"),
])
def test_cluster_formats(items, given, expected):
    found = formats.with_formats(items(*[("r", *g) for g in given]))
    assert {r[0] for r in rows(found, "cluster_format")} == {expected}


def test_members_and_shares(items, ocns, holdings, organizations):
    held = holdings((1, "n1"), (1, "n1"), (1, "n2"), (1, "guest"))
    result = overlap(items(("r", "i", 1, "BK", "", "ic", "n3")), ocns(("r", 1)), held)
    assert rows(result, "organization") == [("guest",), ("n1",), ("n2",), ("n3",)]
    assert rows(member_counts(result, organizations)) == [("i", 3)]
    shares = dict(rows(h_shares(result, organizations), "organization", "h_share"))
    assert shares == {"guest": 0.0, "n1": pytest.approx(1 / 3), "n2": pytest.approx(1 / 3),
                      "n3": pytest.approx(1 / 3)}


def test_holding_in_several_records_counts_in_each(items, ocns, holdings):
    two = items(("a", "i", 1, "BK", ""), ("b", "j", 2, "BK", ""))
    result = overlap(two, ocns(("a", 5), ("b", 5), ("b", 6)), holdings((5, "n1"), (6, "n1")))
    assert rows(result, "item_id", "copy_count") == [("i", 1), ("j", 2)]


def _brute_force(item_rows, ocn_rows, holding_rows):
    """The rules, pair by pair."""
    clusters = {}
    for i in item_rows:
        clusters.setdefault(i["cluster_id"], []).append(i)
    out = {}
    for cid, members in clusters.items():
        mine = {o for c, o in ocn_rows if c == cid}
        held = [h for h in holding_rows if h["ocn"] in mine]
        kinds = set()
        for i in members:
            same = [x for x in members if x["bib_key"] == i["bib_key"]]
            kinds.add("ser" if i["bib_fmt"] == "SE" else
                      "mpm" if any(x["n_enum"] for x in same) else "spm")
        kind = ("mpm" if "mpm" in kinds else "ser/spm" if kinds == {"ser", "spm"} else
                "ser" if "ser" in kinds else "spm")
        enums = {i["n_enum"] for i in members}
        strays = {o for o in {h["organization"] for h in held}
                  if not enums & {h["n_enum"] for h in held if h["organization"] == o}}
        for i in members:
            for org in {h["organization"] for h in held} | {i["billing_entity"]}:
                n = sum(1 for h in held if h["organization"] == org and (
                    kind != "mpm" or h["n_enum"] in ("", i["n_enum"]) or org in strays))
                n = min(n, 1) if kind == "ser" else n
                if n or org == i["billing_entity"]:
                    out[i["item_id"], org] = (max(n, 1), n == 0)
    return out


@pytest.mark.parametrize("per_key", [10_000, 3])
def test_random_clusters_against_brute_force(items, ocns, holdings, monkeypatch, per_key):
    import random
    from shelfcount.operators import overlap as module
    monkeypatch.setattr(module, "ITEMS_PER_KEY", per_key)      # 3: clusters fall under several salts
    rng = random.Random(7)
    # one OCN holds more than a third of all holdings
    item_rows = [(f"r{rng.randrange(12)}", f"i{n}", rng.randrange(15), rng.choice(["BK", "BK", "SE"]),
                  rng.choice(["", "v.1", "v.2", "v.3"]), "ic", f"n{rng.randrange(6)}") for n in range(60)]
    pairs = sorted({(f"r{rng.randrange(12)}", rng.choice([1, 1, rng.randrange(2, 20)])) for _ in range(40)})
    held = [(rng.choice([1, rng.randrange(1, 25)]), f"n{rng.randrange(8)}",
             rng.choice(["", "v.1", "v.2", "v.9"])) for _ in range(300)]
    i, h = items(*item_rows), holdings(*held)
    result = overlap(i, ocns(*pairs), h.repartition(7))
    got = {(r["item_id"], r["organization"]): (r["copy_count"], r["deposited_only"]) for r in result.collect()}
    assert got == _brute_force([r.asDict() for r in i.collect()], pairs, [r.asDict() for r in h.collect()])


def test_row_order_and_partitions_do_not_matter(items, ocns, holdings):
    i = items(*[("r", f"i{n}", n % 3, "BK", f"v.{n}") for n in range(9)])
    h = holdings(*[(n % 4, f"n{n % 3}", f"v.{n % 5}") for n in range(40)])
    pairs = ocns(("r", 0), ("r", 1), ("r", 2))
    first = rows(overlap(i, pairs, h))
    assert first == rows(overlap(i.orderBy(F.rand(1)).repartition(5), pairs.repartition(3),
                                 h.orderBy(F.rand(2)).coalesce(1)))


def test_state_counts_per_cluster(ocns, holdings):
    by_org = count_by_org(count_by_enum(holdings((1, "n1", "", "CH"), (2, "n1", "", "WD", "BRT"), (2, "n2", "v.1", "LM"))))
    found = cluster_org_counts(ocns(("r", 1), ("r", 2)), by_org)
    assert rows(found, "organization", "n", "cur", "brt", "wd", "lm", "access") == [
        ("n1", 2, 1, 1, 1, 0, 1), ("n2", 1, 0, 0, 0, 1, 1)]


def test_organizations_without_match(items, ocns, holdings):
    parts = prepare(items(("r", "i", 1, "BK", "v.1"), ("r", "j", 1, "BK", "")), ocns(("r", 1)),
                    holdings((1, "n1", "v.1"), (1, "n2", "v.9"), (1, "n3", "")))
    assert rows(unmatched_organizations(parts)) == [("r", "n2")]


def test_no_cross_join_in_the_plan(items, ocns, holdings):
    result = overlap(items(("r", "i", 1, "BK", "v.1")), ocns(("r", 1)), holdings((1, "n1", "v.1")))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_members_are_counted_where_the_rows_already_are(items, ocns, holdings, organizations):
    """One shuffle by item serves both the sums and the window."""
    from shelfcount.operators.overlap import with_member_counts
    result = with_member_counts(
        overlap(items(("r", "i", 1, "BK", "v.1")), ocns(("r", 1)), holdings((1, "n1", "v.1"))), organizations)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(item_id") == 1


def test_rights_filter_reaches_the_item_scan(items, ocns, holdings):
    from shelfcount.functions.rights import is_ic
    result = overlap(items(("r", "i", 1, "BK", "v.1")), ocns(("r", 1)), holdings((1, "n1", "v.1")))
    plan = result.filter(is_ic("rights"))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "rights" in line]
    assert scans and all("In(rights" in line for line in scans)
