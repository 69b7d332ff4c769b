import random

import pytest

from conftest import rows
from shelfcount.operators import clusters

PAIRS = "variant long, canonical long"
BRIDGE = "ocn long, item_id string"


@pytest.mark.parametrize("seed, bridge, concordance, expected", [
    ([1], [], [], {1}),
    ([1, 2], [], [], {1, 2}),
    ([1], [(1, "i"), (2, "i")], [], {1, 2}),
    ([1], [], [(1, 2)], {1, 2}),
    ([2], [], [(1, 2)], {1, 2}),
    ([2], [(1, "i"), (2, "i")], [(3, 2)], {1, 2, 3}),
    ([3], [(1, "i"), (2, "i")], [(2, 3)], {1, 2, 3}),
    ([1], [(1, "i"), (2, "i")], [(2, 3)], {1, 2, 3}),
    # three steps, not a closure: item j is beyond reach
    ([1], [(1, "i"), (2, "i"), (3, "j"), (4, "j")], [(2, 5), (3, 5)], {1, 2, 3, 5}),
])
def test_growth(frame, seed, bridge, concordance, expected):
    b, c = frame(bridge, BRIDGE), frame(concordance, PAIRS)
    home, ocns = clusters.ocn_clusters(frame([("s", o) for o in seed], "seed string, ocn long"), b, c)
    assert {r[0] for r in rows(home.join(ocns, "cluster_id"), "ocn")} == expected
    keys = frame([(1, o) for o in seed], "key long, ocn long")
    assert {r[1] for r in rows(clusters.expand_ocns(keys, b, c))} == expected


def _grow(seed, bridge, concordance):
    def concord(s):
        tops = {c for v, c in concordance if v in s or c in s}
        return s | {o for v, c in concordance if c in tops for o in (v, c)}

    first = concord(set(seed))
    on = {i for o, i in bridge if o in first}
    return concord(first | {o for o, i in bridge if i in on})


@pytest.mark.parametrize("hot", [False, True])
def test_random_against_brute_force(frame, hot):
    rng = random.Random(11 + hot)
    bridge = sorted({(1 if hot and rng.random() < .4 else rng.randrange(40), f"i{rng.randrange(30)}")
                     for _ in range(70)})
    concordance = sorted({(rng.randrange(40), rng.randrange(40)) for _ in range(25)})
    seeds = {f"s{n}": {rng.randrange(40) for _ in range(rng.randrange(1, 4))} for n in range(25)}
    for item in {i for _, i in bridge}:
        seeds[item] = {o for o, i in bridge if i == item}
    given = frame([(s, o) for s, os in seeds.items() for o in os], "seed string, ocn long")
    home, ocns = clusters.ocn_clusters(given, frame(bridge, BRIDGE), frame(concordance, PAIRS))
    got = {}
    for seed, ocn in rows(home.join(ocns, "cluster_id"), "seed", "ocn"):
        got.setdefault(seed, set()).add(ocn)
    assert got == {s: _grow(os, bridge, concordance) for s, os in seeds.items()}


def test_items_sharing_a_hot_ocn_share_one_cluster(frame):
    """Each item has the hot OCN and one of its own: one cluster, not one per item."""
    n = 50
    bridge = [(1, f"i{k}") for k in range(n)] + [(100 + k, f"i{k}") for k in range(n)]
    seeds = frame([(f"s{k}", o) for k in range(n) for o in (1, 100 + k)], "seed string, ocn long")
    home, ocns = clusters.ocn_clusters(seeds, frame(bridge, BRIDGE), frame([], PAIRS))
    assert home.select("cluster_id").distinct().count() == 1
    assert ocns.count() == n + 1


def test_variants_of_a_hot_canonical_share_one_cluster(frame):
    n = 50
    pairs = [(100 + k, 1) for k in range(n)]
    seeds = frame([(f"s{k}", 100 + k) for k in range(n)], "seed string, ocn long")
    home, ocns = clusters.ocn_clusters(seeds, frame([], BRIDGE), frame(pairs, PAIRS))
    assert (home.select("cluster_id").distinct().count(), ocns.count()) == (1, n + 1)


def test_item_clusters(items, frame):
    given = items(("-", "a", 1, "BK", "", "ic", None, [1, 2]), ("-", "b", 2, "BK", "", "ic", None, [2]),
                  ("-", "c", 3, "BK", "")).drop("cluster_id")
    none = given.withColumn("ocns", __import__("pyspark").sql.functions.expr(
        "if(item_id = 'c', cast(array() as array<bigint>), ocns)"))
    placed, ocns = clusters.item_clusters(none, frame([], PAIRS))
    homes = placed.filter("home")
    assert rows(homes, "item_id") == [("a",), ("b",), ("c",)]
    # b alone reaches 1 through a; both see both items
    assert placed.filter("not home").count() == 2 or homes.select("cluster_id").distinct().count() == 2
    assert rows(homes.filter("item_id = 'c'"), "cluster_id") == [("bib:3",)]
    assert ocns.filter("cluster_id = 'bib:3'").count() == 0


def test_resolutions_items_and_empty(frame):
    members = frame([("x", 1), ("y", 9)], "cluster_id string, ocn long")
    pairs, bridge = frame([(1, 2), (3, 1), (4, 5)], PAIRS), frame([(1, "i"), (1, "j")], BRIDGE)
    held = frame([(7, "n1")], "ocn long, organization string")
    assert rows(clusters.cluster_resolutions(members, pairs)) == [("x", 1, 2), ("x", 3, 1)]
    assert rows(clusters.cluster_items(members, bridge)) == [("x", "i"), ("x", "j")]
    assert rows(clusters.empty_clusters(members, bridge, pairs, held)) == [("y",)]
