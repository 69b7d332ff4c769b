"""Incremental frequencies, transitive clusters and exact splits against plain Python."""

import random
from collections import Counter

from conftest import rows
from pyspark.sql import functions as F

from shelfcount.operators import clusters, frequency, overlap
from shelfcount.plans import cost, incremental
from shelfcount.sources import sinks


def test_only_changed_ocns_propagate(holdings):
    before = holdings((1, "n1"), (1, "n1"), (2, "n1"), (3, "n2", "v.1", "CH"), (9, "n1"))
    after = holdings((1, "n1"), (1, "n1"), (2, "n1", "v.2"), (3, "n2", "v.1", "LM"), (4, "n1"))
    assert rows(incremental.changed_ocns(before, before.withColumn("uuid", F.lit("other")))) == []
    assert rows(incremental.changed_ocns(before, after)) == [(2,), (3,), (4,), (9,)]
    assert rows(incremental.changed_ocns(before.limit(0), after)) == [(1,), (2,), (3,), (4,)]


def test_table_after_a_load_equals_the_whole_one(holdings, items, organizations, frame):
    own = items(*[(f"c{i}", f"i{i}", i, "BK", "v.1" if i % 3 == 0 else "", "ic" if i % 4 else "pd", "n1")
                  for i in range(12)])
    ocns = frame([(f"c{i}", i) for i in range(12)] + [("c5", 6), ("c7", 100)], "cluster_id string, ocn long")
    dice = random.Random(2)

    def some(n):
        return [(dice.randrange(14), dice.choice(["n1", "n2", "n3"]), dice.choice(["", "v.1", "v.2"])) for _ in range(n)]

    stay, gone, come = some(15), some(8), some(9)
    before, after = holdings(*stay, *gone), holdings(*stay, *come)
    table = cost.ic_frequencies(own, ocns, before, organizations)
    change = incremental.frequency_change(own, ocns, before, after, incremental.changed_ocns(
        holdings(*gone), holdings(*come)), organizations)
    assert rows(incremental.updated(table, change), *frequency.KEYS, "frequency") == rows(
        cost.ic_frequencies(own, ocns, after, organizations), *frequency.KEYS, "frequency")
    touched = incremental.touched_clusters(incremental.changed_ocns(holdings((6, "n1")), holdings((6, "n2"))), ocns)
    assert rows(touched) == [("c5",), ("c6",)]
    assert overlap.COUNTERS


def test_transitive_clusters(frame):
    dice = random.Random(1)
    bridge = [(f"i{i}", dice.randrange(60)) for i in range(25) for _ in range(dice.randrange(1, 3))]
    pairs = [(dice.randrange(60, 80), dice.randrange(60)) for _ in range(12)] + [(90, 91), (95, 95)]
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for item in {i for i, _ in bridge}:
        own = [o for i, o in bridge if i == item]
        for o in own:
            parent[find(max(find(o), find(own[0])))] = min(find(o), find(own[0]))
    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    expected = sorted((o, find(o)) for o in list(parent))
    found = clusters.transitive_clusters(frame(bridge, "item_id string, ocn long").distinct(),
                                         frame(pairs, "variant long, canonical long"))
    assert rows(found) == expected


def test_parts_differ_by_less_than_the_largest_ocn(frame):
    dice = random.Random(6)
    data = [int(dice.paretovariate(0.8)) % 300 for _ in range(3000)] + [7] * 900
    split = sinks.sorted_split(frame([(str(i), o) for i, o in enumerate(data)], "uuid string, ocn long").repartition(5), 8)
    sizes, largest = Counter(r[0] for r in split.select("part").collect()), max(Counter(data).values())
    assert all(abs(n - len(data) / 8) <= largest for n in sizes.values())
    ranges = rows(split.groupBy("part").agg(F.min("ocn"), F.max("ocn")))
    assert all(a[2] < b[1] for a, b in zip(ranges, ranges[1:]))
    placed = rows(split.withColumn("at", F.spark_partition_id()).select("part", "at").distinct())
    assert placed == [(i, i) for i in sorted(sizes)]
    assert sinks.sorted_split(frame([], "uuid string, ocn long"), 4).count() == 0
