import random

import pytest

from conftest import rows
from shelfcount.operators import concordance as c
from shelfcount.sources import files, sinks

PAIRS = "variant long, canonical long"


def graph(frame, *pairs):
    return frame(list(pairs), PAIRS)


def test_chain(frame):
    found = c.validate(graph(frame, (3, 3), (1, 2), (2, 3)))
    assert rows(found.valid) == [(1, 3), (2, 3)]
    assert found.rejected.count() == 0


def test_several_terminals(frame):
    found = c.validate(graph(frame, (1, 2), (1, 3)))
    assert found.valid.count() == 0
    assert rows(found.rejected, "variant", "reason") == [(1, c.SEVERAL)] * 2


def test_branches_that_meet_again(frame):
    found = c.validate(graph(frame, (1, 2), (1, 3), (2, 3), (4, 4), (5, 6)))
    assert rows(found.valid) == [(1, 3), (1, 3), (2, 3), (5, 6)]


@pytest.mark.parametrize("pairs, cyclic", [
    ([(1, 2), (2, 3), (3, 1)], [1, 2, 3]),
    ([(1, 2), (2, 3), (3, 2)], [2, 3]),
    ([(1, 2), (1, 3), (2, 3), (2, 4), (4, 5), (5, 2)], [2, 3, 4, 5]),
    ([(1, 2), (1, 3), (2, 3), (2, 4), (4, 5), (17, 26), (7, 26)], []),
])
def test_cycles(frame, pairs, cyclic):
    found = c.validate(graph(frame, *pairs, (90, 91)))
    assert [r[0] for r in rows(found.cyclic, "ocn")] == cyclic
    if cyclic:
        assert rows(found.valid) == [(90, 91)]
        assert {r[0] for r in rows(found.rejected, "reason")} == {c.CYCLE}


def test_components(frame):
    found = c.components(graph(frame, (5, 4), (4, 9), (1, 2), (3, 2), (7, 7)))
    assert rows(found) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (9, 4)]
    assert c.components(graph(frame)).count() == 0


def test_long_chain_and_wide_star(frame):
    chain = [(n, n + 1) for n in range(1, 400)]
    star = [(1000 + n, 5000) for n in range(400)]
    found = c.validate(graph(frame, *chain, *star))
    assert set(rows(found.valid)) == {(n, 400) for n in range(1, 400)} | {(1000 + n, 5000) for n in range(400)}


def _brute(pairs):
    edges = {(a, b) for a, b in pairs if a != b}
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    comp = {}
    for n in {x for e in edges for x in e}:
        seen, todo = {n}, [n]
        while todo:
            x = todo.pop()
            for a, b in edges:
                for p, q in ((a, b), (b, a)):
                    if p == x and q not in seen:
                        seen.add(q)
                        todo.append(q)
        comp[n] = min(seen)

    def reach(n):
        seen, todo = set(), [n]
        while todo:
            for b in out.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        return seen

    bad = {comp[n] for n in comp if n in reach(n)}
    valid, rejected = [], []
    for a, b in pairs:
        if a == b:
            continue
        ends = {x for x in reach(a) if x not in out}
        if comp[a] in bad:
            rejected.append((a, c.CYCLE))
        elif len(ends) == 1:
            valid.append((a, ends.pop()))
        else:
            rejected.append((a, c.SEVERAL))
    return sorted(valid), sorted(rejected)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_against_brute_force(frame, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(25)]
    pairs += [(a, b) for a, b in ((rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(45)) if a < b]
    found = c.validate(graph(frame, *pairs))
    valid, rejected = _brute(pairs)
    assert rows(found.valid) == valid
    assert rows(found.rejected, "variant", "reason") == rejected


def test_delta_is_a_multiset_difference(frame):
    old, new = graph(frame, (1, 2), (1, 2), (111, 222)), graph(frame, (1, 2), (999, 0))
    adds, deletes = c.delta(old, new)
    assert rows(adds) == [(999, 0)]
    assert rows(deletes) == [(1, 2), (111, 222)]


def test_apply_and_load(spark, frame, tmp_path):
    current = graph(frame, (1, 2), (3, 4))
    sinks.write_pairs(graph(frame, (5, 6), (1, 2)), str(tmp_path / "comm_diff_2024-05-01.txt.adds"))
    sinks.write_pairs(graph(frame, (3, 4)), str(tmp_path / "comm_diff_2024-05-01.txt.deletes"))
    (tmp_path / "full.txt").write_text("8\t9\n")
    (tmp_path / "bad.txt").write_text("8\t9\n8\t9\t10\n\nx\t1\n")

    def read(path):
        return files.read_concordance(spark, path)

    assert rows(c.load(current, "20240501", read, str(tmp_path))) == [(1, 2), (5, 6)]
    assert rows(c.load(current, str(tmp_path / "full.txt"), read, str(tmp_path))) == [(8, 9)]
    with pytest.raises(ValueError, match="3 line"):
        read(str(tmp_path / "bad.txt"))
    assert c.is_delta("20240501") and not c.is_delta("2024050") and not c.is_delta("full.txt")


def test_line_format(frame):
    good = frame([("1\t2",), ("3\t4",)], "value string")
    bad = frame([("123\t578",), ("abc123\tabc456",), ("245\t858q",)], "value string")
    c.require_well_formed(good)
    with pytest.raises(ValueError, match="2 line"):
        c.require_well_formed(bad)


def test_adjacency_neighbours_terminals(frame):
    pairs = graph(frame, (1, 2), (1, 3), (2, 3), (4, 4))
    assert rows(c.adjacency(pairs)) == [(1, [2, 3]), (2, [3]), (4, [4])]
    assert rows(c.neighbours(pairs)) == [(1, "out", 2), (1, "out", 3), (2, "in", 1), (2, "out", 3),
                                         (3, "in", 1), (3, "in", 2)]
    assert rows(c.terminals(pairs)) == [(3,)]


def test_a_long_path_with_an_extra_edge_takes_few_rounds(spark, frame, monkeypatch):
    """Two thousand steps, a shortcut that makes the component suspect, and a cycle at the end of another path."""
    path = [(i, i + 1) for i in range(1, 2000)] + [(1, 3)]
    loop = [(i, i + 1) for i in range(5001, 5600)] + [(5600, 5590), (5599, 6000), (6000, 6001)]
    rounds = []
    cut = c.cut_lineage
    monkeypatch.setattr(c, "cut_lineage", lambda df: rounds.append(1) or cut(df))
    edges = graph(frame, *path, *loop)
    member_of = frame([(i, 1) for i in range(1, 2001)] + [(i, 2) for i in [*range(5001, 5601), 6000, 6001]],
                      "ocn long, component long")
    found = {r["ocn"] for r in c.cycle_residue(edges, member_of).collect()}
    assert found == {*range(5590, 5601), 6000, 6001} and len(rounds) < 25
