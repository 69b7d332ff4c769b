"""Repeated passages, exact copies and near copies, held against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcount.llm import exact, simhash, suffix_dedup
from shelfcount.llm.textbytes import prefixes, between
from tests.llm.conftest import by_id

random.seed(5)
SYLLABLES = ["the", "on", "er", "ing", "tion", "a", "of", "é", "ßen", "or"]


def prose(n, seed=None):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))


# --- repeated passages ---------------------------------------------------------------

def brute_repeats(docs, size):
    seen = Counter()
    raw = [(t or "").encode() for _, t in docs]
    for t in raw:
        seen.update(t[i:i + size] for i in range(len(t) - size + 1))
    out = []
    for (doc_id, _), t in zip(docs, raw):
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i:i + size]] > 1:
                gone[i:i + size] = b"\x01" * size
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), sum(gone), len(re.findall(rb"\x01+", bytes(gone))),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages():
    shared, long, edge = prose(60, 1), prose(400, 2), prose(45, 3)
    assert len(shared.encode()) > 200 and len(edge.encode()) > 200
    docs = [(0, prose(80, 10) + shared + prose(30, 11)), (1, shared), (2, "x" + shared[1:]), (3, long), (4, long),
            (5, long[:700] + "Q" + long[701:]), (6, prose(20, 12) + edge.encode()[:200].decode("utf-8", "ignore")),
            (7, edge + "z"), (8, ""), (9, None), (10, "a" * 1500), (11, prose(3, 13)), (12, "ab" * 150),
            (None, shared + "!"), (None, None), (14, long), (14, long), (15, prose(300, 14)), (15, prose(90, 15))]
    docs += [(100 + i, prose(12, 200 + i) + shared[:260] + prose(9, 300 + i)) for i in range(40)]
    docs += [(200 + i, (lambda w: " ".join(w[:i * 9] + ["edit%d" % i] + w[i * 9:]))(prose(330, 4).split()))
             for i in range(30)]
    return docs


@pytest.mark.parametrize("together", [2000, 3])
def test_repeats_are_those_of_brute_force(documents, together):
    docs = passages()
    got = suffix_dedup.remove_repeats(documents(*docs), together)
    assert by_id(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(docs, 200)


def test_repeats_of_an_empty_table(documents):
    assert suffix_dedup.remove_repeats(documents().limit(0)).count() == 0


def test_long_text_is_handled_in_pieces(documents, monkeypatch):
    docs = [(1, prose(3000, 20)), (2, prose(2900, 20) + prose(50, 21))]
    whole = suffix_dedup.window_anchors
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    assert suffix_dedup.window_anchors is whole
    got = suffix_dedup.remove_repeats(documents(*docs))
    assert by_id(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(docs, 200)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=201, max_size=420))
def test_suffixes_sort_as_bytes(letters):
    x = np.array(letters, np.uint8) + 97
    data = x.tobytes()
    start = np.arange(len(x) - 200 + 1)
    segment = start % 2
    got_segment, got = suffix_dedup.Suffixes(x).sort(segment, start)
    want = sorted(start.tolist(), key=lambda i: (i % 2, data[i:i + 200]))
    assert [(s, data[i:i + 200]) for s, i in zip(got_segment, got)] == [(i % 2, data[i:i + 200]) for i in want]


def test_hash_of_a_substring_does_not_depend_on_its_place():
    x = np.frombuffer(b"abcabcxabc", np.uint8)
    h = between(prefixes(x), np.array([0, 3, 7, 4]), np.array([3, 6, 10, 7]))
    assert h[0] == h[1] == h[2] != h[3]


# --- exact copies --------------------------------------------------------------------

def brute_exact(docs):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in docs]
    groups = defaultdict(list)
    for (doc_id, _), t in zip(docs, norm):
        groups[t].append(doc_id)
    out, done = [], set()
    for (doc_id, _), t in zip(docs, norm):
        ids = [i for i in groups[t] if i is not None]
        keep = min(ids) if ids else None
        kept = doc_id == keep and t not in done
        if kept:
            done.add(t)
        out.append((doc_id, keep, len(groups[t]), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


COPIES = [(3, "a b"), (2, "a\n\tb"), (7, "a  b"), (4, "A b"), (5, ""), (6, None), (None, "a b"), (None, "q"),
          (None, "q"), (8, " a b"), (9, "x" * 50_000), (10, "x" * 50_000), (11, "\x1ca"), (12, "a b"), (4, "A b")]


def test_exact_groups(documents):
    got = exact.exact_groups(documents(*COPIES))
    assert by_id(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(COPIES)


def test_exact_groups_without_broadcast(documents, monkeypatch):
    monkeypatch.setattr(exact, "MAX_BROADCAST_ROWS", 0)
    got = exact.exact_groups(documents(*COPIES))
    assert by_id(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(COPIES)


def test_rows_that_stay(documents):
    kept = exact.without_copies(documents(*COPIES))
    assert kept.columns == documents().columns
    assert Counter(r[0] for r in kept.select("doc_id").collect()) == Counter([2, 4, 5, None, 8, 9, 11, 12])
    assert exact.without_copies(documents().limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1)), st.lists(st.integers(0, 30)))
def test_filters_merge_without_loss(a, b):
    a, b = a + b[:5], b + a[:5]
    merged = exact.CountingQuotientFilter.build(np.array(a, np.uint64)).merge(
        exact.CountingQuotientFilter.build(np.array(b, np.uint64)))
    assert dict(zip(merged.fingerprints().tolist(), merged.counts.tolist())) == Counter(a + b)


def test_filters_that_arrive_one_by_one():
    r, merger, all_of = np.random.default_rng(3), exact.Merger(), []
    assert merger.whole() is None
    for size in [5, 0, 300, 1, 1, 40, 2000, 7, 0]:
        all_of.append(r.integers(0, 1500, size, np.uint64) << np.uint64(50))
        merger.add(exact.CountingQuotientFilter.build(all_of[-1]))
    whole = merger.whole()
    assert dict(zip(whole.fingerprints().tolist(), whole.counts.tolist())) == Counter(np.concatenate(all_of).tolist())


# --- near copies -----------------------------------------------------------------------

def brute_print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, min(len(words), 1)))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_near(docs):
    prints = [brute_print(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        least[find(i)] += [] if doc_id is None else [doc_id]
    return sorted(((d, f"{p:016x}", min(least[find(i)], default=None))
                   for i, ((d, _), p) in enumerate(zip(docs, prints))), key=str)


def near_documents():
    base = prose(400, 30).split()
    docs = [(i, " ".join(base[:i * 3] + ["w%d" % i] + base[i * 3 + 1:])) for i in range(120)]
    docs += [(200, ""), (201, None), (202, " \n"), (203, "One two"), (204, "one\ttwo"), (205, "É a b c"), (206, "é a b c"),
             (None, "one TWO"), (None, prose(50, 31)), (207, prose(50, 31)), (208, prose(70, 32)), (208, prose(70, 32)),
             (209, "la " * 5000)]
    return docs + [(300 + i, prose(40, 400 + i)) for i in range(60)]


def test_components_are_those_of_brute_force(documents):
    docs = near_documents()
    got = simhash.near_components(documents(*docs))
    assert by_id(got, "doc_id", "fingerprint", "component_id") == brute_near(docs)
    assert simhash.near_components(documents().limit(0)).count() == 0


def test_one_row_of_each_component_stays(documents):
    docs = near_documents()
    kept = simhash.one_of_each(documents(*docs))
    assert kept.columns == documents().columns
    want = Counter(c for _, _, c in set(brute_near(docs)))
    assert Counter(r[0] for r in kept.select("doc_id").collect()) == Counter(dict.fromkeys(want, 1))


@pytest.mark.parametrize("seed", range(6))
def test_forest_connects_what_is_linked(seed):
    r = random.Random(seed)
    centres = [r.getrandbits(64) for _ in range(4)]
    f = sorted({c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for c in centres for _ in range(250)})
    a, b = simhash.forest(np.zeros(len(f), np.int64), np.array(f, np.uint64))
    root = {x: x for x in f}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        root[find(x)] = find(y)
    own = {x: find(x) for x in f}
    brute = {x: x for x in f}
    root = brute
    for i, x in enumerate(f):
        for y in f[:i]:
            if (x ^ y).bit_count() <= 3:
                root[find(x)] = find(y)
    assert len({(own[x], find(x)) for x in f}) == len(set(own.values())) == len({find(x) for x in f})
