"""Near copies in crowds: many texts that are somewhat alike, held against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcount.llm import minhash
from shelfcount.operators.concordance import components
from tests.llm.test_duplicates import prose


def crowd(variants, copies, apart, near, seed):
    """Variants of one text of 300 words, ``apart`` words changed in each, and copies with up to ``near`` more."""
    r = random.Random(seed)
    base = prose(300, seed).split()
    number = iter(range(10**9))

    def changed(words, n):
        words = list(words)
        for at in r.sample(range(300), n):
            words[at] = f"new{next(number)}"
        return words

    out = []
    for _ in range(variants):
        own = changed(base, apart)
        out += [own, *(changed(own, r.randint(1, near)) for _ in range(copies))]
    return [" ".join(words) for words in out]


def similar_pairs(texts):
    """All pairs of similarity 0.8 or more, by the counts of shared shingles."""
    ids, sets = {}, []
    for text in texts:
        w = text.split()
        sets.append({ids.setdefault(tuple(w[i:i + 5]), len(ids)) for i in range(max(len(w) - 4, 1))})
    have = np.zeros((len(texts), len(ids)), np.float32)
    for i, own in enumerate(sets):
        have[i, list(own)] = 1
    both = have @ have.T
    size = have.sum(1)
    return np.argwhere(np.triu(both >= 0.8 * (size[:, None] + size[None, :] - both), 1))


def roots(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string").withColumn("raw", F.xxhash64("text"))
    found = components(minhash.links(rows, rows.select("raw", F.col("i").alias("print"))))
    return {r.ocn: r.component for r in found.collect()}


@pytest.mark.parametrize("variants, copies, apart, near", [
    (300, 2, 20, 7), (200, 2, 8, 9), (150, 3, 6, 3), (300, 1, 12, 12)])
def test_links_in_crowds(spark, variants, copies, apart, near):
    texts = crowd(variants, copies, apart, near, 31 * variants + apart)
    want = similar_pairs(texts)
    got = roots(spark, texts)
    together = [got.get(a, a) == got.get(b, b) for a, b in want.tolist()]
    assert len(together) > 100 and np.mean(together) >= 0.99
    # nothing is linked that is not connected by similar pairs
    least = np.arange(len(texts))
    while True:
        new = least.copy()
        np.minimum.at(new, want[:, 0], least[want[:, 1]])
        np.minimum.at(new, want[:, 1], least[want[:, 0]])
        if (new == least).all():
            break
        least = new
    assert all(least[a] == least[b] for a, b in got.items())


def test_crowds_that_are_split_to_the_end(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CROWD", 3)
    texts = crowd(60, 2, 15, 6, 5) + ["", "one", "one two", " ", "ONE two"]
    want = similar_pairs(texts[:180])
    got = roots(spark, texts)
    assert np.mean([got.get(a, a) == got.get(b, b) for a, b in want.tolist()]) >= 0.95
    assert roots(spark, []) == {} and roots(spark, ["", " "]) == {}


def test_what_no_level_splits_is_compared_in_full(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CROWD", 4)
    monkeypatch.setattr(minhash, "LEVELS", ((4, 16),))
    texts = crowd(60, 2, 15, 6, 7)
    got = roots(spark, texts)
    assert np.mean([got.get(a, a) == got.get(b, b) for a, b in similar_pairs(texts).tolist()]) >= 0.99


def test_blocks_meet_once(spark):
    rows = spark.createDataFrame([(i, 10, i, k, 41) for k in (1, 2) for i in range(k * 100, k * 100 + 41)],
                                 "raw long, n long, root long, key long, size long")
    found = [tuple(sorted((r.a.raw, r.b.raw))) for r in minhash._between_blocks(
        rows.withColumn("size", F.lit(200).cast("long"))).collect()]
    assert len(found) == len(set(found)) == 2 * 41 * 40 // 2


def test_sets_are_compared_where_they_are(spark):
    sets = [(4, 1, 4), (5, 0, 4), (4, 1, 3), (400, 100, 400), (400, 101, 400), (1, 0, 1), (1, 1, 0)]  # both, one's, two's own
    rows = spark.createDataFrame([(i, list(range(both + one)), [*range(both), *range(-two, 0)]) for i, (both, one, two) in
                                  enumerate((b, o, t - b if t > b else 0) for b, o, t in sets)],
                                 "i long, one array<long>, two array<long>")
    asked = rows.select("i", minhash._similar(F.col("one"), F.col("two")).alias("similar"))
    assert "Python" not in asked._jdf.queryExecution().toString() and "InArrow" not in asked._jdf.queryExecution().toString()
    assert [r.similar for r in asked.orderBy("i").collect()] == [True, True, True, True, False, True, False]


def test_sets_hold_each_shingle_once(spark):
    texts = ["a b c d e a b c d e a", "one two", "", "A b c d e"]
    rows = spark.createDataFrame(list(enumerate(texts)), "raw long, text string").coalesce(1)
    found = {r.raw: r.hashes for r in rows.mapInArrow(minhash._set_rows, "raw long, hashes array<long>").collect()}
    assert [len(found[i]) for i in range(4)] == [5, 1, 0, 1] and found[3][0] in found[0]
    assert all(len(set(own)) == len(own) for own in found.values())
