"""Near duplicates by SimHash: fingerprints that differ in at most three bits are linked.

A fingerprint has a bit set if over half the 64-bit hashes of the text's word shingles have it. Two
fingerprints within three bits agree in full in at least three of six blocks of bits, so each distinct
fingerprint is dealt out under the twenty choices of three blocks. Within each of these groups the
fingerprints stand in Gray order, in which neighbours share most bits. Over them stands a hierarchy: a node
holds the bits on which all below it agree and that its parent has not told already. A search adds up the
differences from the root down and drops a whole group once they exceed three, or once the group is in one
component with the fingerprint that searches. Each task reports a forest of its links, never the pairs.

Null texts and texts without words have the fingerprint zero and link like any other. Rows that repeat are
linked; a component is named by its least doc_id, null only if it has no other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcount.llm.textbytes import blocks, flat, only, written
from shelfcount.operators.concordance import components

SHINGLE, SEED, DISTANCE = 3, 42, 3
#: (first bit, bits) of the six blocks.
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
FANOUT = 8
#: Shingles whose bits are counted, and candidates that are compared, at a time.
AT_A_TIME = 100_000
FRONTIER = 2_000_000

# Fixed values of the contract: lower case of A-Z; white space.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


# --- fingerprints ----------------------------------------------------------------

def shingles(x: np.ndarray, at: np.ndarray, shingle: int) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """How many word shingles each text x[at[i]:at[i + 1]] has; and (text, uint64 hash) of them, some at a time."""
    x = np.frombuffer(x.tobytes().translate(_LOWER), np.uint8)
    word = ~_SPACE[x]
    inner = at[(at > 0) & (at < len(x))]
    # one space in front of each text and between words: a shingle is then a slice of the whole
    first = word.copy()
    first[1:] &= ~word[:-1]
    first[inner] = word[inner]
    starts = np.flatnonzero(first)
    kept = np.concatenate([[0], np.cumsum(word)])
    gap = np.insert(x[word], kept[starts], 0x20).tobytes()
    begin = kept[starts] + np.arange(1, len(starts) + 1)  # in gap
    end = np.concatenate([begin[1:] - 1, [len(gap)]]) if len(begin) else begin
    own = np.searchsorted(starts, at)  # words of text i: own[i] to own[i + 1]
    words = np.diff(own)
    number = np.where(words > 0, np.maximum(words - shingle + 1, 1), 0)
    text = np.repeat(np.arange(len(words)), number)
    lead = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number) + own[text]
    left, right = begin[lead], end[np.minimum(lead + shingle, own[text + 1]) - 1]
    digest = xxhash.xxh64_intdigest

    def hashes():
        for part in range(0, len(text), AT_A_TIME):
            some = slice(part, part + AT_A_TIME)
            yield text[some], np.array([digest(gap[a:b], SEED) for a, b in
                                        zip(left[some].tolist(), right[some].tolist())], np.uint64)

    return number, hashes()


def fingerprints(x: np.ndarray, at: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """uint64 fingerprint of each text x[at[i]:at[i + 1]]."""
    number, parts = shingles(x, at, shingle)
    ones = np.zeros((len(number), 64), np.int64)
    for text, h in parts:
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        new = np.flatnonzero(np.concatenate([[True], np.diff(text) != 0]))
        ones[text[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > number[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        prints = fingerprints(*flat(batch.column("text")))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("raw"),
                                          pa.array(prints.view(np.int64))], names=["doc_id", "raw", "print"])


# --- the index ---------------------------------------------------------------------

def gray_rank(f: np.ndarray) -> np.ndarray:
    """Place in the Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        f = f ^ (f >> np.uint64(shift))
    return f


class GrayIndex:
    """Hierarchy over fingerprints that are sorted by group and Gray rank; every group has a tree of its own."""

    def __init__(self, group: np.ndarray, f: np.ndarray):
        self.f = f
        all_one, any_one = [f], [f]
        owner, self.children = [group], []
        while len(owner[-1]) > len(np.unique(group)):
            g = owner[-1]
            begin = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            nth = np.arange(len(g)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(g)]])))
            first = np.flatnonzero(nth % FANOUT == 0)
            self.children.append((first, np.diff(np.concatenate([first, [len(g)]]))))
            all_one.append(np.bitwise_and.reduceat(all_one[-1], first))
            any_one.append(np.bitwise_or.reduceat(any_one[-1], first))
            owner.append(g[first])
        self.root = np.searchsorted(owner[-1], group)
        told = [~(a ^ o) for a, o in zip(all_one, any_one)]  # bits on which all below agree
        self.pattern = all_one
        self.own = told  # less what the parent tells
        for level, (first, count) in enumerate(self.children):
            self.own[level] = told[level] & ~np.repeat(told[level + 1], count)

    def component_of_nodes(self, label: np.ndarray) -> list[np.ndarray]:
        """For each level, the label that all below a node have, or -1."""
        low, high, out = label, label, [label]
        for first, _ in self.children:
            low, high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
            out.append(np.where(low == high, low, -1))
        return out

    def links(self, queries: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, fingerprint) within DISTANCE that are not known to be in one component."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        same = self.component_of_nodes(label)
        top = len(self.children)
        todo = [(top, queries, self.root[queries], np.zeros(len(queries), np.uint8))]
        while todo:
            level, q, node, known = todo.pop()
            d = known + np.bitwise_count((self.f[q] ^ self.pattern[level][node]) & self.own[level][node])
            keep = (d <= DISTANCE) & (same[level][node] != label[q])
            q, node, d = q[keep], node[keep], d[keep]
            if not len(q):
                continue
            if not level:
                found.append((q, node))
                continue
            first, count = self.children[level - 1]
            parts = max(1, -(-len(q) * FANOUT // FRONTIER))
            for some in np.array_split(np.arange(len(q)), parts):
                n = count[node[some]]
                child = np.repeat(first[node[some]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                todo.append((level - 1, np.repeat(q[some], n), child, np.repeat(d[some], n)))
        return (np.concatenate([a for a, _ in found]) if found else np.zeros(0, np.int64),
                np.concatenate([b for _, b in found]) if found else np.zeros(0, np.int64))


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links (a, b): least index of each component."""
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        new = new[label]
        if (new == label).all():
            return label
        label = new


def forest(group: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, another of its component) that connect what is linked within each group."""
    order = np.lexsort((gray_rank(f), group))
    group, f = group[order], f[order]
    many = np.zeros(len(group), bool)
    many[1:] = group[1:] == group[:-1]
    many[:-1] |= many[1:]
    group, f = group[many], f[many]
    if not len(f):
        return f, f
    index, label = GrayIndex(group, f), np.arange(len(f))
    size = np.diff(np.concatenate([np.flatnonzero(np.diff(group, prepend=group[0] - 1)), [len(f)]]))
    # small groups at once; of large ones a few first, so that later searches can drop what is already joined
    nth = np.arange(len(f)) - np.repeat(np.cumsum(size) - size, size)
    wave = np.where(np.repeat(size, size) <= 64, 0, 1 + (np.log2(nth // 16 + 1) / 2).astype(np.int64))
    for w in np.unique(wave):
        label = _joined(label, *index.links(np.flatnonzero(wave == w), label))
    moved = np.flatnonzero(label != np.arange(len(f)))
    return f[moved], f[label[moved]]


def _linked(batches: Iterator[pa.RecordBatch], hold: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Forests of groups that arrive in order; a block never parts a group."""
    def links(keys, prints):
        a, b = forest(np.concatenate(keys), np.concatenate(prints).view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                          names=["variant", "canonical"])

    keys, prints, size = [], [], 0
    for batch in batches:
        key, f = (c.to_numpy() for c in batch.columns)
        if size >= hold and len(key):
            own = int(np.searchsorted(key, keys[-1][-1], "right"))
            keys.append(key[:own]), prints.append(f[:own])
            size += own
            if own == len(key):
                continue
            yield links(keys, prints)
            keys, prints, size, key, f = [], [], 0, key[own:], f[own:]
        if len(key):
            keys.append(key), prints.append(f)
            size += len(key)
    if keys:
        yield links(keys, prints)


def _group_keys(f: str) -> Column:
    """The twenty keys of a fingerprint: which three blocks, and their bits."""
    def key(number, chosen):
        out = F.lit(number).cast("long")
        for first, bits in chosen:
            out = F.shiftleft(out, bits).bitwiseOR(
                F.shiftrightunsigned(f, first).bitwiseAND(F.lit((1 << bits) - 1).cast("long")))
        return out

    return F.array(*(key(n, chosen) for n, chosen in enumerate(combinations(BLOCKS, 3))))


# --- the operator --------------------------------------------------------------------

def near_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of docs."""
    return _placed(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def _placed(docs: DataFrame, more: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """``more`` gives further links (variant, canonical) of fingerprints, from (raw, text) and (raw, print)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = written(texts.withColumn("raw", F.xxhash64("text")).mapInArrow(
        _fingerprint_rows, "doc_id long, raw long, print long"), "fingerprints")
    distinct = written(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct")
    links = (distinct.select(F.explode(_group_keys("print")).alias("key"), "print")
             .repartition("key").sortWithinPartitions("key").mapInArrow(_linked, "variant long, canonical long"))
    if more is not None:
        prints = rows.select("raw", "print").distinct()
        links = links.unionByName(more(texts.withColumn("raw", F.xxhash64("text")), prints))
    joined = (components(written(links, "links")).withColumnsRenamed({"ocn": "print", "component": "root"})
              .join(distinct, "print"))
    names = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = joined.select("print", "root").join(names, "root")
    named = distinct.join(linked, "print", "left").select(
        "print", F.coalesce("root", "print").alias("root"),
        F.when(F.isnull("root"), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    # written, so that both sides of the join are plain shuffles and a frequent fingerprint can be split
    named = written(named, "named")
    return rows.join(named, "print")


def one_of_each(docs: DataFrame, more: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """The rows of docs that stay: of each component one with the least doc_id, with all its columns."""
    rows = written(_placed(docs, more).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
                   .groupBy("root", "doc_id", "raw").agg(F.count("*").alias("n")), "least")
    first = rows.groupBy("root").agg(F.min("raw").alias("raw"))
    return only(docs, rows.join(first, ["root", "raw"]).select(
        F.col("doc_id").alias("__id"), F.col("raw").alias("__hash"), "n"))
