"""Near copies by Jaccard similarity of word shingles: five words, 0.8 or more.

Candidates meet where four least hashes of their shingles agree, in any of sixteen bands: a pair with similarity
0.8 does so with a chance of 0.9998. First, each text of a band's group is compared with one of them, another one in
each group; what is similar is joined into components. A group all in one component is then done. The others of more
than ``CROWD`` texts are compared with a further one of them, as long as this leaves a quarter fewer components in
them. Groups of up to CROWD texts are then compared pair by pair between components. Texts of larger ones meet again
under finer bands, of eight and then of twelve least hashes, as many as give such a pair a chance of 0.9998 and 0.9989
to meet. What agrees in twelve and is still more than CROWD is dealt into blocks, and every two blocks of a group are
compared pair by pair, so that none is left out: there a text gives one row for each block of its group. No group is
gathered much beyond CROWD texts, and before that a text gives one row a band, whatever the size of its groups. Only pairs
whose numbers of shingles can give 0.8 are kept, and these are verified on the whole sets of shingle hashes.

Texts without words have no candidates. Texts of fewer than five words are one shingle. Repeated and null texts
(empty) are one text; an empty table has no links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcount.llm.simhash import shingles
from shelfcount.llm.textbytes import blocks, flat, written
from shelfcount.operators.concordance import components
from shelfcount.session import discard

SHINGLE, SIMILARITY = 5, 0.8
#: (least hashes of a band, bands) of all texts, of those in crowds, and of those in crowds of the second.
LEVELS = ((4, 16), (8, 48), (12, 96))
#: Texts of a group that are compared pair by pair; larger groups are split.
CROWD = 64
#: Share of the components of crowded groups that a round must join for another one to follow.
ROUND_JOINS = 0.25


def _factors(level: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors: one for each least hash, and those that mix the hashes of a band into its key."""
    least, bands = LEVELS[level]
    random = np.random.default_rng(11 + level)
    return tuple(random.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1) for n in (bands * least, least + 1))


def band_keys(x: np.ndarray, at: np.ndarray, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Number of shingles of each text x[at[i]:at[i + 1]], and int64 keys (texts x bands) of those that have any."""
    number, parts = shingles(x, at, SHINGLE)
    h = np.concatenate([np.zeros(0, np.uint64), *(h for _, h in parts)])
    some = number[number > 0]
    first = np.cumsum(some) - some
    least, bands = LEVELS[level]
    factors, mix = _factors(level)
    keys = np.arange(bands, dtype=np.uint64)[:, None] * mix[least] + np.zeros(len(some), np.uint64)
    for i, factor in enumerate(factors if len(some) else ()):
        key = keys[i // least]
        key ^= np.minimum.reduceat(h * factor, first)
        key *= mix[i % least]
        key ^= key >> np.uint64(29)
    return number, np.ascontiguousarray(keys.T).view(np.int64)


def _key_rows(level: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = LEVELS[level][1]
        for batch in blocks(batches):
            number, keys = band_keys(*flat(batch.column("text")), level)
            some = number > 0
            lists = pa.ListArray.from_arrays(np.arange(0, bands * some.sum() + 1, bands, dtype=np.int32), keys.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("raw").filter(pa.array(some)),
                                              pa.array(number[some].astype(np.int64)), lists], names=["raw", "n", "bands"])
    return rows


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(raw, different shingle hashes)"""
    for batch in blocks(batches):
        number, parts = shingles(*flat(batch.column("text")), SHINGLE)
        h = np.concatenate([np.zeros(0, np.uint64), *(h for _, h in parts)])
        sets = [np.unique(own) for own in np.split(h, np.cumsum(number)[:-1])]
        at = np.concatenate([[0], np.cumsum([len(own) for own in sets])]).astype(np.int32)
        hashes = pa.ListArray.from_arrays(at, np.concatenate(sets).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("raw"), hashes], names=["raw", "hashes"])


def _similar(one: Column, two: Column) -> Column:
    """Whether sets are similar. Computed where they are: pairs of sets in Arrow batches would be many times their texts."""
    both = F.size(F.array_intersect(one, two))
    return both >= SIMILARITY * (F.size(one) + F.size(two) - both)


def _possible(a: Column, b: Column) -> Column:
    """Whether texts are in different components and have numbers of shingles that similar ones can have."""
    return (a["root"] != b["root"]) & (F.least(a["n"], b["n"]) >= SIMILARITY * F.greatest(a["n"], b["n"]))


def _pairs(rows: DataFrame) -> DataFrame:
    """The possible ones of pairs (a, b)."""
    return rows.filter(_possible(F.col("a"), F.col("b"))).select(
        F.struct("a.raw", "a.root").alias("a"), F.struct("b.raw", "b.root").alias("b"))


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(variant, canonical): the components of the pairs (a, b: structs of raw and root) that are similar."""
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
                    .select(F.col("a.raw").alias("a"), F.col("a.root").alias("variant"),
                            F.col("b.raw").alias("b"), F.col("b.root").alias("canonical")), "near")
    asked = pairs.select(F.col("a").alias("raw")).distinct().union(pairs.select("b").distinct()).distinct()
    sets = written(texts.join(asked, "raw", "left_semi").select("raw", "text").dropDuplicates(["raw"])
                   .mapInArrow(_set_rows, "raw long, hashes array<long>"), "sets")
    similar = written(pairs.join(sets.select(F.col("raw").alias("a"), F.col("hashes").alias("one")), "a")
                      .join(sets.select(F.col("raw").alias("b"), F.col("hashes").alias("two")), "b")
                      .filter(_similar(F.col("one"), F.col("two"))).select("variant", "canonical").distinct(), "similar")
    discard(pairs, sets)
    return similar


def _own() -> Column:
    return F.struct("raw", "n", "root")


def _with_another(rows: DataFrame, turn: int = 0) -> DataFrame:
    """Pairs of each row and one row of its group (key), another one in each group and turn."""
    one = rows.groupBy("key").agg(F.min_by(_own(), F.xxhash64("raw", "key", F.lit(turn))).alias("b"))
    return _pairs(rows.select("key", _own().alias("a")).join(one, "key"))


def _between_components(rows: DataFrame, *more: str, meet: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Pairs within groups, all of which are small; of those only that ``meet`` by their columns ``more``."""
    members = rows.groupBy("key").agg(F.collect_list(F.struct("raw", "n", "root", *more)).alias("of"))

    def paired(a: Column, b: Column) -> Column:
        pair = (b["raw"] > a["raw"]) & _possible(a, b)
        return pair if meet is None else pair & meet(a, b)

    both = F.flatten(F.transform("of", lambda a: F.transform(
        F.filter("of", lambda b: paired(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return _pairs(members.select("key", F.explode(both).alias("pair")).select("pair.a", "pair.b"))


def _between_blocks(rows: DataFrame) -> DataFrame:
    """Pairs within groups of any size: each group is dealt into blocks, and any two of them are a small group."""
    blocks_of = F.ceil(F.col("size") / max(CROWD // 2, 1))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("raw", "key"), blocks_of))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks_of - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    met = met.select("raw", "n", "root", "block", (low == high).alias("same"),
                     F.struct("key", low.alias("low"), high.alias("high")).alias("key"))
    return _between_components(met, "block", "same", meet=lambda a, b: (a["block"] != b["block"]) | a["same"])


def _unsettled(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of groups (key) of three or more that are in several components still, once ``found`` has joined some.

    With the size of the group and the number of its components.
    """
    moved = components(found).withColumnsRenamed({"ocn": "root", "component": "to"})
    rows = (rows.select("raw", "n", "key", "root").join(moved, "root", "left")
            .select("raw", "n", "key", F.coalesce("to", "root").alias("root")))
    groups = (rows.groupBy("key", "root").agg(F.count("*").alias("n"))
              .groupBy("key").agg(F.sum("n").alias("size"), F.count("*").alias("parts")))
    return written(rows.join(groups.filter("size > 2 AND parts > 1"), "key"), "unsettled")


def _parts(rows: DataFrame) -> int:
    """Components in crowded groups, each counted in each group."""
    return (rows.filter(F.col("size") > CROWD).groupBy("key").agg(F.first("parts").alias("parts"))
            .agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0])


def _met(texts: DataFrame, named: DataFrame, level: int) -> DataFrame:
    """(raw, n, key, root): a row for each band of a text that another text shares, from (raw, root)."""
    keys = (texts.join(named, "raw", "left_semi") if level else texts).select("raw", "text").mapInArrow(
        _key_rows(level), "raw long, n long, bands array<long>")
    keys = keys.groupBy("raw").agg(F.first("n").alias("n"), F.first("bands").alias("bands")).join(named, "raw")
    band = written(keys.select("raw", "n", "root", F.explode("bands").alias("key")), "bands")
    shared = band.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    met = written(band.join(shared.select("key"), "key"), "met")
    discard(band)
    return met


def links(texts: DataFrame, prints: DataFrame) -> DataFrame:
    """(variant, canonical): links that join similar texts, from (raw, text) and the different (raw, print).

    Links are between the least fingerprints of the components that two similar texts are in at the time.
    """
    named, out = prints.select("raw", F.col("print").alias("root")), None
    for level in range(len(LEVELS)):
        rows = _met(texts, named, level)
        found = _verified(texts, _with_another(rows))
        out = found if out is None else out.unionByName(found)
        rows = _unsettled(rows, found)
        parts, turn = _parts(rows), 0
        while parts:
            turn, before = turn + 1, parts
            found = _verified(texts, _with_another(rows.filter(F.col("size") > CROWD), turn))
            out = out.unionByName(found)
            rows = _unsettled(rows, found)
            parts = _parts(rows)
            if parts > (1 - ROUND_JOINS) * before:
                break
        small = rows.filter(F.col("size") <= CROWD)
        found = _verified(texts, _between_components(small))
        out = out.unionByName(found)
        if not parts:
            break
        rows = _unsettled(rows.filter(F.col("size") > CROWD), found)
        if level == len(LEVELS) - 1:
            out = out if rows.isEmpty() else out.unionByName(_verified(texts, _between_blocks(rows)))
            break
        named = written(rows.select("raw", "root").distinct(), "crowded")
        if named.isEmpty():
            break
    return out.distinct()
