"""Exact duplicates: counting quotient filters find candidates, their bytes decide.

Texts are equal when identical after replacing each run of white space by one space. Every partition builds a
counting quotient filter of its 64-bit fingerprints: the upper bits (quotient) name a slot, the lower bits
(remainder) are kept in sorted order within the slot's run, each with its count. Filters of the same quotient
range merge without loss, by one pass over sorted remainders, those of about one size first. Fingerprints with a count above one name the
candidates; only their texts move, and they are grouped by their bytes.

Of equal texts the row with the least doc_id stays; among rows that repeat both doc_id and text, one. Rows
without doc_id stay only if all equal ones lack it. Null texts are empty texts, and equal to each other. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcount.llm.textbytes import only, written
from shelfcount.session import MAX_BROADCAST_ROWS

#: Fixed value of the contract: white space.
SPACES = r"[\x20\x09-\x0D]+"
#: Quotient ranges that merge on their own: 2**SLICE_BITS.
SLICE_BITS = 12
#: Tasks that share one fingerprint where candidates are joined.
SALT = 16


class CountingQuotientFilter:
    """Multiset of 64-bit fingerprints: occupied quotients, run ends, sorted remainders, counts."""

    def __init__(self, bits: int, occupied: np.ndarray, ends: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.bits, self.occupied, self.ends = bits, occupied, ends
        self.remainders, self.counts = remainders, counts

    @classmethod
    def build(cls, prints: np.ndarray) -> CountingQuotientFilter:
        """Of fingerprints (uint64) in any order, each counted once."""
        return cls.of_sorted(np.sort(prints), np.ones(len(prints), np.int64))

    @classmethod
    def of_sorted(cls, prints: np.ndarray, weight: np.ndarray) -> CountingQuotientFilter:
        """Of fingerprints in order, each counted as often as ``weight`` says."""
        new = np.concatenate([[True], prints[1:] != prints[:-1]]) if len(prints) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        total = np.add.reduceat(weight, first) if len(first) else np.zeros(0, np.int64)
        prints = prints[first]
        bits = max(1, int(len(prints) * 1.1).bit_length())
        occupied, size = np.unique(prints >> np.uint64(64 - bits), return_counts=True)
        return cls(bits, occupied, np.cumsum(size), prints & np.uint64((1 << (64 - bits)) - 1), total)

    def fingerprints(self) -> np.ndarray:
        """Whole fingerprints in order: nothing is lost in the filter."""
        runs = np.diff(np.concatenate([[0], self.ends]))
        return (np.repeat(self.occupied, runs) << np.uint64(64 - self.bits)) | self.remainders

    def merge(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """Both multisets together, in one pass over sorted quotients and remainders; counts add up."""
        a, b = self.fingerprints(), other.fingerprints()
        place = np.searchsorted(a, b) + np.arange(len(b))  # of the other's, in front of what is equal
        theirs = np.zeros(len(a) + len(b), bool)
        theirs[place] = True
        prints, weight = np.empty(len(theirs), np.uint64), np.empty(len(theirs), np.int64)
        prints[theirs], prints[~theirs] = b, a
        weight[theirs], weight[~theirs] = other.counts, self.counts
        return self.of_sorted(prints, weight)


class Merger:
    """Filters that arrive one by one, merged with those of about their size: each is merged a logarithmic number of times."""

    def __init__(self):
        self.held: list[CountingQuotientFilter] = []

    def add(self, own: CountingQuotientFilter) -> None:
        while self.held and len(self.held[-1].counts) <= 2 * len(own.counts):
            own = self.held.pop().merge(own)
        self.held.append(own)

    def whole(self) -> CountingQuotientFilter | None:
        """All together; None if nothing came."""
        while len(self.held) > 1:
            last = self.held.pop()
            self.held.append(self.held.pop().merge(last))
        return self.held[0] if self.held else None


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), SPACES, " ")


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One filter for the partition, in slices of the quotient range."""
    merger = Merger()
    for batch in batches:
        merger.add(CountingQuotientFilter.build(batch.column(0).to_numpy().view(np.uint64)))
    held = merger.whole()
    if held is None or not len(held.counts):
        return
    prints = held.fingerprints()
    part = (prints >> np.uint64(64 - SLICE_BITS)).astype(np.int32)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    ends = np.concatenate([first[1:], [len(part)]])
    for at in range(0, len(first), 256):
        some = list(zip(first[at:at + 256], ends[at:at + 256]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[first[at:at + 256]]), pa.array([prints[a:b].tobytes() for a, b in some], pa.binary()),
             pa.array([held.counts[a:b].tobytes() for a, b in some], pa.binary())], names=["slice", "prints", "counts"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints counted more than once, of slices that arrive in order."""
    def above_one(merger):
        held = merger.whole()
        found = held.fingerprints()[held.counts > 1]
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["print"])

    now, merger = None, Merger()
    for batch in batches:
        for part, prints, counts in zip(*(c.to_pylist() for c in batch.columns)):
            if part != now and merger.held:
                yield above_one(merger)
                merger = Merger()
            now = part
            merger.add(CountingQuotientFilter.of_sorted(np.frombuffer(prints, np.uint64), np.frombuffer(counts, np.int64)))
    if merger.held:
        yield above_one(merger)


def repeated_prints(prints: DataFrame) -> DataFrame:
    """(print): the values of a column of 64-bit fingerprints that occur more than once."""
    slices = prints.mapInArrow(_filters, "slice int, prints binary, counts binary")
    return (slices.repartition("slice").sortWithinPartitions("slice").mapInArrow(_merged, "print long"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of docs."""
    return _decided(docs).drop("raw")


def _decided(docs: DataFrame) -> DataFrame:
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("norm"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("raw"))
    rows = written(text.select("doc_id", "raw", F.sha2("norm", 256).alias("text_sha256"), F.xxhash64("norm").alias("print"))
                   .withColumn("tag", F.monotonically_increasing_id()), "prints")
    repeated = written(repeated_prints(rows.select("print")), "repeated")
    candidates = text.select("doc_id", "norm", F.xxhash64("norm").alias("print"))
    if repeated.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        candidates = candidates.join(F.broadcast(repeated), "print", "left_semi")
    else:  # a fingerprint of very many rows goes to several tasks
        salted = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        candidates = (candidates.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)).cast("int"))
                      .join(salted, ["print", "salt"], "left_semi"))
    equal = (candidates.groupBy("print", "norm").agg(F.count("*").alias("group_size")).filter("group_size > 1")
             .select(F.sha2("norm", 256).alias("text_sha256"), "group_size"))
    equal = written(equal, "equal")
    # partial sums before anything is joined; written, so that both sides of the last join are plain shuffles and a
    # frequent text can be split
    first = written(rows.groupBy("text_sha256")
                    .agg(F.min(F.struct(F.isnull("doc_id").alias("missing"), "doc_id", "tag")).alias("least"))
                    .join(equal, "text_sha256")
                    .select("text_sha256", "group_size", F.col("least.doc_id").alias("keep_id"),
                            F.col("least.tag").alias("keep_tag")), "first")
    return rows.join(first, "text_sha256", "left").select(
        "doc_id", F.when(F.isnull("group_size"), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("tag") == F.col("keep_tag"), F.lit(True)).alias("kept"), "text_sha256", "raw")


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    rows = _decided(docs)
    count = rows.groupBy("doc_id", "raw").agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    return only(docs, written(count.filter("kept").select(
        F.col("doc_id").alias("__id"), F.col("raw").alias("__hash"), "n"), "kept"))
