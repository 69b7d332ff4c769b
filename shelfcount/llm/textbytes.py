"""Texts of Arrow batches as one byte array, and prefix polynomial hashes over it."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcount.session import checkpoint_dir, materialize, shared_folder  # noqa: F401  for the operators

#: Bytes that a task handles at a time, whatever the size of an Arrow batch.
BLOCK = 1 << 20

# The hash of x[0..n) is the sum of CODE[x[i]] * BASE**i modulo 2**64. The code of a byte is random, so that
# similar bytes do not give similar hashes. Strings of equal hash are compared byte by byte where it matters.
_rng = np.random.default_rng(20240229)
CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
UNBASE = pow(BASE, -1, 2**64)
_powers: dict[str, np.ndarray] = {}


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
                              else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each has about ``size`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = flat(batch.column(batch.schema.get_field_index(column)))[1]
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last
    _powers.clear()
    give_back()


def give_back() -> None:
    """Memory that is no longer used goes from this process to the system: a worker waits for its next task, of whatever
    operator, and its executor has no other use of what it holds meanwhile."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse for i up to n, kept for the next call of a task."""
    if len(_powers.get("up", ())) <= n:
        size = 1 << max(16, int(n).bit_length())
        for name, base in (("up", BASE), ("down", UNBASE)):
            row = np.ones(1, np.uint64)
            while len(row) < size:  # doubling: base**(n + i) = base**n * base**i
                row = np.concatenate([row, row * np.uint64(pow(base, len(row), 2**64))])
            _powers[name] = row
    return _powers["up"], _powers["down"]


def prefixes(x: np.ndarray) -> np.ndarray:
    """Hash of every prefix of x; entry i is that of x[:i]."""
    up, _ = powers(len(x))
    out = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(CODE[x] * up[:len(x)], out=out[1:])
    return out


def between(prefix: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of x[first:last] by its prefix hashes, the same wherever the string stands."""
    _, down = powers(len(prefix))
    return (prefix[last] - prefix[first]) * down[first]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread over all bits; one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spans_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] values), then first[1], ..."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(first - (ends - count), count)


def row_key(id_column: str = "doc_id", text: str = "text") -> list[Column]:
    """Two columns that name a row by its id and text, in every pass alike; rows equal in both share it."""
    body = F.coalesce(F.col(text), F.lit(""))
    return [F.coalesce(F.col(id_column).cast("long"), F.xxhash64(body)).alias("__id"), F.hash(body).alias("__th")]


def only(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of docs that ``chosen`` names by __id, __hash (of the text); of the n repeated rows of a name, one."""
    name = (F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
            & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__hash")))
    out = docs.join(chosen.select("__id", "__hash"), name, "left_semi")
    again = chosen.filter("n > 1").select("__id", "__hash")
    if again.isEmpty():
        return out
    return out.join(again, name, "left_anti").unionByName(
        out.join(again, name, "left_semi").dropDuplicates(["doc_id", "text"]))


def written(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: used more than once, safe from lost executors."""
    return materialize(df, name)
