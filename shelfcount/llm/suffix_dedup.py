"""Repeated passages: every byte covered by a string of ``WINDOW`` bytes that also starts anywhere else.

A suffix sort of all texts would move every suffix. Instead each window of 200 bytes is represented by the
least hash among its 64-byte substrings (its anchor): equal windows have equal anchors at equal places, so a
window can only repeat where its anchor does. Anchors are counted by a partial aggregation. Occurrences whose
whole neighbourhood repeats are decided by its hash; the rest, at the edges of copies, are cut out of their
texts, dealt out by anchor, and sorted there as suffixes: a mergesort that compares two suffixes by a binary
search over prefix polynomial hashes for their common extension, with the neighbours in sorted order then
compared byte by byte. Anchors with very many different neighbourhoods are counted window by window, so that
no task gets an unbounded group.

Null texts are empty; texts under 200 bytes have no window. Repeated rows repeat each other. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.llm.textbytes import (between, blocks, flat, mixed, prefixes, ranges, row_key, spans_of, written)

WINDOW, GRAM = 200, 64
SPREAD = WINDOW - GRAM + 1  # substrings of a window
#: More different neighbourhoods of an anchor than this are counted by window, not sorted in one task.
SORTED_TOGETHER = 2000
#: Windows that are sorted at a time, but for those of one anchor, and bytes of neighbourhoods that are looked at.
SORT_WINDOWS, SORT_BLOCK = 200_000, 1 << 18
PIECE = 1 << 19  # windows of one text that are handled at a time

KEY = "__id long, __th int"
KEY_FIELDS = [("__id", pa.int64()), ("__th", pa.int32())]


# --- anchors -------------------------------------------------------------------

def window_anchors(x: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(anchor, first window, last window, anchor hash, neighbourhood hash) of the segments [starts, ends) of x.

    One row for each anchor and run of consecutive windows that it represents.
    """
    prefix = prefixes(x)
    place = np.arange(len(x) - GRAM + 1)
    gram = mixed(between(prefix, place, place + GRAM))
    bits = int(len(gram)).bit_length()
    low = np.uint64((1 << bits) - 1)
    value = (gram & ~low) | place.astype(np.uint64)  # of equal ones the leftmost is least
    # least of SPREAD values in a row: of the end of one stretch and the beginning of the next
    stretch = np.full(-(-len(value) // SPREAD) * SPREAD, np.iinfo(np.uint64).max)
    stretch[:len(value)] = value
    grid = stretch.reshape(-1, SPREAD)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    window = ranges(starts, np.maximum(ends - starts - WINDOW + 1, 0))
    anchor = (np.minimum(tail[window], head[window + SPREAD - 1]) & low).astype(np.int64)
    if not len(anchor):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    anchor, first = anchor[new], window[new]
    last = window[np.concatenate([new[1:], [len(window)]]) - 1]
    shape = ((anchor - first) * 256 + (last - first)).astype(np.uint64)
    around = mixed(between(prefix, first, last + WINDOW) + mixed(shape + np.uint64(1)))
    return anchor, first, last, gram[anchor], around


def _pieces(at: np.ndarray):
    """(row, first byte, last byte) of stretches of at most PIECE windows; texts without a window give none."""
    for row in np.flatnonzero(np.diff(at) >= WINDOW):
        for first in range(int(at[row]), int(at[row + 1]) - WINDOW + 1, PIECE):
            yield int(row), first, min(int(at[row + 1]), first + PIECE + WINDOW - 1)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        x, at = flat(batch.column("text"))
        pieces = np.array(list(_pieces(at)), np.int64).reshape(-1, 3)
        group = np.cumsum(pieces[:, 2] - pieces[:, 1]) // (2 * PIECE)
        for g in np.unique(group):
            row, first, last = pieces[group == g].T
            begin, end = int(first.min()), int(last.max())
            anchor, w0, w1, near, around = window_anchors(x[begin:end], first - begin, last - begin)
            own = np.searchsorted(first - begin, w0, "right") - 1
            rows = pa.array(row[own])
            at_text = w0 + begin - at[row[own]]
            packed = (at_text << 16) | ((w1 - w0) << 8) | (anchor - w0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id").take(rows), batch.column("__th").take(rows), pa.array(near.view(np.int64)),
                 pa.array(around.view(np.int64)), pa.array(packed)],
                schema=pa.schema([*KEY_FIELDS, ("anchor", pa.int64()), ("around", pa.int64()), ("place", pa.int64())]))


# --- suffix sort of neighbourhoods -----------------------------------------------

class Suffixes:
    """Suffixes of a byte array, compared over their first WINDOW bytes."""

    def __init__(self, x: np.ndarray):
        self.x, self.prefix = x, prefixes(x)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension, WINDOW at most, by binary search over prefix hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), WINDOW, np.int64)
        for _ in range(WINDOW.bit_length()):
            mid = (low + high + 1) // 2
            same = between(self.prefix, a, a + mid) == between(self.prefix, b, b + mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
            high = np.maximum(high, low)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, ties: bool) -> np.ndarray:
        """Whether a sorts before b; equal ones by ``ties``."""
        n = self.common(a, b)
        end = n == WINDOW
        at = np.where(end, 0, n)
        return np.where(end, ties, self.x[a + at] < self.x[b + at])

    def sort(self, segment: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted by segment, and within each segment as suffixes: bottom-up mergesort of all segments at once."""
        order = np.argsort(segment, kind="stable")
        segment, start = segment[order], start[order]
        begin = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])) if len(segment) else order
        size = np.diff(np.concatenate([begin, [len(segment)]]))
        base, count = np.repeat(begin, size), np.repeat(size, size)
        index = np.arange(len(segment)) - base
        width = 1
        while width < size.max(initial=0):
            pair = index // (2 * width) * (2 * width)
            left = index - pair < width
            other = np.where(left, pair + width, pair)  # the run to be merged with
            other_n = np.clip(np.where(left, np.minimum(count - other, width), width), 0, None)
            low, high = np.zeros(len(index), np.int64), other_n.copy()
            todo = np.flatnonzero(low < high)
            while len(todo):
                mid = (low[todo] + high[todo]) // 2
                theirs, own = start[base[todo] + other[todo] + mid], start[todo]
                # of equal ones those of the left run come first
                theirs_first = self.before(theirs, own, False) | (~left[todo] & ~self.before(own, theirs, False))
                low[todo] = np.where(theirs_first, mid + 1, low[todo])
                high[todo] = np.where(theirs_first, high[todo], mid)
                todo = todo[low[todo] < high[todo]]
            target = base + pair + (index - pair - np.where(left, 0, width)) + low
            moved = np.empty_like(start)
            moved[target] = start
            start, width = moved, 2 * width
        return segment, start

    def repeated(self, segment: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Starts whose WINDOW bytes also start elsewhere in their segment, verified byte by byte."""
        segment, start = self.sort(segment, start)
        near = np.flatnonzero(segment[1:] == segment[:-1])
        near = near[self.common(start[near], start[near + 1]) == WINDOW]
        hit = np.zeros(len(start), bool)
        offsets = np.arange(WINDOW)
        for at in range(0, len(near), 20_000):
            part = near[at:at + 20_000]
            same = (self.x[start[part, None] + offsets] == self.x[start[part + 1, None] + offsets]).all(axis=1)
            hit[part[same]] = hit[part[same] + 1] = True
        return start[hit]


def _windows(place: np.ndarray) -> np.ndarray:
    """Windows of each neighbourhood."""
    return ((place >> 8) & 255) + 1


def _sorted_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that are sorted by anchor, in blocks of about SORT_WINDOWS that never part an anchor."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in blocks(batches, "context", SORT_BLOCK):
        if size >= SORT_WINDOWS:
            anchors = batch.column("anchor").to_numpy()
            other = np.flatnonzero(anchors != held[-1].column("anchor")[-1].as_py())
            own = int(other[0]) if len(other) else batch.num_rows
            held.append(batch.slice(0, own))
            if own == batch.num_rows:
                continue
            yield pa.Table.from_batches(held)
            held, size, batch = [], 0, batch.slice(own)
        held.append(batch)
        size += int(_windows(batch.column("place").to_numpy()).sum())
    if held:
        yield pa.Table.from_batches(held)


def _repeated_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows, as the spans of bytes that they cover."""
    for table in _sorted_together(batches):
        x, at = flat(table.column("context"))
        place = table.column("place").to_numpy()
        windows, lead = _windows(place), place & 255
        start = ranges(at[:-1], windows)
        row = np.repeat(np.arange(len(place)), windows)
        group = np.cumsum(np.concatenate([[0], np.diff(table.column("anchor").to_numpy()) != 0]))
        segment = group[row] * 512 + (start - at[row]) - lead[row] + 256
        hit = np.zeros(len(x) + 1, bool)
        hit[Suffixes(x).repeated(segment, start)] = True
        # the byte after the last window of a neighbourhood starts none, so runs never cross into the next one
        own = np.zeros(len(x) + 1, bool)
        own[start] = hit[start] & (table.column("copies").to_numpy() == 1)[row]
        first, last = spans_of(own)
        row = np.searchsorted(at, first, "right") - 1
        rows = pa.array(row)
        spans = ((place[row] >> 16) + first - at[row] << 10) + (last - first - 1 + WINDOW)
        yield pa.RecordBatch.from_arrays(
            [table.column("__id").take(rows).combine_chunks(), table.column("__th").take(rows).combine_chunks(),
             pa.array(spans)], schema=pa.schema([*KEY_FIELDS, ("span", pa.int64())]))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbourhoods cut out of their texts."""
    kinds = [*KEY_FIELDS, ("anchor", pa.int64()), ("place", pa.int64()), ("copies", pa.int64()),
             ("many", pa.bool_()), ("context", pa.binary())]
    for batch in blocks(batches):
        x, at = flat(batch.column("text"))
        wanted = batch.column("wanted")
        n = np.diff(wanted.offsets.to_numpy())
        row = np.repeat(np.arange(batch.num_rows), n)
        each = wanted.flatten()
        place = each.field("place").to_numpy()
        first = at[row] + (place >> 16)
        size = ((place >> 8) & 255) + WINDOW
        ends = np.concatenate([[0], np.cumsum(size)])
        cut = pa.Array.from_buffers(pa.binary(), len(size), [
            None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x[ranges(first, size)]))])
        yield pa.RecordBatch.from_arrays(
            [batch.column("__id").take(pa.array(row)), batch.column("__th").take(pa.array(row)), each.field("anchor"),
             each.field("place"), each.field("copies"), each.field("many"), cut], schema=pa.schema(kinds))


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes of every window of a neighbourhood."""
    for batch in blocks(batches, "context"):
        x, at = flat(batch.column("context"))
        place = batch.column("place").to_numpy()
        n = ((place >> 8) & 255) + 1
        row, start = np.repeat(np.arange(len(place)), n), ranges(at[:-1], n)
        one = between(prefixes(x), start, start + WINDOW)
        two = between(prefixes(x ^ np.uint8(0x5A)), start, start + WINDOW)
        rows = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [batch.column("__id").take(rows), batch.column("__th").take(rows),
             pa.array((place[row] >> 16) + start - at[row]), pa.array(one.view(np.int64)),
             pa.array(two.view(np.int64)), batch.column("copies").take(rows)],
            schema=pa.schema([*KEY_FIELDS, ("window", pa.int64()), ("one", pa.int64()), ("two", pa.int64()),
                              ("copies", pa.int64())]))


# --- the operator ------------------------------------------------------------------

def repeated_spans(docs: DataFrame, sorted_together: int = SORTED_TOGETHER) -> DataFrame:
    """(__id, __th, spans): stretches of repeated bytes of each text, as start * 1024 + length; they may overlap."""
    texts = docs.select(*row_key(), F.coalesce("text", F.lit("")).alias("text"))
    anchors = texts.mapInArrow(_anchor_rows, f"{KEY}, anchor long, around long, place long")
    # written, so that a frequent anchor's side of the join is a plain shuffle, which the planner can split
    repeated = written(anchors.groupBy("anchor").agg(F.count("*").alias("n"), F.min("around").alias("least"),
                                                     F.max("around").alias("most"))
                       .filter("n > 1").select("anchor", F.expr("least = most").alias("alike")), "repeated")
    found = written(anchors.join(repeated, "anchor"), "anchors")

    mixed_ones = found.filter("NOT alike")
    near = written(mixed_ones.groupBy("anchor", "around").agg(
        F.count("*").alias("copies"), F.first("__id").alias("__id"), F.first("__th").alias("__th"),
        F.first("place").alias("place")), "near")
    group = written(near.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("copies").alias("fewest"))
                    .filter("fewest = 1").select("anchor", (F.col("kinds") > sorted_together).alias("many")), "groups")
    wanted = (near.join(group, "anchor").groupBy("__id", "__th")
              .agg(F.collect_list(F.struct("anchor", "place", "copies", "many")).alias("wanted")))
    contexts = written(texts.join(wanted, ["__id", "__th"]).mapInArrow(
        _contexts, f"{KEY}, anchor long, place long, copies long, many boolean, context binary"), "contexts")

    few = contexts.filter("NOT many")
    edges = (few.repartition("anchor").sortWithinPartitions("anchor")
             .mapInArrow(_repeated_windows, f"{KEY}, span long"))
    hashed = contexts.filter("many").mapInArrow(
        _window_hashes, f"{KEY}, window long, one long, two long, copies long")
    common = hashed.groupBy("one", "two").agg(F.count("*").alias("n")).filter("n > 1").select("one", "two")
    edges = edges.unionByName(hashed.filter("copies = 1").join(common, ["one", "two"]).select(
        "__id", "__th", F.expr(f"shiftleft(window, 10) + {WINDOW}").alias("span")))

    whole = found.filter("alike").select("__id", "__th", "place").unionByName(
        mixed_ones.join(near.filter("copies > 1").select("anchor", "around"), ["anchor", "around"])
        .select("__id", "__th", "place"))
    spans = whole.select("__id", "__th", F.expr(
        f"shiftleft(shiftright(place, 16), 10) + (shiftright(place, 8) & 255) + {WINDOW}").alias("span")).unionByName(edges)
    # a set: rows that repeat both id and text name the same spans
    return spans.groupBy("__id", "__th").agg(F.collect_set("span").alias("spans"))


def covered(size: int, spans: np.ndarray) -> np.ndarray:
    """Which bytes the spans cover."""
    depth = np.zeros(size + 1, np.int32)
    np.add.at(depth, spans >> 10, 1)
    np.add.at(depth, (spans >> 10) + (spans & 1023), -1)
    return np.cumsum(depth[:-1]) > 0


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        x, at = flat(batch.column("text"))
        spans = batch.column("spans")
        each, ends = spans.flatten().to_numpy(), np.concatenate(
            [[0], np.cumsum(np.nan_to_num(np.array(spans.value_lengths().to_numpy(zero_copy_only=False), float)))]
        ).astype(np.int64)
        rows = []
        for i in range(batch.num_rows):
            text, own = x[at[i]:at[i + 1]], each[ends[i]:ends[i + 1]]
            if len(own):
                gone = covered(len(text), own)
                starts, stops = spans_of(gone)
                rows.append((len(text), int((stops - starts).sum()), len(starts), text[~gone].tobytes()))
            else:
                rows.append((len(text), 0, 0, text.tobytes()))
        size, removed, runs, left = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(runs, pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in left], pa.string()),
             pa.array(left, pa.binary())],
            schema=pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                              ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]))


def remove_repeats(docs: DataFrame, sorted_together: int = SORTED_TOGETHER) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): each text without its repeated bytes."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(),
                        F.coalesce("text", F.lit("")).alias("text"))
    return (texts.join(repeated_spans(docs, sorted_together), ["__id", "__th"], "left")
            .select("doc_id", "text", "spans").mapInArrow(
                _removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))
