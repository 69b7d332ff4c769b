"""Benchmark passages in documents: backward search of test phrases in an FM-index of each shard.

A window is ten consecutive words of an item, or the whole of a shorter item. A shard is a block of documents
within a task. Its index holds the stretches of words that occur in the benchmark at all and are long enough
for a window, as word numbers: a Burrows-Wheeler transform with rank queries by a wavelet matrix, and every
eighth suffix position. All windows are searched at once, from their last word to their first; occurrences are
located by walking to a sampled position, compared byte by byte, and merged into spans.

The benchmark goes to the executors in blocks of bounded size, one pass over the documents for each block, so
that nothing unbounded is broadcast; an ordinary benchmark is one block. Documents are never shuffled.

Null texts have no words. Items without words have no window. A null item_id is written as the empty string.
Repeated rows get equal results; items that repeat count once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.llm.textbytes import between, blocks, flat, mixed, prefixes, ranges, spans_of, written

WINDOW = 10
#: Bytes of benchmark text that one pass over the documents looks for.
BENCHMARK_BLOCK = 4 << 20
SAMPLED = 8

# Fixed values of the contract: lower case of A-Z; what belongs to a word.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORD = np.array([c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A for c in range(256)])


def words_of(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and starts and ends of the words; none crosses from one text to the next."""
    x = np.frombuffer(x.tobytes().translate(_LOWER), np.uint8)
    word = _WORD[x]
    inner = at[(at > 0) & (at < len(x))]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    first[inner] = word[inner]
    last[:-1] &= ~word[1:]
    last[inner - 1] = word[inner - 1]
    return x, np.flatnonzero(first), np.flatnonzero(last) + 1


# --- the index ---------------------------------------------------------------------

def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; the last value of s is unique and least."""
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.full(len(s), -1, np.int64)
        after[:-step] = rank[step:]
        key = rank * (len(s) + 1) + after + 1
        order = np.argsort(key, kind="stable")
        new = np.empty_like(rank)
        new[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
        if new[order[-1]] == len(s) - 1:
            return order
        rank, step = new, 2 * step


class WaveletMatrix:
    """Rank of any symbol at any place, by one bit vector for each bit of the symbols."""

    def __init__(self, s: np.ndarray, bits: int):
        self.levels = []
        for bit in reversed(range(bits)):
            one = (s >> bit) & 1
            before = np.concatenate([[0], np.cumsum(one)])
            self.levels.append((bit, before, len(s) - int(before[-1])))
            s = np.concatenate([s[one == 0], s[one == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        begin, end = np.zeros(len(place), np.int64), place
        for bit, before, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            begin = np.where(one, zeros + before[begin], begin - before[begin])
            end = np.where(one, zeros + before[end], end - before[end])
        return end - begin


class FMIndex:
    """Of a sequence of symbols from 2 up; 1 parts stretches, 0 ends the whole."""

    def __init__(self, s: np.ndarray, symbols: int):
        s = np.concatenate([s, [0]]).astype(np.int64)
        order = suffix_array(s)
        self.last = s[order - 1]
        self.tree = WaveletMatrix(self.last, max(1, int(symbols - 1).bit_length()))
        self.less = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=symbols))])
        sampled = order % SAMPLED == 0
        self.sampled, self.before = sampled, np.cumsum(sampled) - sampled
        self.samples = order[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase; phrases are right-aligned."""
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), len(self.last), np.int64)
        for step in range(1, phrases.shape[1] + 1):
            todo = np.flatnonzero((lengths >= step) & (low < high))
            symbol = phrases[todo, -step]
            low[todo] = self.less[symbol] + self.tree.rank(symbol, low[todo])
            high[todo] = self.less[symbol] + self.tree.rank(symbol, high[todo])
        return low, high

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Places of suffix rows: back to a sampled one."""
        row, steps = row.copy(), np.zeros(len(row), np.int64)
        while len(todo := np.flatnonzero(~self.sampled[row])):
            symbol = self.last[row[todo]]
            row[todo] = self.less[symbol] + self.tree.rank(symbol, row[todo])
            steps[todo] += 1
        return self.samples[self.before[row]] + steps


# --- test phrases ----------------------------------------------------------------------

class Phrases:
    """The windows of a block of items: word hashes and numbers, right-aligned phrases, and whose they are."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        words: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            x, starts, ends = words_of(raw, np.array([0, len(raw)]))
            data = x.tobytes()
            ids = [words.setdefault(data[a:b], len(words) + 2) for a, b in zip(starts.tolist(), ends.tolist())]
            for i in range(max(len(ids) - window + 1, min(len(ids), 1))):
                found.setdefault(tuple(ids[i:i + window]), set()).add(name)
        self.words = {n: w for w, n in words.items()}
        self.symbols = len(words) + 2
        self.owners = [sorted(names) for names in found.values()]
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.phrases = np.zeros((len(found), window), np.int64)
        for row, phrase in enumerate(found):
            self.phrases[row, window - len(phrase):] = phrase
        self.texts = [b" ".join(self.words[n] for n in phrase) for phrase in found]
        hashes = np.zeros(len(words), np.uint64)
        if words:
            every = np.frombuffer(b"".join(words), np.uint8)
            ends = np.cumsum([len(w) for w in words])
            hashes = mixed(between(prefixes(every), np.concatenate([[0], ends[:-1]]), ends))
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], np.arange(2, len(words) + 2)[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two words of the benchmark have one hash")

    def numbers_of(self, x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of each word, 0 if the benchmark lacks it; occurrences are compared byte by byte later."""
        if not len(self.hashes) or not len(starts):
            return np.zeros(len(starts), np.int64)
        h = mixed(between(prefixes(x), starts, ends))
        near = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[near] == h, self.numbers[near], 0)

    def occurrences(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends) of all words of the texts, and (first word, phrase) of every occurrence."""
        x, starts, ends = words_of(x, at)
        none = np.zeros(0, np.int64)
        if not len(self.lengths):
            return starts, ends, none, none
        number = self.numbers_of(x, starts, ends)
        # a stretch ends where its text does
        text = np.searchsorted(at, starts, "right")
        edge = np.flatnonzero(np.diff(text)) + 1
        a, b = spans_of(np.insert(number > 0, edge, False))
        a, b = a - np.searchsorted(edge + np.arange(len(edge)), a), b - np.searchsorted(edge + np.arange(len(edge)), b)
        long = b - a >= self.lengths.min()
        a, b = a[long], b[long]
        if not len(a):
            return starts, ends, none, none
        place = ranges(a, b - a + 1)  # one more for the mark between stretches
        mark = np.cumsum(b - a + 1) - 1
        s = number[np.minimum(place, len(number) - 1)]
        s[mark] = 1
        index = FMIndex(s, self.symbols)
        low, high = index.search(self.phrases, self.lengths)
        phrase = np.repeat(np.arange(len(low)), np.maximum(high - low, 0))
        first = place[index.locate(ranges(low, np.maximum(high - low, 0)))]
        right = self._same(x, starts, ends, first, phrase)
        return starts, ends, first[right], phrase[right]

    def _same(self, x, starts, ends, first, phrase) -> np.ndarray:
        data, out = x.tobytes(), np.zeros(len(first), bool)
        lengths = self.lengths[phrase]
        for i, (f, p, n) in enumerate(zip(first.tolist(), phrase.tolist(), lengths.tolist())):
            out[i] = b" ".join([data[a:b] for a, b in zip(starts[f:f + n].tolist(), ends[f:f + n].tolist())]
                               ) == self.texts[p]
        return out


# --- the operator ------------------------------------------------------------------------

_FIELDS = [("__n_words", pa.int64()), ("__spans", pa.list_(pa.int64())), ("__items", pa.list_(pa.string()))]


def _marker(phrases):
    """Adds what one block of the benchmark finds to what earlier ones found; other columns pass unchanged."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = phrases.value
        for batch in blocks(batches):
            x, at = flat(batch.column("text"))
            starts, ends, first, phrase = own.occurrences(x, at)
            bounds = np.searchsorted(starts, at)
            text = np.searchsorted(at, starts[first], "right") - 1
            order = np.argsort(text, kind="stable")
            cut = np.searchsorted(text[order], np.arange(batch.num_rows + 1))
            first, last = first[order], (first + own.lengths[phrase])[order]
            phrase = phrase[order]
            spans, items = batch.column("__spans").to_pylist(), batch.column("__items").to_pylist()
            for i in np.flatnonzero(np.diff(cut)).tolist():
                some = slice(cut[i], cut[i + 1])
                hit = np.zeros(int(bounds[i + 1] - bounds[i]) + 1, np.int64)
                np.add.at(hit, first[some] - bounds[i], 1)
                np.add.at(hit, last[some] - bounds[i], -1)
                flags = np.cumsum(hit[:-1]) > 0
                for known in spans[i]:
                    flags[known >> 32:known & 0xFFFFFFFF] = True
                a, b = spans_of(flags)
                spans[i] = ((a << 32) | b).tolist()
                items[i] = sorted({*items[i], *(n for p in np.unique(phrase[some]) for n in own.owners[p])})
            columns = [batch.column(c) for c in batch.schema.names if c not in dict(_FIELDS)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.diff(bounds)), pa.array(spans, pa.list_(pa.int64())),
                 pa.array(items, pa.list_(pa.string()))],
                schema=pa.schema([*(f for f in batch.schema if f.name not in dict(_FIELDS)), *_FIELDS]))
    return mark


def benchmark_blocks(benchmark: DataFrame, size: int = BENCHMARK_BLOCK) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of about ``size`` bytes, one block on the driver at a time."""
    block, held = [], 0
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"),
                             F.coalesce("text", F.lit("")).alias("text"))
    for row in items.toLocalIterator():
        block.append((row["name"], row["text"]))
        held += len(row["text"]) + 16
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


def mark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
              block_bytes: int = BENCHMARK_BLOCK) -> DataFrame:
    """docs with __n_words, __spans (of words, first << 32 | end, merged) and __items (names of items found)."""
    context = docs.sparkSession.sparkContext
    out = docs.withColumns({"text": F.coalesce("text", F.lit("")), "__n_words": F.lit(0).cast("long"),
                            "__spans": F.array().cast("array<long>"), "__items": F.array().cast("array<string>")})
    schema, number = out.schema, -1
    for number, block in enumerate(benchmark_blocks(benchmark, block_bytes)):
        if number:  # not all blocks in memory at once
            out = written(out, "marked")
        out = out.mapInArrow(_marker(context.broadcast(Phrases(block, window))), schema)
    if number < 0:  # no benchmark: words are counted all the same
        out = out.mapInArrow(_marker(context.broadcast(Phrases([], window))), schema)
    return out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = batch.column("__items").to_pylist()
        spans = [[(s >> 32, s & 0xFFFFFFFF) for s in row] for row in batch.column("__spans").to_pylist()]
        hits = [sum(b - a for a, b in row) for row in spans]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("__n_words"), pa.array(hits, pa.int64()),
             pa.array([len(i) for i in items], pa.int64()),
             pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], pa.string()),
             pa.array([h > 0 for h in hits], pa.bool_())],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row for each row of docs."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return mark_hits(plain, benchmark, window).drop("text").mapInArrow(
        _digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs without any occurrence, with all their columns."""
    marked = mark_hits(docs.withColumn("__text", F.col("text")), benchmark, window)
    return marked.filter(F.size("__spans") == 0).select(*(
        F.col("__text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        x, at = flat(batch.column("text"))
        _, starts, ends = words_of(x, at)
        bounds = np.searchsorted(starts, at)
        data = x.tobytes()
        texts = []
        for i, row in enumerate(batch.column("__spans").to_pylist()):
            own, begin = [], int(at[i])
            for s in row:
                own.append(data[begin:starts[bounds[i] + (s >> 32)]])
                begin = int(ends[bounds[i] + (s & 0xFFFFFFFF) - 1])
            texts.append(b"".join([*own, data[begin:at[i + 1]]]).decode())
        columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in batch.schema.names]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def without_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the merged spans cut out of their texts."""
    marked = mark_hits(docs, benchmark, window)
    return marked.mapInArrow(_cut, marked.schema).select(*(f"`{c}`" for c in docs.columns))
