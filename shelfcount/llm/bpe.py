"""Byte-level BPE encoding by prefix dynamic programming, and decoding.

Each prefix of a piece has one valid encoding, and so one last token. A table keeps it for every prefix: of
the tokens that end at a byte, the one that may follow the last token of the prefix in front of it. Two tokens
may follow each other if the merges, applied to their joined bytes, give just these two; and an encoding is
right if every neighbouring pair is. The table grows byte by byte, so appends are exact without a new start,
and after an edit only the prefixes from the edit on are worked out again, up to where the tables agree.

Null texts are empty: no tokens, digests of nothing. Special tokens are not looked for.
"""

from __future__ import annotations

import base64
import hashlib
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.llm.pieces import KEPT_CHARS, Store, cut
from shelfcount.llm.textbytes import blocks, give_back, ranges

#: Pairs of tokens whose answer is kept in a worker.
KEPT_PAIRS = 400_000
#: Bytes of text whose pieces are numbered together.
AT_A_TIME = 2 << 20
#: Stands for the last token of the empty prefix.
START = -1
#: Words whose ids are kept in a worker.
KEPT_WORDS = 150_000
#: Characters of the pieces whose ids are kept in a worker, besides those of their words.
KEPT_PIECES = 4 << 20
#: Seconds after a task in which the worker may get another one that has use of what is kept.
IDLE = 2.0


class Vocabulary:
    """Ranks of a byte-level BPE: token bytes to id, merged in the order of their ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {n: t for t, n in ranks.items()}
        self.sizes = {n: len(t) for t, n in ranks.items()}
        self.longest = max(map(len, ranks))
        automaton = ahocorasick.Automaton()
        self._known, self._pairs = [], 0
        for token, number in ranks.items():
            self._known.append({})
            automaton.add_word(token.decode("latin-1"), (len(token), number, self._known[-1]))
        automaton.make_automaton()
        #: (place of the last byte, (size, token, what it may follow as far as known)) of every token in a text of
        #: one character per byte, by that place
        self.matches = automaton.iter
        self._sound: dict[int, bool] = {}
        self._spines: dict[int, tuple] = {}
        self.ordered = True  # no token met so far has a lower rank than its parts

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """A rank file: base64 of the bytes and the id on each line."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(t): int(n) for t, n in map(bytes.split, lines)})

    def merged(self, data: bytes) -> list[int]:
        """By the definition: merge the pair of least rank, the leftmost of equals, until none is left."""
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            _, at = min((ranks.get(a + b, len(ranks) * 2), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if parts[at] + parts[at + 1] not in ranks:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _edges(self, token: int) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]]:
        """How the token grows at its left and its right end: each part there, and the rank that takes it in."""
        known = self._spines.get(token)
        if known is None:
            whole, never = self.tokens[token], len(self.ranks) * 2
            parts = [whole[i:i + 1] for i in range(len(whole))]
            left, right = [], []
            while len(parts) > 1:
                rank, at = min((self.ranks.get(a + b, never), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if at == 0:
                    left.append((parts[0], rank))
                if at == len(parts) - 2:
                    right.append((parts[-1], rank))
                if any(self.ranks[p] >= rank for p in parts[at:at + 2] if len(p) > 1):
                    self.ordered = False
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            known = self._spines[token] = ([*left, (whole, never)], [*right, (whole, never)])
        return known

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the merges keep the two apart; left may be START.

        Merges are made in the order of rank, so a pair of parts across the boundary is merged if its rank
        comes before those that take either part into its own token; of equal ranks the leftmost is first.
        """
        if not self.sound(right):
            return False
        if left == START:
            return True
        ends, begins = self._edges(left)[1], self._edges(right)[0]
        if not self.ordered:  # a token has a lower rank than its parts: by the definition
            return self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        return not any((rank := self.ranks.get(a + b)) is not None and rank < until_a and rank <= until_b
                       for a, until_a in ends for b, until_b in begins)

    def learn(self, left: int, right: int, known: dict[int, bool]) -> bool:
        """The same, kept for the next time."""
        self._pairs += 1
        if self._pairs > KEPT_PAIRS:
            self._forget_pairs()
        known[left] = fits = self.may_follow(left, right)
        return fits

    def _forget_pairs(self) -> None:
        self._pairs = 0
        for each in self._known:
            each.clear()

    def forget(self) -> None:
        """What was worked out so far goes; the ranks stay."""
        self._forget_pairs()
        self._spines.clear()
        self._sound.clear()

    def sound(self, token: int) -> bool:
        """Whether the merges can make this token of its own bytes."""
        known = self._sound.get(token)
        if known is None:
            known = self._sound[token] = self.merged(self.tokens[token]) == [token]
        return known

    def encode(self, data: bytes) -> list[int]:
        """Ids of one piece. A piece that is a token is that token, as the library has it."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else PrefixTable(self, data).tokens()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixTable:
    """The last token of every prefix of a piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data = vocabulary, b""
        self.last: list[int] = [START]  # of the prefix of each length
        self.append(data)

    def append(self, data: bytes) -> None:
        """Further bytes; what is there stays as it is."""
        v, last, done = self.vocabulary, self.last, len(self.data)
        self.data += data
        first = max(0, done - v.longest + 1)  # no token that ends later begins before
        for at, (size, token, known) in v.matches(self.data[first:].decode("latin-1")):
            if at + first == done:  # else in front of the new bytes, or solved by a longer token
                before = last[done + 1 - size]
                fits = known.get(before)
                if fits is None:
                    fits = v.learn(before, token, known)
                if fits:
                    last.append(token)
                    done += 1
        if done < len(self.data):
            raise ValueError(f"no token ends with byte {self.data[done]}")

    def replace(self, begin: int, end: int, new: bytes) -> None:
        """An edit: prefixes in front of it keep their token, and so do those behind it once the tables agree."""
        old, shift = self.last, len(new) - (end - begin)
        tail = self.data[end:]
        self.data, self.last = self.data[:begin], old[:begin + 1]
        self.append(new)
        alike = 0
        while alike < len(tail) and len(self.data) < begin + len(new) + len(tail):
            self.append(tail[alike:alike + 1])
            alike += 1
            # a token looks back no further than the longest one: from here on nothing differs any more
            at = len(self.last)
            if alike >= self.vocabulary.longest and (
                    self.last[at - self.vocabulary.longest:] == old[at - shift - self.vocabulary.longest:at - shift]):
                self.data += tail[alike:]
                self.last += old[at - shift:]
                return

    def tokens(self) -> list[int]:
        """Ids of the whole, from the last token back."""
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end])
            end -= self.vocabulary.sizes[out[-1]]
        return out[::-1]


class Encoder:
    """Columns of texts to ids and back, with one vocabulary and one pattern."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary, self.split = Vocabulary.read(path), regex.compile(pattern)
        self.words: dict[str, tuple[int, ...]] = {}
        self._tasks, self._lock, self._idle = 0, threading.Lock(), None
        self.store = Store(self._of_pieces, KEPT_PIECES)
        most = max(self.vocabulary.tokens) + 1
        self.bytes_of = pa.array([self.vocabulary.tokens.get(n, b"") for n in range(most)], pa.binary())
        self.names = pa.array([str(n) for n in range(most)], pa.string())

    def _of_pieces(self, pieces: list[str]) -> list[tuple[int, ...]]:
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        words, split, out = self.words, self.split.findall, []
        for piece in pieces:
            ids = ()
            for word in split(piece):
                own = words.get(word)
                if own is None:
                    own = tuple(self.vocabulary.encode(word.encode()))
                    if len(word) <= KEPT_CHARS:
                        words[word] = own
                ids += own
            out.append(ids)
        return out

    @contextmanager
    def task(self) -> Iterator[None]:
        """While a task uses it. What is kept of the texts goes if none does so again soon: the worker may serve other
        operators next."""
        with self._lock:
            self._tasks += 1
            if self._idle is not None:
                self._idle.cancel()
        try:
            yield
        finally:
            with self._lock:
                self._tasks -= 1
                self._idle = threading.Timer(IDLE, self.forget)
                self._idle.daemon = True
                self._idle.start()

    def forget(self) -> None:
        """What is kept of the texts so far goes, if no task uses it."""
        with self._lock:
            if self._tasks:
                return
            self.words.clear()
            self.store.clear()
            self.vocabulary.forget()
        give_back()

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text; no nulls."""
        count, kept = np.zeros(len(texts), np.int64), []
        for group in cut(texts):
            values = self.store.values(group.pieces)
            size = np.fromiter(map(len, values), np.int64, len(values))
            flat_ids = np.fromiter(chain.from_iterable(values), np.int32, int(size.sum()))
            n = size[group.index]
            kept.append((group.rows, flat_ids[ranges((np.cumsum(size) - size)[group.index], n)]))
            count[group.rows] = np.add.reduceat(n, group.at[:-1])
        at = np.concatenate([[0], np.cumsum(count)])
        ids = np.zeros(int(at[-1]), np.int32)
        for rows, own in kept:
            ids[ranges(at[rows], count[rows])] = own
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The bytes that lists of ids stand for."""
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.bytes_of.take(ids.values)), b"")

    def joined(self, ids: pa.ListArray) -> pa.Array:
        """Lists of ids as text."""
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.names.take(ids.values)), ",")


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:  # once per worker
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def _sha256(column: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(v.as_buffer()).hexdigest() for v in column], pa.string())


def _rows(path: str, pattern: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _encoder(path, pattern)
        with run.task():
            for batch in blocks(batches, size=AT_A_TIME):
                ids = run.encode(pc.fill_null(batch.column("text"), ""))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pc.list_value_length(ids).cast(pa.int64()), _sha256(run.joined(ids)),
                     _sha256(run.decode(ids))], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return encode


def encode_decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row for each row of docs; no shuffle."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _rows(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _id_rows(path: str, pattern: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _encoder(path, pattern)
        with run.task():
            for batch in blocks(batches, size=AT_A_TIME):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), run.encode(pc.fill_null(batch.column("text"), ""))], names=["doc_id", "ids"])
    return encode


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids)"""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _id_rows(path, pattern), "doc_id long, ids array<int>")


def _text_rows(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.read(path)
        for batch in batches:
            texts = [vocabulary.decode(i or []).decode("utf-8", "replace") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])
    return decode


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null lists are empty."""
    return encoded.select("doc_id", "ids").mapInArrow(_text_rows(path), "doc_id long, text string")
