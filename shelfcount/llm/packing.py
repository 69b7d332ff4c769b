"""Packing: documents as token ids into sequences of a fixed length, balanced by what attention costs.

A document of n tokens costs n + n * n / (6 * ``WIDTH``) units: the layers' products grow with its length, attention
within it with the square. Documents longer than a sequence give whole sequences first; what is left of them and all
others are gathered in pools of ``POOL`` tokens. A pool is dealt out to sequences for three quarters of its tokens: in
descending order, a document goes to the sequence that costs least so far among those with room for it. The quarter
that is over lets small documents fill most gaps; into the last ones documents are cut, the cheapest sequences
first, so every sequence is full. What is over goes to the next pool. At the end of a partition the rest fills
sequences of lengths that are powers of two, which need no padding, the longest first. So nothing is padded at all.

Ids are those of the ``tokenizers`` library. Where a file is plain byte-level BPE whose merges are in the order of
their ids, the same vocabulary runs in ``tiktoken``, which is several times faster; the tests compare both over all
code points. Long texts are encoded in stretches that end at safe boundaries; a stretch without one, and any other
kind of file, goes to ``tokenizers``.

Null and empty texts are one piece with the closing id only. Repeated rows, null ids too, are documents of their
own. An empty table gives no pieces. Other columns are ignored. A partition is packed by itself, in the memory of
one pool and the largest document's ids; a task that is run again gives the same pieces under the same numbers.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.llm.textbytes import blocks

#: Tokens of a sequence.
LENGTH = 2048
#: The id that closes a document: fixed by the contract.
CLOSING = 1
#: Width of the model whose attention is balanced.
WIDTH = 2048
#: Tokens that are dealt out together.
POOL = 512 * LENGTH
#: The part of a pool that is dealt out at a time: a smaller one cuts fewer documents, and leaves costs less even.
SHARE = 0.75
#: Characters that are encoded at a time.
STRETCH = 1 << 17
#: Bytes of ids in an Arrow batch.
BATCH_BYTES = 4 << 20


# --- token ids ---------------------------------------------------------------------

_SAFE = re.compile(r"(?<=\S)(?= \S)")
# Fixed pattern of byte-level BPE in its first published form.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The text cut in front of single spaces, where no token crosses, about every ``size`` characters."""
    first = 0
    while len(text) - first > size:
        found = _SAFE.search(text, first + size)
        if not found:
            break
        yield text[first:found.start()]
        first = found.start()
    yield text[first:]


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if visible, else one above 255."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _as_ranks(said: dict) -> dict[bytes, int] | None:
    """Vocabulary as ranks of byte strings, if the file is byte-level BPE and a merge's rank is its id's order."""
    model, splits = said["model"], said.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and splits.get("type") == "ByteLevel" and splits.get("use_regex", True)
             and not splits.get("add_prefix_space") and not said.get("normalizer") and not model.get("dropout")
             and not model.get("ignore_merges") and not model.get("byte_fallback")
             and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] or not t["special"]
                         for t in said.get("added_tokens") or []))
    if not plain:
        return None
    special = {t["content"] for t in said.get("added_tokens") or []}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    merged = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    letters = _byte_letters()
    if (None in merged or any(a >= b for a, b in zip(merged, merged[1:])) or len(merged) + 256 != len(vocabulary)
            or not all(set(t) <= letters.keys() for t in vocabulary)):
        return None
    return {bytes(letters[c] for c in t): i for t, i in vocabulary.items()}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """A function that gives a text's ids as the ``tokenizers`` library does, without special tokens added."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()

    def by_library(text: str) -> np.ndarray:
        return np.array(library.encode(text, add_special_tokens=False).ids, np.uint32)

    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    ranks = _as_ranks(said)
    if ranks is None:
        return by_library
    import tiktoken

    special = {t["content"]: t["id"] for t in said.get("added_tokens") or []}
    fast = tiktoken.Encoding("ranks", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens=special)

    def ids(text: str) -> np.ndarray:
        parts = [np.array(fast.encode(s, allowed_special="all"), np.uint32) if len(s) < 2 * STRETCH else by_library(s)
                 for s in stretches(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)
    return ids


_ENCODERS: dict[str, Callable[[str], np.ndarray]] = {}


# --- dealing out ---------------------------------------------------------------------

@dataclass
class Piece:
    """Ids of a document from ``start`` on; ``total`` is the document's number of tokens."""

    doc: int | None
    start: int
    ids: np.ndarray
    total: int

    def __len__(self) -> int:
        return len(self.ids)

    def split(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.start, self.ids[:n], self.total),
                Piece(self.doc, self.start + n, self.ids[n:], self.total))


def cost(n: np.ndarray | int, width: int = WIDTH):
    """Work on a document of n tokens, in units of a token's linear work."""
    return n + n * n / (6.0 * width)


def fill(lengths: list[int], pieces: list[Piece], width: int = WIDTH) -> tuple[list[list[Piece]], list[Piece]]:
    """Sequences of exactly these lengths, cheapest first, and the pieces that are over.

    ``pieces`` have at least as many tokens as all lengths together.
    """
    room, spent = np.array(lengths, np.int64), np.zeros(len(lengths))
    out: list[list[Piece]] = [[] for _ in lengths]
    over = []
    for piece in sorted(pieces, key=lambda p: (-len(p), p.doc is not None, p.doc, p.start)):
        n = len(piece)
        at = int(np.where(room >= n, spent, np.inf).argmin()) if len(room) else 0
        if not len(room) or room[at] < n:
            over.append(piece)
            continue
        out[at].append(piece)
        room[at] -= n
        spent[at] += cost(n, width)
    over.reverse()  # the longest last, to be taken first
    for at in np.argsort(spent, kind="stable"):
        while room[at]:
            piece = over.pop()
            if len(piece) > room[at]:
                piece, rest = piece.split(int(room[at]))
                over.append(rest)
            out[at].append(piece)
            room[at] -= len(piece)
    return out, over


def powers_of_two(n: int) -> list[int]:
    """The powers of two that make up n, the largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def sequences(documents: Iterator[Piece], length: int = LENGTH, pool: int = POOL,
              width: int = WIDTH) -> Iterator[list[Piece]]:
    """Documents in sequences: of ``length`` tokens, and at the end of powers of two."""
    held: list[Piece] = []
    size = 0
    for piece in documents:
        while len(piece) >= length:
            whole, piece = piece.split(length)
            yield [whole]
        if len(piece):
            held.append(piece)
            size += len(piece)
        if size >= pool:
            full, held = fill([length] * int(size * SHARE // length), held, width)
            size = sum(map(len, held))
            yield from full
    full, held = fill([length] * (size // length) + [n for n in powers_of_two(size % length)], held, width)
    yield from full


# --- the operator ------------------------------------------------------------------------

PACKED = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, `offset` long")


def _packed(path: str, length: int, pool: int, width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[Piece]:
        if path not in _ENCODERS:  # once per worker
            _ENCODERS[path] = encoder(path)
        closing = np.array([CLOSING], np.uint32)
        for batch in blocks(batches):
            texts = pc.fill_null(batch.column("text"), "")
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts):
                ids = np.concatenate([_ENCODERS[path](text.as_py()), closing])
                yield Piece(doc, 0, ids, len(ids))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        rows, size = [], 0
        for sequence in sequences(documents(batches), length, pool, width):
            offset = 0
            for piece in sequence:
                rows.append((piece.doc, piece.start, len(piece), piece.ids.astype("<u4").tobytes(), piece.total,
                             number, offset))
                offset += len(piece)
            number += 1
            size += 4 * offset
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return pack


def pack(docs: DataFrame, path: str, length: int = LENGTH, pool: int = POOL, width: int = WIDTH) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset), one row for each piece; ids are little-endian
    unsigned 32-bit numbers. No shuffle."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _packed(path, length, pool, width), PACKED)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)"""
    return pack(docs, path).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                                   "sequence_id", "offset")
