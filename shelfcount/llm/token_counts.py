"""Token counts: batch encoding in Arrow functions that return lengths only.

Batches hold about as many bytes each. Texts are cut at safe boundaries, which also bounds what the library
gets at a time however long a text is; pieces that recur are encoded once per worker.

Null texts are empty and have no tokens.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.llm.pieces import Store, cut
from shelfcount.llm.textbytes import blocks, flat

#: Tokens that a document may have before it is marked.
LIMIT = 1024
#: Characters that the library encodes at a time.
BATCH_CHARS = 1 << 20
#: Bytes of text whose pieces are numbered together.
AT_A_TIME = 4 << 20


def balanced(pieces: list[str], size: int = BATCH_CHARS) -> Iterator[list[str]]:
    """The pieces in batches of about ``size`` characters."""
    batch, held = [], 0
    for piece in pieces:
        batch.append(piece)
        held += len(piece) + 8
        if held >= size:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


def counter(path: str) -> Callable[[pa.Array], np.ndarray]:
    """A function of a column of texts that gives their numbers of tokens, by the library for this kind of file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: np.array([len(model.encode(t, num_threads=1)) for t in texts.to_pylist()], np.int64)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def lengths(texts: list[str]) -> list[int]:
        return [len(e) for batch in balanced(texts) for e in
                tokenizer.encode_batch_fast(batch, add_special_tokens=False)]

    if not _safe_to_cut(path):
        return lambda texts: np.array(lengths(texts.to_pylist()), np.int64)
    store = Store(lengths)

    def count(texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        for group in cut(texts):
            each = np.array(store.values(group.pieces), np.int64)[group.index]
            out[group.rows] = np.add.reduceat(each, group.at[:-1])
        return out
    return count


def _safe_to_cut(path: str) -> bool:
    """Whether the boundaries of ``pieces`` hold: byte-level BPE as it is, and no special token with a space."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    splits = said.get("pre_tokenizer") or {}
    return (splits.get("type") == "ByteLevel" and splits.get("use_regex", True)
            and not splits.get("add_prefix_space") and not said.get("normalizer")
            and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                        for t in said.get("added_tokens") or []))


_COUNTERS: dict[str, Callable[[pa.Array], np.ndarray]] = {}


def _rows(path: str, limit: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:  # once per worker
            _COUNTERS[path] = counter(path)
        for batch in blocks(batches, size=AT_A_TIME):
            tokens = _COUNTERS[path](pc.fill_null(batch.column("text"), ""))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(flat(batch.column("text"))[1])),
                 pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return count


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row for each row of docs; no shuffle."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _rows(path, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
