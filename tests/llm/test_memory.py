"""What workers and the shared folder hold after a task or a step is done with it."""

import os
import random

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcount import session
from shelfcount.llm import bpe, minhash, queries, textbytes
from tests.llm.test_duplicates import prose


def batches(seed, rows=40):
    r = random.Random(seed)
    texts = [prose(r.randint(0, 60), seed + i) for i in range(rows)] + ["", None, "é\n  a\tb"]
    return [pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())],
                                       names=["doc_id", "text"])]


def test_an_idle_worker_keeps_no_texts(monkeypatch):
    monkeypatch.setattr(bpe, "_ENCODERS", {})
    monkeypatch.setattr(bpe, "IDLE", 0.2)
    path = public_tokenizers.path(queries.MULTI)
    task = bpe._rows(path, public_tokenizers.PATTERN)
    first = list(task(iter(batches(1))))
    (kept,) = bpe._ENCODERS.values()
    held = (kept.words, kept.store.known, kept.vocabulary._spines, kept.vocabulary._sound, *kept.vocabulary._known)
    assert kept.words  # for a task that follows at once
    kept._idle.join(10)
    assert not any(held) and not kept.store.chars and not kept.vocabulary._pairs
    with kept.task():
        ids = list(bpe._id_rows(path, public_tokenizers.PATTERN)(iter(batches(1))))
        kept._idle.join(10)
        assert kept.words and len(bpe._ENCODERS) == 1  # in use: nothing goes
    kept._idle.join(10)
    assert not any(held)
    assert [len(i) for b in ids for i in b.column("ids").to_pylist()] == first[0].column("n_tokens").to_pylist()
    assert list(task(iter(batches(1)))) == first


def test_pieces_that_are_kept_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 500)
    encoder = bpe.Encoder(public_tokenizers.path(queries.MULTI), public_tokenizers.PATTERN)
    for seed in range(20):
        texts = batches(seed, 1)[0].column("text").fill_null("")
        assert encoder.decode(encoder.encode(texts)).to_pylist() == [t.encode() for t in texts.to_pylist()]
        assert len(encoder.store.known) < 150


def test_memory_is_given_back_when_the_texts_of_a_task_end(monkeypatch):
    given = []
    monkeypatch.setattr(textbytes, "give_back", lambda: given.append(1))
    assert sum(b.num_rows for b in textbytes.blocks(iter(batches(2)), size=100)) == 43
    assert given == [1]
    textbytes.prefixes(textbytes.flat(next(textbytes.blocks(iter(batches(3)))).column("text"))[0])
    assert textbytes._powers
    assert list(textbytes.blocks(iter(batches(3)))) and not textbytes._powers
    monkeypatch.undo()
    textbytes.give_back()


def test_copies_that_are_used_up_are_deleted(spark):
    base = prose(300, 7).split()
    texts = [" ".join(base), " ".join(base[:-2] + ["new", "end"]), prose(300, 8), "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select(
        "i", F.coalesce("text", F.lit("")).alias("text")).withColumn("raw", F.xxhash64("text"))
    copies = session._COPIES.setdefault(spark.sparkContext.applicationId, [])
    before = list(copies)
    found = minhash.links(rows, rows.groupBy("raw").agg(F.min("i").alias("print")))
    assert [tuple(sorted(r)) for r in found.collect()] == [(0, 1)]
    new = [c for c in copies if c not in before]
    assert new and not [c for c in new if os.path.basename(c).startswith(("near-", "sets-", "bands-"))]
    folder = session.shared_folder(spark).removeprefix("file:")
    left = {n for n in os.listdir(folder) if n.startswith(("near-", "sets-", "bands-"))}
    assert not left - {os.path.basename(c) for c in before}


def test_each_text_of_the_pairs_is_asked_for_once(spark):
    rows = spark.createDataFrame([(i, prose(40, 50 + i // 2)) for i in range(6)], "raw long, text string")
    one = lambda i: f"named_struct('raw', {i}L, 'root', {i}L)"
    pairs = spark.createDataFrame([(0, 1), (1, 0), (0, 2), (2, 3), (4, 1), (5, 4), (5, 4)], "x long, y long").select(
        F.struct(F.col("x").alias("raw"), F.col("x").alias("root")).alias("a"),
        F.struct(F.col("y").alias("raw"), F.col("y").alias("root")).alias("b"))
    found = minhash._verified(rows, pairs)
    assert sorted(tuple(r) for r in found.collect()) == [(0, 1), (2, 3), (4, 5)]
