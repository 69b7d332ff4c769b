"""The corpus pipeline, stage by stage against brute force, on documents with planted cases."""

import base64
import hashlib
import random

import public_tokenizers
import tiktoken

import corpus_pipeline
from shelfcount.llm import quality, queries
from tests.llm.test_duplicates import brute_exact, brute_near, prose
from tests.llm.test_text import ITEMS, brute_hits


def tables(spark, folder):
    r = random.Random(9)
    good = [(i, prose(r.randint(30, 90), 900 + i)) for i in range(150)]
    junk = [(200 + i, " ".join(w + "!!" for w in prose(40, 1200 + i).upper().split())) for i in range(60)]
    base = prose(300, 77).split()
    planted = [(300, good[3][1]), (301, good[3][1].replace(" ", "\n")), (302, " ".join(base)),
               (303, " ".join(base[:150] + ["changed"] + base[151:])), (304, prose(20, 1) + " " + ITEMS[0][1]),
               (305, None), (None, prose(50, 78)), (3, good[3][1]), (306, "x " * 20_000), (307, "")]
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1) for i, t in good + junk + planted],
                          "doc_id long, text string, lang string, source string, n_chars long, kept int"
                          ).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in junk],
                          "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return good, junk


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    good, junk = tables(spark, folder)
    docs = queries.table(spark, folder, "documents")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    before = pairs(docs)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, folder)
        made.write.parquet(f"{folder}/out{number}")
        docs = spark.read.parquet(f"{folder}/out{number}")
        if name == "tokens":
            break
        assert docs.columns == columns
        after = pairs(docs)
        if name == "quality":
            said = quality.predictions(queries.table(spark, folder, "documents"), queries.table(spark, folder, "labels"))
            want = sorted((r["doc_id"] for r in said.collect() if r["predicted"] == 1), key=str)
            assert {i for i, _ in good} <= set(want) and not {i for i, _ in junk} & set(want)
        elif name == "exact":
            want = sorted((d for d, _, _, kept, _ in brute_exact(before) if kept), key=str)
        elif name == "near":
            want = sorted({c for _, _, c in brute_near(before)}, key=str)
        else:
            want = sorted((d for d, *_, hit in brute_hits(before, ITEMS) if not hit), key=str)
        assert sorted((i for i, _ in after), key=str) == want, name
        before = after
    path = public_tokenizers.path(queries.MULTI)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for doc_id, text in before:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()))
    last = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in docs.collect()), key=str)
    assert last == sorted(want, key=str)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in whole.collect()), key=str) == last


def test_an_empty_corpus(spark, tmp_path):
    folder = str(tmp_path)
    tables(spark, folder)
    docs = queries.table(spark, folder, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_near_copies_of_five_words(documents, spark):
    r = random.Random(12)

    def shingles(text):
        w = text.split()
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))}

    docs, gone = [], set()
    for i in range(120):
        base = prose(300, 5000 + i).split()
        copy = list(base)
        for n, at in enumerate(r.sample(range(300), r.randint(1, 12))):
            copy[at] = f"changed{i}n{n}"
        docs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
        a, b = map(shingles, (docs[-2][1], docs[-1][1]))
        if len(a & b) >= 0.8 * len(a | b):
            gone.add(2 * i + 1)
    left = {row.doc_id for row in corpus_pipeline.near_stage(spark, documents(*docs), "").collect()}
    by_print = {c for _, _, c in brute_near(docs)}
    assert 40 < len(gone) < 110 and len(gone & by_print) > 20
    assert left == by_print - gone
