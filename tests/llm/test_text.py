"""Benchmark passages, tokens, quality, licences, URL lists and page texts, held against brute force."""

import base64
import datetime
import hashlib
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfcount.llm import bpe, decontaminate, extract, licences, quality, queries, token_counts, url_lists
from tests.llm.conftest import by_id
from tests.llm.test_duplicates import prose

ODD = ["", "  ", " a", "a  b", "\x1c a \x1c", "a\x85 b\xa0 c", "\n\n a \t\tb's'll  ", "日本語テキスト ２３ ½", "🙂🙂 x" * 5,
       "a" * 3000, " " * 500 + "x", "<|endoftext|> x", "a \n b", "x 　y", "It's we'll I'D 12 345%%% x--y", None]
LETTERS = st.text("aab \n\t'sé日🙂1½_-\x1c\x85\xa0 thing", max_size=60)


# --- benchmark passages --------------------------------------------------------------

def brute_hits(docs, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = {}
    for name, text in items:
        w = words(text)
        for i in range(max(len(w) - window + 1, min(len(w), 1))):
            windows.setdefault(tuple(w[i:i + window]), set()).add("" if name is None else str(name))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                names = windows.get(tuple(w[i:i + n]))
                if names:
                    hit.update(range(i, i + n))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, prose(40, 50)), (2, prose(25, 51)), (10, prose(25, 51)), (3, "tiny item, really"), (4, ""), (5, None),
         (6, "the the the the the the the the the the the"), (None, prose(12, 52)), (7, prose(9, 53)), (1, prose(40, 50))]


def contaminated():
    one = ITEMS[0][1].split()
    docs = [(0, prose(100, 60)), (1, prose(30, 61) + ". " + ITEMS[0][1].upper() + "! " + prose(30, 62)),
            (2, " ".join(one[:9])), (3, " ".join(one[:10])), (4, "--".join(one[5:17])), (5, ITEMS[1][1]), (6, ""),
            (7, None), (8, "a TINY item: really?"), (9, "the " * 30), (10, ITEMS[8][1]), (11, ITEMS[7][1] + " " + one[0]),
            (None, " ".join(one[20:])), (12, "tiny item"), (13, "really tiny item")]
    return docs + [(20 + i, prose(60, 70 + i)) for i in range(40)] + [(3, " ".join(one[:10]))]


@pytest.mark.parametrize("block", [1 << 22, 200])
def test_hits_are_those_of_brute_force(spark, documents, block):
    docs = contaminated()
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, doc_id string")
    marked = decontaminate.mark_hits(documents(*docs).select("doc_id", "text"), items, block_bytes=block)
    got = marked.drop("text").mapInArrow(decontaminate._digest, decontaminate_schema())
    assert by_id(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == brute_hits(docs, ITEMS)


def decontaminate_schema():
    return "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def test_clean_documents_stay_as_they_are(spark, documents):
    docs = contaminated()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.clean(documents(*docs), items)
    assert kept.columns == documents().columns
    want = sorted(((d, t) for (d, t) in docs if not brute_hits([(d, t)], ITEMS)[0][-1]), key=str)
    assert by_id(kept, "doc_id", "text") == want
    cut = decontaminate.without_passages(documents(*docs), items)
    assert not any(r[-1] for r in brute_hits(by_id(cut.filter("doc_id IN (1, 4, 5, 8)"), "doc_id", "text"), ITEMS))


def test_no_benchmark_and_no_documents(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert by_id(decontaminate.contamination(documents((1, "a b")), none), "n_words", "contaminated") == [(2, False)]
    assert decontaminate.contamination(documents().limit(0), none).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(2, 4), min_size=1, max_size=60), st.lists(st.integers(2, 5), min_size=1, max_size=4))
def test_index_finds_all_places(s, phrase):
    index = decontaminate.FMIndex(np.array(s), 6)
    low, high = index.search(np.array([phrase]), np.array([len(phrase)]))
    got = sorted(index.locate(np.arange(low[0], max(low[0], high[0]))).tolist())
    assert got == [i for i in range(len(s)) if s[i:i + len(phrase)] == phrase]


# --- tokens ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    path = public_tokenizers.path(queries.MULTI)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(public_tokenizers.path(queries.MULTI), public_tokenizers.PATTERN)


@settings(max_examples=150, deadline=None)
@given(st.lists(LETTERS, max_size=5))
def test_ids_are_those_of_the_library(library, encoder, texts):
    ids = encoder.encode(pa.array(texts, pa.string()))
    assert ids.to_pylist() == [library.encode_ordinary(t) for t in texts]
    assert encoder.decode(ids).to_pylist() == [t.encode() for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=40), st.integers(0, 40), st.integers(0, 40), st.binary(max_size=8))
def test_edits_and_appends_are_exact(encoder, data, a, b, new):
    a, b = sorted((min(a, len(data)), min(b, len(data))))
    table = bpe.PrefixTable(encoder.vocabulary, data)
    table.replace(a, b, new)
    table.append(b"ing")
    want = data[:a] + new + data[b:] + b"ing"
    assert table.data == want and table.tokens() == encoder.vocabulary.merged(want)


def test_encode_and_decode(documents, library):
    docs = [*enumerate(ODD), (None, "null id"), (3, ODD[3])]
    path, pattern = public_tokenizers.path(queries.MULTI), public_tokenizers.PATTERN
    want = []
    for doc_id, text in docs:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    got = bpe.encode_decode(documents(*docs), path, pattern)
    assert by_id(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)
    back = bpe.decode(bpe.encode(documents(*docs), path, pattern), path)
    assert by_id(back, "doc_id", "text") == sorted(((i, t or "") for i, t in docs), key=str)
    assert bpe.encode_decode(documents().limit(0), path, pattern).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_those_of_the_library(documents, name):
    path = public_tokenizers.path(name)
    docs = [*enumerate(ODD), (None, prose(900, 80) + " <|endoftext|>"), (3, ODD[3])]
    if name.endswith(".json"):
        t = Tokenizer.from_file(path)
        count = lambda s: len(t.encode(s, add_special_tokens=False))
    else:
        import sentencepiece
        count = sentencepiece.SentencePieceProcessor(model_file=path).encode
        count = (lambda f: lambda s: len(f(s)))(count)
    want = [(i, len((s or "").encode()), count(s or ""), count(s or "") > 1024) for i, s in docs]
    got = token_counts.token_counts(documents(*docs), path)
    assert by_id(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=str)


@settings(max_examples=100, deadline=None)
@given(st.lists(LETTERS, min_size=1, max_size=4))
def test_boundaries_are_safe(texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    count = token_counts._COUNTERS.setdefault(path, token_counts.counter(path))
    assert count(pa.array(texts)).tolist() == [len(t.encode(s, add_special_tokens=False)) for s in texts]


# --- quality -----------------------------------------------------------------------------

def test_quality_is_learnt_and_held_out(spark, documents):
    docs = [(i, prose(60, i) if i % 3 else " ".join(w + "***" for w in prose(60, i).split())) for i in range(300)]
    odd = [(1000, ""), (1001, None), (None, prose(50, 1)), (1002, "word " * 30_000), (5, docs[5][1])]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 300)] + [(None, 1, 0), (7, None, 0), (9999, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.predictions(documents(*docs, *odd), labels)
    rows = got.collect()
    assert len(rows) == 305 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    import zlib
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 300]
    assert sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) >= 0.95 * len(held)
    kept = quality.accepted(documents(*docs), labels)
    assert kept.columns == documents().columns and 150 < kept.count() < 250
    assert quality.predictions(documents().limit(0), labels).count() == 0
    assert {r.score for r in quality.predictions(documents(*docs), labels.limit(0)).collect()} == {0.5}


def test_features_do_not_depend_on_neighbours():
    texts = [prose(20, i).encode() for i in range(5)] + [b"", b" x ", b"A b"]
    at = np.cumsum([0, *map(len, texts)])
    bucket, bounds = quality.features(np.frombuffer(b"".join(texts), np.uint8), at)
    for i, t in enumerate(texts):
        alone = quality.features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
        assert alone.tolist() == bucket[bounds[i]:bounds[i + 1]].tolist()


# --- licences and URL lists ------------------------------------------------------------------

def test_licences(documents):
    docs = [(1, "Prose. Licensed under the Apache License, Version 2.0."), (2, "Released under the MIT License.\nMore."),
            (3, "All rights reserved.\nThis work is licensed under the GNU General Public License, version 3."),
            (4, "No licence here"), (5, ""), (None, None), (6, "all  RIGHTS reserved\n\n" * 3), (7, "x. " * 20_000),
            (8, "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                "compliance with the License. You may obtain a copy of the License at\nhttp://x"), (1, "Prose.")]
    got = {(r[0], r[1]): r[2] for r in by_id(licences.scan(documents(*docs)), "doc_id", "n_known", "licences")}
    assert got == {(1, 1): "Apache-2.0", (1, 0): "", (2, 1): "MIT", (3, 2): "all-rights-reserved-then-GPL-3.0", (4, 0): "",
                   (5, 0): "", (None, 0): "", (6, 3): "all-rights-reserved", (7, 0): "", (8, 3): "Apache-2.0"}


def test_every_known_sentence_is_found(documents):
    known = list(licences.SENTENCES.items())
    mit = ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
           'documentation files (the "Software"), to deal in the Software without restriction. ')
    docs = [(i, f"Prose. {s.capitalize()}.") for i, (s, _) in enumerate(known)]
    docs += [(100, mit + 'The software is provided "as is", without warranty of any kind.'), (101, mit)]
    got = {r.doc_id: (r.sentences, r.licences) for r in licences.scan(documents(*docs)).collect()}
    assert [got[i][0] for i in range(len(known))] == [name for _, name in known]
    assert got[100] == ("MIT-GRANT,AS-IS", "MIT") and got[101] == ("MIT-GRANT", "MIT")
    texts = pa.table({"doc_id": [i for i, _ in docs], "text": [t for _, t in docs]})
    con = duckdb.connect()
    con.register("documents", texts)
    want = con.execute(licences.oracle()).fetchall()
    assert {r[0]: (r[2], r[3]) for r in want} == got


def test_url_lists_against_brute_force(spark):
    r = random.Random(3)
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    names = ["a.b.org", "b.org", "a.b.org/x", "a.b.org/x/y", "c.net", "org", "x.c.net/q", "a.b.org/x/y/z/1/2/3", "a.b.org/x/y/z/1"]
    changes = [(f"l{r.randint(0, 1)}", r.choice(names), day(r.randint(0, 200)), r.random() < .6) for _ in range(150)]
    changes += [(None, "b.org", day(1), True), ("l0", None, day(1), True), ("l0", "b.org", None, True)]
    urls = ["http://a.b.org/x/y/z?q=/w", "http://a.b.org/x/y/z/1/2/3", "http://a.b.org/x//y/z/1/", "https://u:p@A.B.org:80/x", "http://c.net", "ftp://x.c.net/q#f", "no url", "", None,
            "http://d.com/x"]
    captures = [(i, r.choice(urls), day(r.randint(0, 240))) for i in range(300)] + [(None, urls[0], day(9)), (4, None, None),
                                                                                   (5, urls[0], None)]

    def active(lst, entry, at):
        past = [c for c in changes if c[0] == lst and c[1] == entry and c[2] is not None and c[2] <= at]
        if not past:
            return False
        last = max(c[2] for c in past)
        return all(c[3] for c in past if c[2] == last)

    def entries(url):
        m = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", url or "")
        if not m:
            return []
        host, path = m[1].lower(), re.match(r"[^:]+://[^/?#]*([^?#]*)", url)[1]
        labels, parts = host.split("."), [p for p in path.split("/") if p]
        return {".".join(labels[i:]) for i in range(max(len(labels) - 1, 1))} | {
            host + "/" + "/".join(parts[:i]) for i in range(1, len(parts) + 1)}

    want = []
    for key, url, at in captures:
        hits = [(lst, e) for lst in ("l0", "l1") for e in entries(url) if at and active(lst, e, at)]
        want.append((key, url, at, len(hits), ",".join(sorted({x for x, _ in hits}))))
    got = url_lists.evaluate(spark.createDataFrame(captures, "page_id long, url string, fetched date"),
                             spark.createDataFrame(changes, "list string, entry string, day date, added boolean"))
    assert by_id(got, "page_id", "url", "fetched", "n_entries", "lists") == sorted(want, key=str)


def test_url_lists_of_nothing(spark):
    captures = spark.createDataFrame([(1, "http://a.org/x", datetime.date(2024, 1, 1))], "page_id long, url string, fetched date")
    changes = spark.createDataFrame([("l", "a.org", datetime.date(2023, 1, 1), True)],
                                    "list string, entry string, day date, added boolean")
    assert url_lists.evaluate(captures.filter("false"), changes).count() == 0
    assert [tuple(r)[3:] for r in url_lists.evaluate(captures, changes.filter("false")).collect()] == [(0, "")]
    assert [tuple(r)[3:] for r in url_lists.evaluate(captures, changes).collect()] == [(1, "l")]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    want = db.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))


# --- page texts ----------------------------------------------------------------------------------

def page(body, title="T &amp; t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><script>var a='<p>no';</script></head><body>{body}</body></html>"


def test_main_text(spark):
    article = "<article><h1>Head &amp; tail</h1><p>One\n  two<br>three&nbsp;four <b>bold</b><p>Next &lt;p&gt;</article>"
    shells = [
        "<nav><ul><li><a href=/x>menu</a></ul></nav>{}<footer>foot</footer>",
        "<header><p>site</p></header><div class='cookie-notice'>Cookies!</div>{}<section id=comments><p>I agree</section>",
        "{}<aside>side</aside><form><label>f</label></form><!-- <p>hidden</p> --><div class=ad>buy",
        "<div class='sidebar left'>links</div><style>p{{}}</style>{}<div class=share-buttons>share"]
    rows = [(i, f"http://h{i // 4}.org/{i}", page(s.format(article))) for i, s in enumerate(shells)]
    want = "Head & tail\n\nOne two three four bold\n\nNext <p>"
    plain = "<div class=top>{}</div><div class=body><div class=text><p>{}</p><p>{}</p></div></div><div class=end>short</div>"
    rows += [(20 + i, "http://plain.org/", page(plain.format(f"m{i}", prose(30, i), prose(20, 40 + i)))) for i in range(6)]
    rows += [(40, None, None), (41, "bad", ""), (None, "http://h0.org", page(article)), (42, "http://h9.org/", "just text"),
             (43, "http://h0.org/", page(article)[:-40]), (40, None, None), (44, "http://h8.org/", "<div>" * 5000 + "deep")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, main int")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in extract.extract(frame).collect()}
    assert {k[0]: v[0] for k, v in got.items() if k[0] in range(4)} == dict.fromkeys(range(4), want)
    assert all(n == len(t) for t, n in got.values())
    for i in range(6):
        assert got[20 + i, "http://plain.org/"][0] == f"{prose(30, i)}\n\n{prose(20, 40 + i)}"
    assert got[40, None] == ("", 0) and got[41, "bad"] == ("", 0) and got[None, "http://h0.org"][0] == want
    assert got[42, "http://h9.org/"][0] == "just text" and got[44, "http://h8.org/"][0] == "deep"
    assert extract.extract(frame).count() == len(rows) and extract.extract(frame.limit(0)).count() == 0


def test_an_unmarked_article_keeps_all_its_blocks(spark):
    shell = "<div class=top>site {}</div><div class=body><div class=text>{}</div></div><div class=end>short</div>"

    def paragraphs(i):
        return [prose(40, 100 + i), prose(40, 200 + i)]

    def mixed(i):
        one, two = paragraphs(i)
        return (f"<h1>Head {i}</h1><p>{one}</p><ul><li>item {i}<li>other {i}</ul><blockquote>said {i}</blockquote>"
                f"<div class=more><p>{two}</p></div><table><tr><th>k {i}<td>v {i}</table><pre>code {i}</pre>loose {i}")

    def mixed_text(i):
        one, two = paragraphs(i)
        return [f"Head {i}", one, f"item {i}", f"other {i}", f"said {i}", two, f"k {i}", f"v {i}", f"code {i}", f"loose {i}"]

    rows = [(i, "http://mixed.org/", page(shell.format(i, mixed(i)))) for i in range(6)]
    want = {i: mixed_text(i) for i in range(6)}
    for i in range(10, 16):  # a host whose pages are lists, but for one
        entries = [f"{n} {prose(8, 10 * i + n)}" for n in range(8)]
        body = f"<h2>List {i}</h2><ul><li>" + "<li>".join(entries) + f"</ul><p>after {i}</p>"
        rows.append((i, "http://lists.org/", page(shell.format(i, body))))
        want[i] = [f"List {i}", *entries, f"after {i}"]
    rows.append((16, "http://lists.org/", page(shell.format(16, mixed(16)))))
    want[16] = mixed_text(16)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text.split("\n\n") for r in extract.extract(frame).collect()} == want


def test_text_that_does_not_vary_is_left_out(spark):
    shells = [  # the second and third are layouts of under half of the host; no slot of the third holds most of the text
        "<div class=q1><ul><li>Home<li>About us</ul></div><div class=q2><p>{}</p><p>{}</p></div><div class=q3>(c) Acme</div>",
        "<div class=r1><p>Read our rules</p></div><div class=r2><h2>Story</h2><p>{}</p><p>{}</p></div><div class=r3>Acme</div>",
        "<div class=s1>{}</div><div class=s2>Write to us</div><div class=s3>{}</div>"]
    rows, want = [], {}
    for i in range(20):
        layout = 0 if i < 11 else 1 if i < 16 else 2
        one, two = prose(30, 500 + i), prose(30, 600 + i)
        rows.append((i, "http://layouts.org/", page(shells[layout].format(one, two))))
        want[i] = (["Story"] if layout == 1 else []) + [one, two]
    rows += [(30 + i, "http://copies.org/", rows[0][2]) for i in range(4)]  # copies of one page have no template text
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n\n") for r in extract.extract(frame).collect()}
    assert {i: got[i] for i in range(20)} == want
    assert all(set(want[0]) <= set(got[30 + i]) for i in range(4))


def test_classes_nest_from_the_outside_in():
    a, b = (5, 9), (3, 1)
    tokens = [(0, 0, 0, 5, a, 0), (1, 0, 0, 5, a, 0), (2, 1, 2, 5, a, 50), (3, 1, 0, 5, a, 10), (4, 3, 0, 3, b, 90),
              (6, 99, 0, 3, (7, 7), 500)]
    paths, main = extract.deduce(tokens, 5)
    assert paths == [0, 1, 2, 3, 4] and main == [4]


ARTICLE = "<h1>Head</h1>" + "".join(f"<p>Sentence {i} of the article.</p>" for i in range(6))
ARTICLE_TEXT = ["Head", *(f"Sentence {i} of the article." for i in range(6))]


@pytest.mark.parametrize("body", [
    f'<main class="layout-sidebar">{ARTICLE}</main>',
    f'<article class="social-policy">{ARTICLE}</article>',
    f'<main class="layout-sidebar"><article class="notice">{ARTICLE}</article></main>',
    f'<form id="aspnetForm"><article>{ARTICLE}</article></form>',
    f'<form id="aspnetForm"><div id="text">{ARTICLE}</div><select><option>One</option></select></form>',
    f'<div class="main-banner"><main>{ARTICLE}<div class="share">Share this</div></main></div>',
    f'<div class="sidebar"><article class="teaser"><p>Other</p></article></div><article class="notice">{ARTICLE}</article>'])
def test_an_article_is_not_left_out_by_its_class_or_a_form(spark, body):
    html = page(f'<nav><p>Home</p></nav>{body}<footer><p>End</p></footer>')
    frame = spark.createDataFrame([(i, f"https://one.example/{i}", html) for i in range(3)],
                                  "page_id long, url string, html string")
    assert extract.main_text(html, set()).split("\n\n") == ARTICLE_TEXT
    assert {r.text for r in extract.extract(frame).collect()} == {"\n\n".join(ARTICLE_TEXT)}


def test_comments_and_teasers_are_never_the_article():
    long = "<p>Much text of somebody else, longer than the article of the page.</p>" * 9
    text = "<div><p>The article.</p></div>"
    for other in (f'<div class="comments"><article>{long}</article></div>', f'<article class="comment">{long}</article>',
                  f"<aside><article>{long}</article></aside>", f'<div class="related"><main>{long}</main></div>',
                  "<form><label>Name of the one who asks for it</label><button>Send</button></form>"):
        assert extract.main_text(page(text + other), set()) == "The article."


def test_list_items_close_across_many_inline_elements():
    html = page("<article><ul><li>" + "<b>" * 20 + "one<li>two</ul></article>")
    assert [e.depth for w, e, _ in extract.walk(html) if w == "open" and e.name == "li"] == [5, 5]
