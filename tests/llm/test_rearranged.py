"""Fill-in-middle, packing and the Merkle manifest against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from shelfcount.llm import fill_middle, merkle, packing
from tests.llm.conftest import by_id

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "ab Z9<>PSM\n\té漢😀  '-"
ODD = [None, "", " ", "a", "é", "😀", "<P>", "x<S>y", "<", "a<P", "word" * 400, "漢字😀" * 300, "\x00a\x00"]


def random_texts(n, seed=1, size=80):
    dice = random.Random(seed)
    return ["".join(dice.choice(ALPHABET) for _ in range(dice.randrange(size))) for _ in range(n)]


# --- fill-in-middle ------------------------------------------------------------------

def cut_by_hand(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:one]), "".join(units[one:two]), "".join(units[two:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_exceptions_convert_both_ways():
    for text in random_texts(60) + ["", "plain", "漢" * 5, "a😀b"]:
        x = np.frombuffer(text.encode(), np.uint8)
        known = fill_middle.Exceptions(x)
        chars = np.arange(len(text) + 1)
        places = np.array([len(text[:i].encode()) for i in chars])
        assert known.bytes(chars).tolist() == places.tolist()
        assert known.chars(places).tolist() == chars.tolist()
        assert len(known.place) == sum(ord(c) > 127 for c in text)


def test_marks_over_pages():
    dice = np.random.default_rng(3)
    for n in (0, 1, fill_middle.PAGE, 3 * fill_middle.PAGE + 17):
        flags = dice.random(n) < 0.3
        marks, places = fill_middle.Marks(flags), np.flatnonzero(flags)
        assert [marks.place(k) for k in range(0, len(places), 7)] == places[::7].tolist()
        assert [marks.rank(at) for at in range(0, n + 1, 11)] == [int(flags[:at].sum()) for at in range(0, n + 1, 11)]


def test_fill_in_middle_is_what_the_rules_say(documents):
    texts = ODD + random_texts(400) + ["long words and é " * 40_000 + "z"]
    pairs = list(enumerate(texts)) + [(None, "a null id"), (5, texts[5]), (None, None)]
    found = fill_middle.fill_in_middle(documents(*pairs).withColumnRenamed("print", "output"))
    got = by_id(found, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    assert got == sorted((cut_by_hand(i, t) for i, t in pairs), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = fill_middle.restored(found.join(documents(*pairs[:len(texts)]).select("doc_id", "text"), "doc_id"))
    assert back.filter("restored <> coalesce(text, '')").count() == 0 and back.count() >= len(texts)


def test_fill_in_middle_of_nothing(documents):
    empty = documents((1, "a")).filter("false")
    found = fill_middle.digests(empty)
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert found.count() == 0


def test_marker_parts_next_to_a_cut_are_undone():
    for prefix in ("<", "<S", "a<P", ""):
        for middle in ("", "<", "M>"):
            for suffix in (">", "S>", "", "<M"):
                text = prefix + middle + suffix
                if any(m in text for m in ("<P>", "<S>", "<M>")):
                    continue
                for form in ("psm", "spm"):
                    made = fill_middle.joined(form, prefix.encode(), middle.encode(), suffix.encode())
                    assert fill_middle.undone(form, made).decode() == text


# --- packing ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_ids_are_the_librarys(library):
    encode = packing.encoder(PATH)
    points = [*range(0x3400), *range(0xA000, 0xAC00, 3), *range(0xF900, 0x20000, 5), *range(0x20000, 0x110000, 997)]
    texts = [f"a{chr(c)}b1{chr(c)}2!{chr(c)}? {chr(c)}x  {chr(c)} z" for c in points if not 0xD800 <= c < 0xE000]
    texts += random_texts(300) + ["", "<|endoftext|>", "a <|endoftext|> b", "it's  we'll\n\n x", "a" * 3000, " " * 5000]
    for text, known in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False)):
        assert encode(text).tolist() == known.ids, text


def test_long_texts_in_stretches(library, monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 50)
    text = " ".join(random_texts(60, 4)) + "x" * 300 + " " * 200 + "  <|endoftext|> end" * 5
    assert "".join(packing.stretches(text, 50)) == text
    assert packing.encoder(PATH)(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_vocabularies_stay_with_the_library():
    import json

    with open(PATH, encoding="utf-8") as file:
        said = json.load(file)
    assert len(packing._as_ranks(said)) == 50256
    said["model"]["merges"][10:12] = said["model"]["merges"][11:9:-1]
    assert packing._as_ranks(said) is None
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        assert packing._as_ranks(json.load(file)) is None


def check_pieces(rows, expected, length):
    """Every id of every document in exactly one piece, sequences gapless and without padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, n, ids, total, sequence, offset in rows:
        assert n == len(ids) // 4 > 0
        by_doc[doc].append((start, ids, total))
        by_sequence[sequence].append((offset, n))
    assert sorted(by_doc, key=str) == sorted(expected, key=str)
    for doc, parts in by_doc.items():
        assert b"".join(p[1] for p in sorted(parts)) == expected[doc], doc
        ends = np.cumsum([0] + [len(p[1]) // 4 for p in sorted(parts)])
        assert [p[0] for p in sorted(parts)] == ends[:-1].tolist() and {p[2] for p in parts} == {int(ends[-1])}
    for parts in by_sequence.values():
        ends = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == ends[:-1].tolist()
        assert ends[-1] == length or (ends[-1] < length and int(ends[-1]).bit_count() == 1)
    return by_sequence


def test_packs_whole_documents(spark, documents, library):
    texts = ODD + random_texts(200, 7, 400) + [" ".join(random_texts(400, 8))]
    pairs = list(enumerate(texts))
    packed = packing.pack(documents(*pairs).withColumnRenamed("print", "ids").repartition(3), PATH, 64, 256)
    rows = [(r[0], r[1], r[2], bytes(r[3]), *r[4:]) for r in packed.collect()]
    expected = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
                for i, t in pairs}
    check_pieces(rows, expected, 64)


def test_repeated_rows_and_null_ids_are_documents_of_their_own(documents, library):
    packed = packing.pack(documents((1, "same text"), (1, "same text"), (None, "same text"), (None, None)), PATH)
    n = len(library.encode("same text").ids) + 1
    assert packed.groupBy("doc_id").agg(F.sum("length")).collect() is not None
    assert sorted((r[0] or 0, r[1]) for r in packed.groupBy("doc_id").agg(F.sum("length")).collect()) == [
        (0, n + 1), (1, 2 * n)]
    digest = packing.digests(documents((1, "same text")), PATH).collect()
    ids = np.array(library.encode("same text").ids + [1], "<u4").tobytes()
    assert b"".join(ids[4 * r["start"]:4 * (r["start"] + r["length"])] for r in sorted(digest)) == ids
    assert all(r["ids_crc32"] == zlib.crc32(ids[4 * r["start"]:4 * (r["start"] + r["length"])]) for r in digest)
    assert packing.digests(documents((1, "a")).filter("false"), PATH).count() == 0


def pieces_of(sizes):
    return [packing.Piece(i, 0, np.full(n, i, np.uint32), n) for i, n in enumerate(sizes)]


def spread_of(sequences):
    totals = [sum(packing.cost(len(p)) for p in s) for s in sequences if sum(map(len, s)) > 0.9 * packing.LENGTH]
    return float(np.std(totals))


def test_descending_documents_go_where_it_costs_least():
    """Of two long and six short ones, the long ones are parted."""
    full, over = packing.fill([100, 100], pieces_of([70, 70, 10, 10, 10, 10, 10, 10]))
    assert [sorted((len(p) for p in s), reverse=True) for s in full] == [[70, 10, 10, 10]] * 2 and not over


def test_even_costs_with_few_cuts():
    dice = np.random.default_rng(5)
    sizes = np.minimum(np.exp(dice.normal(5.5, 1.2, 4000)).astype(int) + 1, 1500)
    ours = list(packing.sequences(iter(pieces_of(sizes)), pool=64 * packing.LENGTH))
    assert sum(map(len, (p for s in ours for p in s))) == sizes.sum()
    assert len(ours) <= sizes.sum() // packing.LENGTH + 11  # nothing is padded
    cut_in_order = int(sizes.sum()) // packing.LENGTH
    assert sum(len(s) for s in ours) - len(sizes) < 0.4 * cut_in_order
    first_fit, room = [], []
    for piece in sorted(pieces_of(sizes), key=len, reverse=True):
        at = next((i for i, r in enumerate(room) if r >= len(piece)), len(room))
        if at == len(room):
            first_fit.append([])
            room.append(packing.LENGTH)
        first_fit[at].append(piece)
        room[at] -= len(piece)
    assert spread_of(ours) < 0.8 * spread_of(first_fit)


def test_powers_of_two():
    assert packing.powers_of_two(0) == [] and packing.powers_of_two(1500) == [1024, 256, 128, 64, 16, 8, 4]


# --- Merkle manifest ------------------------------------------------------------------

def h(*nodes):
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree_by_hand(nodes):
    """All levels."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return levels


def manifest_by_hand(rows):
    groups = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        own = h(*map(field, (doc_id, source, lang, n_chars, text)))
        hit = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        other = h(*map(field, (doc_id, source, lang, n_chars + 1, text))) if hit else own
        groups[lang].append((doc_id is not None, doc_id or 0, own, other, doc_id))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree_by_hand([r[2] for r in sorted(groups[g])]) for g in langs}
    top = tree_by_hand([trees[g][-1][0] for g in langs])
    out = []
    for at, lang in enumerate(langs):
        for i, (_, _, own, other, doc_id) in enumerate(sorted(groups[lang])):
            siblings, node = [], other
            for place, levels in ((i, trees[lang]), (at, top)):
                for nodes in levels[:-1]:
                    pair = nodes[place ^ 1] if place ^ 1 < len(nodes) else None
                    siblings += [pair] if pair else []
                    node = h(node) if pair is None else h(pair, node) if place & 1 else h(node, pair)
                    place >>= 1
            root = top[-1][0]
            out.append((doc_id, own, trees[lang][-1][0], root, h(*siblings), node, node == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp string, `index` int, node string, n int"


def test_positions_are_those_of_completion():
    for n in range(1, 70):
        for top in {merkle.height(n), merkle.height(n) + 2}:
            order = []
            for i in range(n):
                order.append((0, i))
                for level in range(1, top + 1):
                    if (i + 1) % (1 << level) and i != n - 1:
                        break
                    order.append((level, i >> level))
            assert [merkle.position(level, i, n) for level, i in order] == list(range(len(order)))
            leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
            log = merkle.Log.build(b"".join(leaves), top)
            assert len(log.data) == len(order) * merkle.DIGEST
            for i in {0, n // 2, n - 1}:
                assert merkle.folded(leaves[i], log.path(i)) == log.root()


@pytest.mark.parametrize("level", [1, 2, 10])
def test_manifest_is_what_the_rules_say(frame, level):
    dice = random.Random(level)
    rows = [(i, dice.choice(["s", None, "é"]), "en" if i % 3 else dice.choice(["de", "zh", None, "", "é"]),
             dice.choice([None, i, 10**12]), t) for i, t in enumerate(random_texts(60, 2) + ODD)]
    rows += [rows[3], rows[3], (None, None, None, None, None), (None, "s", "en", 3, "x"), (7, "s", "alone", 1, "y")]
    dice.shuffle(rows)
    docs = frame([(*r, "g", 1, "n", 2) for r in rows], SCHEMA).repartition(4)
    got = by_id(merkle.verified(docs, level), *COLUMNS)
    assert got == manifest_by_hand(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_manifest_of_one_row_and_of_none(frame):
    one = [(1, "s", "en", 3, "abc")]
    docs = frame([(*one[0], "g", 1, "n", 2)], SCHEMA)
    got = by_id(merkle.verified(docs), *COLUMNS)
    assert got == manifest_by_hand(one) and got[0][1] == got[0][3] and got[0][4] == h()
    none = docs.filter("false")
    assert merkle.manifest(none).root is None
    assert merkle.verified(none).columns == COLUMNS and merkle.verified(none).count() == 0


def test_a_stretch_is_small_however_large_the_group(frame):
    """A third of all rows and more in one group: builders get 2**level nodes each."""
    docs = frame([(i, "s", "en" if i % 10 else "de", i, "t", "g", 1, "n", 2) for i in range(1000)], SCHEMA)
    made = merkle.manifest(docs.repartition(5), 4)
    assert made.tiers[0].agg(F.max("size")).first()[0] == 16 and len(made.tiers) == 3
    assert {r[0]: r[1] for r in made.leaves.groupBy("grp").agg(F.count_distinct("index")).collect()} == {"en": 900, "de": 100}


def test_stretches_of_batches():
    rows = [("a", 1), ("a", 1), ("a", 2), (None, 2), (None, 2), ("b", 0)]
    for cut in range(7):
        parts = [p for p in (rows[:cut], rows[cut:]) if p]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in p], pa.string()), pa.array([r[1] for r in p])],
                                              names=["grp", "block"]) for p in parts]
        found = [[tuple(r.values()) for r in t.to_pylist()] for t in merkle._stretches(iter(batches), ["grp", "block"])]
        assert found == [rows[:2], rows[2:3], rows[3:5], rows[5:]]
