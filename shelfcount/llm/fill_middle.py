"""Fill-in-middle: texts rearranged so that a model learns to fill a gap.

A text is cut into units (a run of ASCII letters, or one other character) and its units into prefix, middle and
suffix at two places drawn from the document's id. Texts stay UTF-8 bytes throughout. Where units begin is read
off the bytes; a cut is a byte position, and its code point position comes from a sparse exception index that
knows only the characters of more than one byte: their positions, and how many bytes of excess they have had so
far. A binary search in it converts either way; between two exceptions, and in a text without any, the two
positions differ by a constant.

Forms: psm is ``<P>``prefix``<S>``suffix``<M>``middle, spm is ``<S>``suffix``<P>``prefix``<M>``middle, plain is the
text itself. Texts that hold a marker are left plain, so each output can be undone.

Null texts are empty, and empty texts are plain with no units. A null id draws as an empty one. Repeated rows are
drawn alike, each gives its row. An empty table gives no rows. Other columns are ignored, whatever their names.
A long text is handled by itself, in some ten times its bytes; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcount.llm.textbytes import blocks, flat

# Fixed values of the contract.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Out of a hundred documents, those that are rearranged, and out of a hundred of these, those with suffix first.
RATE, SPM_RATE = 90, 20

PAGE = 4096
#: Bytes of text in an Arrow batch of either direction.
AT_A_TIME = 1 << 20


class Exceptions:
    """The characters of UTF-8 bytes that take more than one: byte positions, and excess bytes up to each."""

    def __init__(self, x: np.ndarray):
        self.place = np.flatnonzero(x >= 0xC0).astype(np.int64 if len(x) >> 31 else np.int32)
        lead = x[self.place]
        more = 1 + (lead >= 0xE0).astype(np.int8) + (lead >= 0xF0)
        #: Excess bytes of the first i exceptions.
        self.excess = np.concatenate([[0], np.cumsum(more, dtype=self.place.dtype)])

    def chars(self, at: np.ndarray) -> np.ndarray:
        """Code points in front of byte positions, which have to be boundaries of characters."""
        at = np.asarray(at, np.int64)
        return at - self.excess[np.searchsorted(self.place, at)]

    def bytes(self, at: np.ndarray) -> np.ndarray:
        """Byte positions of code point positions."""
        at = np.asarray(at, np.int64)
        return at + self.excess[np.searchsorted(self.place - self.excess[:-1], at)]


class Marks:
    """Set flags of an array, counted and found by page, so that no list of them is made."""

    def __init__(self, flags: np.ndarray):
        self.flags = flags
        pages = -(-len(flags) // PAGE)
        each = [np.count_nonzero(flags[i * PAGE:(i + 1) * PAGE]) for i in range(pages)]
        self.before = np.concatenate([[0], np.cumsum(each, dtype=np.int64)]).astype(np.int64)

    def rank(self, at: int) -> int:
        """Set flags in front of a place."""
        page = at // PAGE
        return int(self.before[page]) + int(np.count_nonzero(self.flags[page * PAGE:at]))

    def place(self, k: int) -> int:
        """Place of the set flag number k."""
        page = int(np.searchsorted(self.before, k, "right")) - 1
        own = np.flatnonzero(self.flags[page * PAGE:(page + 1) * PAGE])
        return page * PAGE + int(own[k - int(self.before[page])])


def unit_starts(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Flags of the bytes at which units begin; ``rows`` are the places at which texts do."""
    letter = ((x | 0x20) >= 0x61) & ((x | 0x20) <= 0x7A)
    starts = (x & 0xC0) != 0x80
    again = letter[1:] & letter[:-1]  # inside a run of letters
    again[rows[(rows > 0) & (rows < len(x))] - 1] = False
    starts[1:] &= ~again
    return starts


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in range(0, 32, 8))


def joined(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    if form == PSM:
        return b"".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])
    if form == SPM:
        return b"".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])
    return prefix


def undone(form: str, output: bytes) -> bytes:
    """The text that ``joined`` was given: the text holds no marker, so the first of each kind is the one put in."""
    if form == PLAIN:
        return output
    second = SUFFIX if form == PSM else PREFIX
    one, two = output.index(second, len(PREFIX)), output.index(MIDDLE, len(PREFIX))
    first, other, middle = output[len(PREFIX):one], output[one + len(second):two], output[two + len(MIDDLE):]
    return first + middle + other if form == PSM else other + middle + first


def _rearranged(rate: int, spm_rate: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output", pa.string())])

    def rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, size=AT_A_TIME):
            x, at = flat(batch.column("text"))
            known, marks = Exceptions(x), Marks(unit_starts(x, at))
            whole, rows = x.tobytes(), []
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                begin, end = int(at[i]), int(at[i + 1])
                base = marks.rank(begin)
                n = marks.rank(end) - base
                h1, h2, h3, h4 = draws(doc_id)
                text = whole[begin:end]
                if not text or h3 % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
                    rows.append((doc_id, n, PLAIN, None, None, text))
                    continue
                units = sorted((h1 % (n + 1), h2 % (n + 1)))
                one, two = (marks.place(base + u) if u < n else end for u in units)
                chars = known.chars(np.array([begin, one, two]))
                form = SPM if h4 % 100 < spm_rate else PSM
                rows.append((doc_id, n, form, int(chars[1] - chars[0]), int(chars[2] - chars[1]),
                             joined(form, whole[begin:one], whole[one:two], whole[two:end])))
            *columns, outputs = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)] + [pa.array(outputs, pa.binary()).cast(pa.string())],
                schema=schema)
    return rearrange


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row for each row of docs."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _rearranged(rate, spm_rate), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def _undone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "output", AT_A_TIME):
        x, at = flat(batch.column("output"))
        whole, forms = x.tobytes(), batch.column("form").to_pylist()
        texts = [undone(form, whole[at[i]:at[i + 1]]) for i, form in enumerate(forms)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())],
                                         names=[*batch.schema.names, "restored"])


def restored(outputs: DataFrame) -> DataFrame:
    """With the text (restored) that each output was made of, from output and form alone."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema.fields)
    return outputs.mapInArrow(_undone, f"{fields}, restored string")


def sha256(column: str) -> Column:
    return F.sha2(F.col(column).cast("binary"), 256)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)"""
    return restored(fill_in_middle(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha256("output").alias("output_sha256"),
        sha256("restored").alias("restored_sha256"))
