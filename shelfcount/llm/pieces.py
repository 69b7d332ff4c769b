"""Safe boundaries of texts for byte-level BPE, and values kept per piece.

The pattern that splits texts before the merges lets a match hold a space only as its first character or
within a run of white space. So a text may be cut in front of any space that stands between two characters
that are no white space, without a change to its tokens. Words recur: the pieces of a block are numbered,
and what a piece gives is worked out once per worker, in a store of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space in the widest sense that any of the libraries has.
_SPACE = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: Texts in which some space is no boundary.
_UNEVEN = rf"\A | \z| {_SPACE}|{_SPACE} "
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: Characters of pieces that a worker's store holds, and those of a piece that is kept there.
STORE_CHARS = 8 << 20
KEPT_CHARS = 256


class Pieces:
    """Texts in numbered pieces: pieces of text i are ``pieces[index[at[i]:at[i + 1]]]``."""

    def __init__(self, rows: np.ndarray, pieces: list[str], index: np.ndarray, at: np.ndarray):
        self.rows, self.pieces, self.index, self.at = rows, pieces, index, at


def cut(texts: pa.Array) -> Iterator[Pieces]:
    """A column of strings without nulls, in one or two groups of its rows."""
    uneven = pc.match_substring_regex(texts, _UNEVEN)
    rows = np.flatnonzero(~uneven.to_numpy(zero_copy_only=False))
    if len(rows):
        parts = pc.split_pattern(texts.take(pa.array(rows)), " ")
        at = parts.offsets.to_numpy().astype(np.int64)
        flat = parts.flatten()
        heads = flat.take(pa.array(at[:-1] - at[0])).dictionary_encode()
        known = flat.dictionary_encode()
        index = known.indices.to_numpy().astype(np.int64)
        index[at[:-1] - at[0]] = heads.indices.to_numpy() + len(known.dictionary)
        yield Pieces(rows, [" " + p for p in known.dictionary.to_pylist()] + heads.dictionary.to_pylist(),
                     index, at - at[0])
    rows = np.flatnonzero(uneven.to_numpy(zero_copy_only=False))
    if len(rows):
        parts = [_CUT.split(t) for t in texts.take(pa.array(rows)).to_pylist()]
        known = pa.array([p for own in parts for p in own], pa.string()).dictionary_encode()
        yield Pieces(rows, known.dictionary.to_pylist(), known.indices.to_numpy().astype(np.int64),
                     np.concatenate([[0], np.cumsum([len(p) for p in parts])]))


class Store:
    """Values of pieces; ``work`` gives those of a list of pieces that are not in the store."""

    def __init__(self, work: Callable[[list[str]], list], chars: int = STORE_CHARS):
        self.work, self.most, self.known, self.chars = work, chars, {}, 0

    def clear(self) -> None:
        self.known.clear()
        self.chars = 0

    def values(self, pieces: list[str]) -> list:
        known = self.known
        new = [p for p in dict.fromkeys(pieces) if p not in known]
        if self.chars > self.most:
            self.clear()
            new = list(dict.fromkeys(pieces))
        known.update(zip(new, self.work(new)))
        out = [known[p] for p in pieces]
        for piece in new:
            if len(piece) > KEPT_CHARS:
                del known[piece]
            else:
                self.chars += len(piece) + 16
        return out
