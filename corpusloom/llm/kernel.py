"""Text kernels of the training-data operators: folded words and their hashes, on the shared array kernels."""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

from corpusloom.functions.arrays import LETTER, MARK, NUMBER, OTHER, SPACE, blocks, classes, code_points, powers, runs, segment_hashes
from corpusloom.llm.forms import plain

__all__ = ["LETTER", "MARK", "NUMBER", "OTHER", "SPACE", "blocks", "classes", "code_points", "folded", "hash_of", "lowered", "powers", "runs", "segment_hashes", "visible", "without_invisible", "words"]


@cache
def lowered() -> np.ndarray:
    """Lower-case code point of each code point, where that is one code point."""
    out = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x30000):
        low = chr(i).lower()
        if len(low) == 1:
            out[i] = ord(low)
    return out


@cache
def folded() -> np.ndarray:
    """Lower-case look of each code point: full-width and look-alike letters as the Latin ones."""
    out = lowered().copy()
    for i in (*range(0x80, 0x3000), *range(0xA640, 0xA6A0), *range(0xFF00, 0xFFF0), *range(0x1D400, 0x1D800)):
        to = plain(chr(i)).lower()
        if len(to) == 1:
            out[i] = ord(to)
        else:
            composed = unicodedata.normalize("NFC", to)
            if len(composed) == 1:
                out[i] = ord(composed)
    return out


@cache
def visible() -> np.ndarray:
    """Whether a code point is more than an invisible format character."""
    return np.fromiter((unicodedata.category(chr(i)) != "Cf" for i in range(0x110000)), bool, 0x110000)


def without_invisible(cp: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts without their invisible format characters."""
    keep = visible()[cp]
    if keep.all():
        return cp, offs
    count = np.zeros(len(cp) + 1, np.int64)
    np.cumsum(keep, out=count[1:])
    return cp[keep], count[offs]


def words(cp: np.ndarray, offs: np.ndarray, digits: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of letters, marks and (if wanted) digits, and the hashes of their folded form."""
    kind = classes()[cp]
    flags = (kind == LETTER) | (kind == MARK)
    if digits:
        flags |= kind == NUMBER
    starts, ends = runs(flags, offs)
    return starts, ends, segment_hashes(folded()[cp], starts, ends)


def hash_of(word: str) -> int:
    """The hash that ``words`` gives to a word."""
    cp = np.frombuffer(word.encode("utf-32-le"), np.uint32)
    return int(words(cp, np.array([0, len(cp)]))[2][0])
