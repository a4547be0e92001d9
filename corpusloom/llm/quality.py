"""Statistics of a text's quality and the structure of its parts.

A text's blocks (parts between blank lines; the short ones of a text count as one) are described
by two distributions: function words by kind, for each language, and character classes. A block
is assigned the profile with the least sum of both Jensen-Shannon divergences: prose of a
language, or list, table or junk of some make.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.kernel import SPACE, blocks, classes, hash_of, runs, without_invisible, words
from corpusloom.session import arrow_function

# Function words by language and kind: determiners, prepositions, conjunctions, verbs, pronouns and adverbs.
FUNCTION_WORDS = {
    "en": (
        "the a an any all each every no this that these those its his her their our your such another",
        "of to in for on by with at from under upon within without between after before during against per into over",
        "and or if where when unless although because while whether so than as but until once",
        "is are was were be been has have had may must shall will should would could can cannot does do did ought might",
        "it he she they you we who which what there not only also",
    ),
    "de": (
        "der die das den dem des ein eine einen einem einer eines diese dieser",
        "von zu in im an am auf für mit nach vor bei aus über unter gegen durch innert zur zum bis",
        "und oder wenn dass ob sowie als wie soweit",
        "ist sind war wird werden hat haben kann darf muss soll sollte müsste",
        "er sie es sich nicht auch nur",
    ),
    "fr": (
        "le la les l un une des du ce cette ces son sa ses leur",
        "de d à au aux en dans par pour sur sous avec sans selon avant après dès contre",
        "et ou si que lorsque sauf",
        "est sont a ont être peut doit devra pourra entend",
        "il elle se qui dont ne pas",
    ),
    "el": (
        "ο η το οι τα του της των τον την τους τις ένα μια",
        "σε στο στη στην στα στις από για με κατά μετά προς πριν υπό χωρίς εντός εκτός",
        "και ή αν όταν ότι ως",
        "είναι έχει μπορεί πρέπει θα να",
        "που δεν μη αυτό λοιπά",
    ),
    "bg": (
        "този тази това тези един една",
        "на в във за от по с със при до към без под над след преди освен",
        "и или ако че като както",
        "е са има може трябва следва да ще",
        "се си не който която което най",
    ),
}
KINDS = 6
# Shares of the kinds of function words, then of other words, in prose by language.
PROSE_WORDS = {
    "en": (0.14, 0.14, 0.05, 0.07, 0.02, 0.58),
    "de": (0.15, 0.13, 0.02, 0.03, 0.03, 0.64),
    "fr": (0.14, 0.17, 0.02, 0.03, 0.02, 0.62),
    "el": (0.20, 0.12, 0.03, 0.06, 0.02, 0.57),
    "bg": (0.01, 0.22, 0.03, 0.10, 0.04, 0.60),
}
PLAIN_WORDS = (0.004, 0.004, 0.004, 0.004, 0.004, 0.98)
# Character classes: lower case, upper case, digit, blank, line end, stop or comma, other punctuation, symbol.
# Shares of the character classes in each structure.
PROSE_CHARACTERS = (0.80, 0.02, 0.005, 0.15, 0.005, 0.015, 0.004, 0.001)
STRUCTURES = {
    "list:items": (0.68, 0.11, 0.03, 0.11, 0.05, 0.01, 0.01, 0.00),
    "list:numbered": (0.52, 0.07, 0.15, 0.14, 0.06, 0.05, 0.01, 0.00),
    "list:keywords": (0.77, 0.06, 0.00, 0.10, 0.00, 0.06, 0.01, 0.00),
    "table:delimited": (0.45, 0.07, 0.26, 0.06, 0.03, 0.12, 0.01, 0.00),
    "table:spaced": (0.36, 0.05, 0.15, 0.35, 0.03, 0.03, 0.03, 0.00),
    "table:ruled": (0.20, 0.04, 0.12, 0.20, 0.05, 0.00, 0.24, 0.15),
    "table:numbers": (0.01, 0.00, 0.75, 0.17, 0.03, 0.04, 0.00, 0.00),
    "table:contents": (0.35, 0.07, 0.07, 0.10, 0.03, 0.37, 0.01, 0.00),
    "junk:log": (0.30, 0.10, 0.40, 0.08, 0.03, 0.04, 0.05, 0.00),
    "junk:encoded": (0.40, 0.40, 0.15, 0.00, 0.01, 0.00, 0.02, 0.02),
    "junk:citations": (0.42, 0.07, 0.22, 0.17, 0.02, 0.06, 0.04, 0.00),
    "junk:dates": (0.00, 0.00, 0.63, 0.12, 0.00, 0.20, 0.05, 0.00),
    "junk:noise": (0.30, 0.04, 0.03, 0.18, 0.00, 0.12, 0.20, 0.13),
    "junk:garbled": (0.45, 0.12, 0.02, 0.09, 0.00, 0.00, 0.07, 0.25),
    "junk:markup": (0.45, 0.05, 0.12, 0.05, 0.03, 0.08, 0.20, 0.02),
}
#: Words below which a block is pooled with the other short ones of its text.
SHORT_WORDS = 6
_LF = 0x0A
_RETURNS = (
    "struct<words: long, mean_word_length: double, symbol_ratio: double, lines: long, terminated_lines: double, "
    "common_words: double, language: string, profile: string, prose_share: double, list_share: double, table_share: double, junk_share: double>"
)


@cache
def _character_class() -> np.ndarray:
    first = {"Ll": 0, "Lo": 0, "Lm": 0, "Mn": 0, "Mc": 0, "Me": 0, "Lu": 1, "Lt": 1, "Nd": 2, "Nl": 2, "No": 7, "Zs": 3, "Zl": 4, "Zp": 4}
    out = np.empty(0x110000, np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))
        out[i] = first.get(kind, 6 if kind[0] == "P" else 7)
    out[[ord(c) for c in ".,;:!?'’"]] = 5
    out[[ord(c) for c in "\n\r\x85"]] = 4
    out[ord("\t")] = 3
    return out


@cache
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of all function words, and for each and each language its kind."""
    table: dict[int, list[int]] = {}
    for k, kinds in enumerate(FUNCTION_WORDS.values()):
        for kind, text in enumerate(kinds):
            for word in text.split():
                table.setdefault(hash_of(word), [KINDS - 1] * len(FUNCTION_WORDS))[k] = kind
    keys = np.array(sorted(table), np.uint64)
    return keys, np.array([table[int(h)] for h in keys], np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence in bits of each row of p and each row of q."""
    p, q = p[:, None, :], q[None, :, :]
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return terms.sum(2) / 2


def _lines(cp: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the non-blank lines, and whether a blank line or a text's start precedes each."""
    starts, ends = runs(cp != _LF, offs)
    ink = np.zeros(len(cp) + 1, np.int64)
    np.cumsum(classes()[cp] != SPACE, out=ink[1:])
    full = ink[ends] > ink[starts]
    starts, ends = starts[full], ends[full]
    if len(starts) == 0:
        return starts, ends, np.zeros(0, bool)
    feeds = np.zeros(len(cp) + 1, np.int64)
    np.cumsum(cp == _LF, out=feeds[1:])
    doc = np.searchsorted(offs, starts, "right")
    new = np.ones(len(starts), bool)
    new[1:] = (feeds[starts[1:]] - feeds[ends[:-1]] > 1) | (doc[1:] != doc[:-1])
    return starts, ends, new


def describe(cp: np.ndarray, offs: np.ndarray) -> list[np.ndarray | list]:
    """The columns of the statistics for a block of texts."""
    cp, offs = without_invisible(cp, offs)
    n, langs = len(offs) - 1, list(FUNCTION_WORDS)
    starts, ends, new = _lines(cp, offs)
    w_start, w_end, w_hash = words(cp, offs, digits=False)
    w_doc = np.searchsorted(offs, w_start, "right") - 1
    keys, kinds = _kinds()
    at = np.minimum(np.searchsorted(keys, w_hash), len(keys) - 1)
    w_kind = np.where((keys[at] == w_hash)[:, None], kinds[at], KINDS - 1)
    # blocks, the short ones of a text as one
    first = np.flatnonzero(new)
    b_start, b_end = starts[first], np.append(ends[first[1:] - 1], ends[-1:]) if len(first) else ends[:0]
    b_doc = np.searchsorted(offs, b_start, "right") - 1
    count = np.searchsorted(w_start, b_end) - np.searchsorted(w_start, b_start)
    spaces = np.zeros(len(cp) + 1, np.int64)
    np.cumsum(classes()[cp] == SPACE, out=spaces[1:])
    tokens = spaces[b_end] - spaces[b_start] + 1
    short = (count < SHORT_WORDS) & (tokens < SHORT_WORDS) & (b_end - b_start < 60)
    group = np.where(short, b_doc, n + np.arange(len(b_start)))
    names, of = np.unique(group, return_inverse=True)
    g = len(names)
    g_doc = np.zeros(g, np.int64)
    g_doc[of] = b_doc
    weight = np.bincount(of, b_end - b_start, g)
    edge = np.zeros(len(cp) + 1, np.int32)
    edge[b_start] += 1
    edge[b_end] -= 1
    inside = np.cumsum(edge[:-1]) > 0
    step = np.zeros(len(cp) + 1, np.int32)
    step[b_start] = 1
    c_block = np.cumsum(step[:-1]) - 1
    c_class = _character_class()[cp[inside]].astype(np.int64)
    chars = np.bincount(of[c_block[inside]] * 8 + c_class, minlength=g * 8).reshape(g, 8).astype(float)
    chars /= np.maximum(chars.sum(1, keepdims=True), 1)
    w_group = of[np.searchsorted(b_start, w_start, "right") - 1] if len(b_start) else w_start
    fit = np.empty((g, len(langs)))
    none = np.empty((g, len(langs)))
    for k, lang in enumerate(langs):
        p = np.bincount(w_group * KINDS + w_kind[:, k], minlength=g * KINDS).reshape(g, KINDS).astype(float)
        p[:, -1] += p.sum(1) == 0
        p /= p.sum(1, keepdims=True)
        both = divergence(p, np.array([PROSE_WORDS[lang], PLAIN_WORDS]))
        fit[:, k], none[:, k] = both[:, 0], both[:, 1]
    by_chars = divergence(chars, np.array([PROSE_CHARACTERS, *STRUCTURES.values()]))
    prose = fit.min(1) + by_chars[:, 0]
    others = none.max(1)[:, None] + by_chars[:, 1:]
    best = others.argmin(1)
    is_prose = prose <= others.min(1)
    family = np.array([("list", "table", "junk").index(s.split(":")[0]) for s in STRUCTURES])[best]
    label = np.where(is_prose, 3, family)
    shares = np.bincount(g_doc * 4 + label, weight, n * 4).reshape(n, 4)
    total = np.maximum(shares.sum(1), 1)
    common = w_kind.min(1) < KINDS - 1 if len(w_kind) else np.zeros(0, bool)
    n_words = np.bincount(w_doc, minlength=n)
    lang_hits = np.stack([np.bincount(w_doc, w_kind[:, k] < KINDS - 1, n) for k in range(len(langs))], 1)
    size = np.diff(offs)
    c_doc = np.repeat(np.arange(n), size)
    kind = _character_class()[cp]
    symbols = np.bincount(c_doc, kind == 7, n)
    inked = np.maximum(np.bincount(c_doc, classes()[cp] != SPACE, n), 1)
    l_doc = np.searchsorted(offs, starts, "right") - 1
    l_last = cp[np.maximum(ends - 1, 0)] if len(cp) else cp
    stop = np.isin(l_last, [ord(c) for c in '.!?:;。"”)'])
    n_lines = np.bincount(l_doc, minlength=n)
    order = np.stack([shares[:, 3], shares[:, 0], shares[:, 1], shares[:, 2]], 1).argmax(1)
    language = [langs[k] if hit else None for k, hit in zip(lang_hits.argmax(1), lang_hits.max(1) > 0)]
    profile = [None if s == 0 else (f"prose:{language[i]}" if order[i] == 0 and language[i] else ("prose", "list", "table", "junk")[order[i]]) for i, s in enumerate(shares.sum(1))]
    return [
        n_words,
        np.bincount(w_doc, w_end - w_start, n) / np.maximum(n_words, 1),
        symbols / inked,
        n_lines,
        np.bincount(l_doc, stop, n) / np.maximum(n_lines, 1),
        np.bincount(w_doc, common, n) / np.maximum(n_words, 1),
        language,
        profile,
        shares[:, 3] / total,
        shares[:, 0] / total,
        shares[:, 1] / total,
        shares[:, 2] / total,
    ]


def _statistics(texts: pa.Array) -> pa.Array:
    types = [pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.string(), *[pa.float64()] * 4]
    names = [x.split(":")[0].strip() for x in _RETURNS[7:-1].split(", ")]
    parts = [describe(cp, offs) for cp, offs in blocks(texts)]
    return pa.StructArray.from_arrays([pa.array([v for part in parts for v in part[k]], t) for k, t in enumerate(types)], names)


def text_statistics(df: DataFrame, text: str = "text", name: str = "quality") -> DataFrame:
    """The table with a struct ``name`` of quality statistics for each text; a column of that name is replaced.

    Counts, ratios, the share of common words, the most likely language, the nearest structural
    profile and the shares of characters in prose, list, table and junk. A null, empty or blank
    text has zero counts and shares and a null language and profile. Repeated rows stay.
    """

    def measure(texts: pa.Array) -> pa.Array:
        return _statistics(texts)

    return df.withColumn(name, arrow_function(df.sparkSession, measure, _RETURNS)(F.col(text)))


def not_prose(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Keys of the rows most of whose characters stand in lists, tables or junk."""
    q = text_statistics(df.select(key, text), text).filter("quality.list_share + quality.table_share + quality.junk_share > 0.5")
    return q.filter(F.col(key).isNotNull()).select(key).distinct()
