"""Token counts under an existing byte-level BPE, and their roll-up by source, language and type.

A text is cut into pieces; the piece's tokens are counted by merging its bytes. The pieces of
a batch are found by array operations, each distinct piece is merged once per worker (a linked
symbol list with a priority queue of merges) and its count is weighted by its frequency.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.labels import language_label, source_label, type_label
from corpusloom.llm.kernel import MARK, OTHER, SPACE, blocks, classes, segment_hashes
from corpusloom.session import arrow_function

VOCABULARY = os.environ.get("CORPUSLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Distinct pieces whose counts a worker keeps; beyond it the store starts anew.
KEPT_PIECES = 2_000_000
_SPACE, _QUOTE = 0x20, 0x27
_SHORT, _LONG = [ord(c) for c in "stmd"], [(ord("r"), ord("e")), (ord("v"), ord("e")), (ord("l"), ord("l"))]


def read_vocabulary(path: str) -> dict[bytes, int]:
    """Ranks by byte string, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merged_symbols(piece: bytes, ranks: dict[bytes, int]) -> int:
    """Symbols left of a piece when every merge of the vocabulary is done, lowest rank first, leftmost first."""
    n = len(piece)
    if n < 2 or piece in ranks:
        return min(n, 1)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    queue = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(queue)
    left, alive = n, [True] * n
    while queue:
        _, i, to = heapq.heappop(queue)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != to:
            continue
        alive[j], end[i], after[i] = False, to, after[j]
        if after[j] < n:
            before[after[j]] = i
        left -= 1
        if after[i] < n and (r := ranks.get(piece[i : end[after[i]]])) is not None:
            heapq.heappush(queue, (r, i, end[after[i]]))
        if (h := before[i]) >= 0 and (r := ranks.get(piece[h:to])) is not None:
            heapq.heappush(queue, (r, h, to))
    return left


def pieces(cp: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Starts of the pieces into which the pattern of byte-level BPE cuts the texts, in order.

    The pattern: contractions of English; letters, numbers or other characters with one blank
    before them; white space, of which the last character goes with what follows.
    """
    n = len(cp)
    kind = classes()[cp]
    kind[kind == MARK] = OTHER
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    first = offs[:-1][offs[:-1] < offs[1:]]
    start[first] = True
    last = np.zeros(n, bool)
    last[first - 1] = True
    last[-1] = True
    space = kind == SPACE
    tail = np.zeros(n, bool)  # a white-space character before another kind in the same text
    tail[:-1] = space[:-1] & ~space[1:]
    tail &= ~last
    at = np.flatnonzero(tail)
    start[at] = True
    joined = at[cp[at] == _SPACE] + 1
    start[joined] = False
    quote = np.flatnonzero((cp == _QUOTE) & start)
    room = np.searchsorted(offs, quote, "right")
    stop = offs[np.minimum(room, len(offs) - 1)]
    for size in (2, 3):
        q = quote[quote + size <= stop]
        c1 = cp[q + 1]
        hit = np.isin(c1, _SHORT) if size == 2 else np.any([(c1 == a) & (cp[np.minimum(q + 2, n - 1)] == b) for a, b in _LONG], axis=0)
        q = q[hit]
        start[q + 1] = False
        after = q + size
        inside = after[(after < n)]
        start[inside] = True
    return np.flatnonzero(start)


class PieceCounter:
    """Counts the tokens of texts; made once for each worker."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.known = ranks, {}

    def counts(self, cp: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        if len(cp) == 0:
            return np.zeros(len(offs) - 1, np.int64)
        starts = pieces(cp, offs)
        ends = np.append(starts[1:], len(cp))
        keys, at, of = np.unique(segment_hashes(cp, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > KEPT_PIECES:
            self.known.clear()
        known, sizes = self.known, np.empty(len(keys), np.int64)
        for k, (key, i) in enumerate(zip(keys.tolist(), at.tolist())):
            size = known.get(key)
            if size is None:
                text = cp[starts[i] : ends[i]].tobytes().decode("utf-32-le", "replace")
                size = known[key] = merged_symbols(text.encode("utf-8"), self.ranks)
            sizes[k] = size
        total = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(sizes[of], out=total[1:])
        edge = np.searchsorted(starts, offs)
        return total[edge[1:]] - total[edge[:-1]]


_counters: dict[str, PieceCounter] = {}
_shared: dict[tuple[str, str], Broadcast] = {}


def worker_counter(vocabulary: str, ranks: Broadcast) -> PieceCounter:
    """This worker's counter for a vocabulary, kept between tasks."""
    if vocabulary not in _counters:
        _counters[vocabulary] = PieceCounter(ranks.value)
    return _counters[vocabulary]


def shared_ranks(spark: SparkSession, vocabulary: str) -> Broadcast:
    """The vocabulary's ranks, broadcast once for each application; the file's size bounds them."""
    key = (spark.sparkContext.applicationId, vocabulary)
    if key not in _shared:
        _shared[key] = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    return _shared[key]


def token_count(spark: SparkSession, text: Column | str, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a text column under the tokenizer whose vocabulary file is at ``vocabulary``.

    Null counts 0 tokens, as does the empty text. The vocabulary's size bounds what is broadcast.
    """
    ranks = shared_ranks(spark, vocabulary)

    def count(texts: pa.Array) -> pa.Array:
        counter = worker_counter(vocabulary, ranks)
        return pa.array(np.concatenate([np.zeros(0, np.int64), *(counter.counts(cp, offs) for cp, offs in blocks(texts))]))

    return arrow_function(spark, count, "long")(F.col(text) if isinstance(text, str) else text)


def with_tokens(df: DataFrame, text: str = "text", name: str = "tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """The table with its texts' token counts in column ``name``; a column of that name is replaced."""
    return df.withColumn(name, token_count(df.sparkSession, text, vocabulary))


def token_budget(tables: Sequence[DataFrame], vocabulary: str = VOCABULARY) -> DataFrame:
    """Documents and tokens by source, language and type, with subtotals, over tables that have ``text``.

    ``level`` names what a line stands for: slice, source, language, type or total. Labels are
    brought to one spelling; a missing column or value is UNKNOWN (language: ``und``).
    Copies count as often as they are stored. Empty tables give no lines but the total.
    """
    rows = None
    for df in tables:
        names = {c.lower() for c in df.columns}
        lang = next((c for c in ("lang", "language") if c in names), None)
        part = df.select(
            source_label("source" if "source" in names else F.lit(None).cast("string")).alias("source"),
            language_label(lang or F.lit(None).cast("string")).alias("language"),
            type_label("type" if "type" in names else F.lit(None).cast("string")).alias("type"),
            token_count(df.sparkSession, "text", vocabulary).alias("tokens"),
        )
        rows = part if rows is None else rows.unionByName(part)
    keys = ["source", "language", "type"]
    cells = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))
    sets = cells.groupingSets([[F.col(k) for k in keys], *[[F.col(k)] for k in keys], []], *keys)
    level = F.element_at(F.array(*map(F.lit, ("slice", "", "", "source", "", "language", "type", "total"))), F.grouping_id().cast("int") + 1)
    return sets.agg(level.alias("level"), F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))


def misestimated(accepted: DataFrame, vocabulary: str = VOCABULARY, factor: float = 2.0) -> DataFrame:
    """Ids whose ``estimated_tokens`` is null, or off by more than ``factor`` either way, each once.

    A null text has 0 tokens; a null id is not listed.
    """
    df = with_tokens(accepted.select("id", "text", "estimated_tokens"), vocabulary=vocabulary)
    est, tok = F.col("estimated_tokens"), F.col("tokens")
    wrong = est.isNull() | (est * factor < tok) | (est > tok * factor)
    return df.filter(F.col("id").isNotNull() & wrong).select("id").distinct()
