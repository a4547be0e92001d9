"""Repeated content inside a text, and cutoffs for it with a bounded risk of false rejection.

The measure of a text is the share of its words that lie in a run of ``RUN`` or more words that
occurred earlier in the text; beside it stand the shares in repeated sentences and paragraphs.
The cutoff on the measure is learned for each stratum on labelled texts made from all texts of
the table: passages of known length are planted a second time into the words of a text freed of
repetition, and the label is the planted share, not the measure. From the strictest cutoff downwards each is kept while the
exact binomial upper bound of the rate at which it rejects texts that are no cases stays below
the allowed risk (a fixed sequence of tests), the error probability being divided among the
strata (Bonferroni). The lowest cutoff kept decides.
"""

from __future__ import annotations

import re
from math import inf, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.labels import language_label
from corpusloom.llm.kernel import blocks, segment_hashes, visible, without_invisible, words
from corpusloom.session import arrow_function, cut_lineage

#: Words of a run that counts as repeated.
RUN = 10
#: Planted share from which a text is a case, and below which it is an ordinary one.
REPETITIVE, ORDINARY = 0.40, 0.20
#: Labelled texts at least (of smaller tables each text is planted several times), the allowed rate of false rejection, and the error probability for all strata.
HOLDOUT, RISK, ERROR = 8000, 0.02, 0.05
#: Cutoffs in the order in which they are tested.
CUTOFFS = tuple(round(0.60 - 0.01 * i, 2) for i in range(56))
#: Cutoff of a stratum, and of all pooled, where no cutoff can be shown to keep the risk.
STRICTEST = CUTOFFS[0]
_HELD = pa.struct([("planted", pa.float64()), ("label", pa.string()), ("score", pa.float64())])
_RETURNS = "struct<words: long, repeated_share: double, sentence_share: double, paragraph_share: double, held: array<struct<planted: double, label: string, score: double>>>"
_STOPS = [ord(c) for c in ".!?"]


def _repeated(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether each value stood earlier in the same text; values are in order of their texts."""
    key = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + doc.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(values), bool)
    same[order[1:]] = key[order[1:]] == key[order[:-1]]
    return same


def _covered(hashes: np.ndarray, doc: np.ndarray, run: int = RUN) -> np.ndarray:
    """Which words lie in runs that occurred earlier in the same text; words are in order of their texts."""
    at = np.flatnonzero(doc[run - 1 :] == doc[: len(doc) - run + 1]) if len(doc) >= run else np.zeros(0, np.int64)
    again = at[_repeated(segment_hashes(hashes, at, at + run), doc[at])]
    cover = np.zeros(len(doc) + 1, np.int64)
    cover[again] += 1
    cover[again + run] -= 1
    return np.cumsum(cover[:-1]) > 0


def _words(cp: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts, ends and hashes of the words, and the text of each."""
    starts, ends, hashes = words(cp, offs)
    return starts, ends, hashes, np.searchsorted(offs, starts, "right") - 1


def shares(cp: np.ndarray, offs: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and the shares of them in repeated runs, sentences and paragraphs."""
    cp, offs = without_invisible(cp, offs)
    found = _words(cp, offs)
    return _shares(cp, offs, *found, _covered(found[2], found[3], run))


def _shares(cp: np.ndarray, offs: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, doc: np.ndarray, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = len(offs) - 1
    count = np.bincount(doc, minlength=n)
    total = np.maximum(count, 1)
    out = [count, np.bincount(doc, covered, n) / total]
    feeds = np.zeros(len(cp) + 1, np.int64)
    np.cumsum(cp == 0x0A, out=feeds[1:])
    stops = np.zeros(len(cp) + 1, np.int64)
    np.cumsum(np.isin(cp, _STOPS), out=stops[1:])
    for breaks in ((stops[starts[1:]] > stops[ends[:-1]]) | (feeds[starts[1:]] - feeds[ends[:-1]] > 1), feeds[starts[1:]] - feeds[ends[:-1]] > 1) if len(starts) else ((), ()):
        new = np.ones(len(starts), bool)
        if len(starts):
            new[1:] = breaks | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts))
        twice = _repeated(segment_hashes(hashes, first, last), doc[first])
        out.append(np.bincount(doc[first], (last - first) * twice, n) / total)
    return tuple(out)


def repeated_words(text: str, run: int = RUN) -> tuple[list[str], np.ndarray]:
    """The words of a text, and which lie in repeated runs, by comparing the runs themselves."""
    folded = "".join(c for c in text.lower() if visible()[ord(c)])
    found = re.findall(r"[^\W_]+", folded)
    seen: set[tuple[str, ...]] = set()
    covered = np.zeros(len(found), bool)
    for i in range(len(found) - run + 1):
        part = tuple(found[i : i + run])
        if part in seen:
            covered[i : i + run] = True
        seen.add(part)
    return found, covered


def exact_share(text: str, run: int = RUN) -> float:
    """The share of words in repeated runs, by comparing the runs themselves."""
    found, covered = repeated_words(text, run)
    return float(covered.mean()) if found else 0.0


def _mixed(seeds: np.ndarray, stream: np.ndarray | int) -> np.ndarray:
    """Evenly spread 64-bit values of seeds and the number of a stream."""
    x = seeds.astype(np.uint64) + (np.atleast_1d(stream).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _drawn(seeds: np.ndarray, stream: int) -> np.ndarray:
    """Numbers from 0 to below 1."""
    return (_mixed(seeds, stream) >> np.uint64(11)) * 2.0**-53


def plans(seeds: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What is planted into texts of ``own`` words: whole copies, the words of one more passage, where that begins, and whether it fits.

    A third of the seeds plant nothing, a third up to the share of an ordinary text, the others
    that of a case. Nothing fits texts too short for a passage of two runs.
    """
    kind = (_drawn(seeds, 0) * 3).astype(np.int64)
    low = np.where(kind == 1, 2 * RUN / (own + 2 * RUN), REPETITIVE)
    high = np.where(kind == 1, ORDINARY, 0.85)
    share = np.where(kind == 0, 0.0, low + (high - low) * _drawn(seeds, 1))
    copies, tail = np.divmod((own * share / (1 - share)).astype(np.int64), np.maximum(own, 1))
    tail = np.where(tail >= RUN, tail, 0)
    at = (_drawn(seeds, 2) * (own - tail + 1)).astype(np.int64)
    return copies, tail, at, (own >= 5 * RUN) & ((kind != 1) | (low < high))


def planted(text: str, seed: int) -> tuple[str, float] | None:
    """A text of known repetition: its words without repeated runs, and passages of them once more; with the planted share.

    None if the text is too short. ``planted_scores`` does the same on hashes of the words.
    """
    found, covered = repeated_words(text)
    own = [w for w, c in zip(found, covered) if not c]
    copies, tail, at, fits = (x[0] for x in plans(np.array([seed]), np.array([len(own)])))
    if not fits:
        return None
    out, added = list(own), 0
    for begin, n in [(0, len(own))] * copies + [(at, tail)] * bool(tail):
        # A word of its own keeps the passage from running on from what stands before it.
        out += [f"planted{seed % 997}x{added}", *own[begin : begin + n]]
        added += n
    return " ".join(out), added / len(out)


def planted_scores(hashes: np.ndarray, doc: np.ndarray, covered: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text whether a passage fits, the planted share, and the measure of its words with the planted passages."""
    n = len(seeds)
    own_hashes, own_doc = hashes[~covered], doc[~covered]
    own = np.bincount(own_doc, minlength=n)
    copies, tail, at, fits = plans(seeds, own)
    pieces = np.where(fits, 1 + copies + (tail > 0), 0)
    text = np.repeat(np.arange(n), pieces)
    number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    last = number > copies[text]
    begin = (np.cumsum(own) - own)[text] + np.where(last, at[text], 0)
    length = np.where(last, tail[text], own[text]) + (number > 0)
    # A value of its own stands before each passage.
    first = np.cumsum(length) - length
    source = np.arange(length.sum()) + np.repeat(begin - (number > 0) - first, length)
    source[first[number > 0]] = 0
    values = own_hashes[source]
    values[first[number > 0]] = _mixed(seeds[text], number + 3)[number > 0]
    of = np.repeat(text, length)
    total = np.maximum(np.bincount(of, minlength=n), 1)
    return fits, (copies * own + tail) / total, np.bincount(of, _covered(values, of), n) / total


def label_of(share: float) -> str:
    """The label of a planted share."""
    return "repetitive" if share >= REPETITIVE else "ordinary" if share < ORDINARY else "between"


def _measure(texts: pa.Array, seeds: np.ndarray, times: int) -> pa.Array:
    columns, held, at = [[], [], [], []], [], 0
    for cp, offs in blocks(texts):
        cp, offs = without_invisible(cp, offs)
        found = _words(cp, offs)
        covered = _covered(*found[2:])
        for column, part in zip(columns, _shares(cp, offs, *found, covered)):
            column.append(part)
        own, at = seeds[at : at + len(offs) - 1], at + len(offs) - 1
        held.append([np.stack(x, 1) for x in zip(*(planted_scores(*found[2:], covered, _mixed(own, k)) for k in range(times)))])
    fits, planted_share, score = (np.concatenate([np.zeros((0, times), t), *(h[k] for h in held)]) for k, t in enumerate((bool, float, float)))
    kept = planted_share[fits]
    names = np.where(kept >= REPETITIVE, label_of(REPETITIVE), np.where(kept < ORDINARY, label_of(0), label_of(ORDINARY)))
    lines = pa.StructArray.from_arrays([pa.array(kept), pa.array(names, pa.string()), pa.array(score[fits])], fields=list(_HELD))
    ends = np.concatenate([[0], np.cumsum(fits.sum(1))])
    out = [pa.array(np.concatenate([np.zeros(0, t), *c]).astype(t)) for c, t in zip(columns, (np.int64, *[np.float64] * 3))]
    return pa.StructArray.from_arrays([*out, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines)], ["words", "repeated_share", "sentence_share", "paragraph_share", "held"])


def repetition(spark: SparkSession, text: str, seed: Column, times: int) -> Column:
    """Struct of words, repeated shares, and ``held``: planted share, label and measure of the text with planted passages, ``times`` if they fit."""

    def measure(texts: pa.Array, seeds: pa.Array) -> pa.Array:
        return _measure(texts, np.array(seeds.to_numpy(zero_copy_only=False)).view(np.uint64), times)

    return arrow_function(spark, measure, _RETURNS)(F.col(text), seed)


def upper_bound(rejected: int, n: int, error: float) -> float:
    """Exact (Clopper-Pearson) upper confidence bound of a rate, ``rejected`` of ``n`` being seen."""
    if rejected >= n:
        return 1.0

    # Above the rate seen the terms fall so fast that those left out are below a double's precision.
    k = np.arange(rejected, max(-1, rejected - 10 * int(rejected**0.5) - 100), -1)
    steps = np.log((k[:-1]) / (n - k[:-1] + 1))
    choose = lgamma(n + 1) - lgamma(rejected + 1) - lgamma(n - rejected + 1)

    def tail(p: float) -> float:
        first = choose + (rejected * log(p) if rejected else 0) + (n - rejected) * log(1 - p)
        return float(np.exp(first + np.concatenate([[0.0], np.cumsum(steps + log((1 - p) / p))])).sum())

    low, high = rejected / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if tail(mid) > error else (low, mid)
    return high


def choose_cutoffs(counts: dict[str, dict[float, int]], ordinary: dict[str, int], risk: float = RISK, error: float = ERROR) -> dict[str, float]:
    """The lowest cutoff of each stratum that the sequence of tests keeps; infinite where not even the strictest is kept.

    ``counts``: ordinary holdout texts rejected, by stratum and cutoff. ``ordinary``: how many there are.
    """
    chosen = {}
    for stratum, n in ordinary.items():
        chosen[stratum] = inf
        for cutoff in CUTOFFS:
            if upper_bound(counts[stratum].get(cutoff, 0), n, error / len(ordinary)) > risk:
                break
            chosen[stratum] = cutoff
    return chosen


class Repetition:
    """Repetition of all texts of a table, with cutoffs for the strata of its languages.

    Every row takes part in the learning of the cutoffs: once, or in a table of fewer than
    ``holdout`` rows several times with other passages; all rows are measured and judged.
    Strata with too few labelled texts for any cutoff to be kept take the pooled cutoff, and where
    that is not kept either, the strictest. Null and empty texts have no words and shares of 0.
    Repeated rows stay; an empty table has no rows and no strata.
    """

    def __init__(self, df: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang", holdout: int = HOLDOUT) -> None:
        times = max(1, holdout // max(df.count(), 1))
        rows = df.select(F.col(key).alias(key), language_label(language).alias("stratum"), F.col(text).alias("text"))
        seed = F.xxhash64(F.lit("planted"), key, "text")
        both = cut_lineage(rows.select(key, "stratum", repetition(df.sparkSession, "text", seed, times).alias("r")).select(key, "stratum", "r.*"))
        self.holdout = both.select("stratum", F.inline("held"))
        rejected = [F.count_if(F.col("score") >= c).alias(str(i)) for i, c in enumerate(CUTOFFS)]
        held = self.holdout.filter("label = 'ordinary'").groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *rejected).collect()
        counts = {r.stratum: {c: r[str(i)] for i, c in enumerate(CUTOFFS)} for r in held}
        ordinary = {r.stratum: r.n for r in held}
        pool = {c: sum(v[c] for v in counts.values()) for c in CUTOFFS}
        chosen = choose_cutoffs({**counts, "": pool}, {**ordinary, "": sum(ordinary.values())})
        pooled = chosen.pop("")
        self.pooled = pooled if pooled < inf else STRICTEST
        self.cutoffs = {k: v if v < inf else self.pooled for k, v in chosen.items()}
        self.key = key
        self.measured = both.drop("held")

    def _cutoff(self) -> Column:
        cutoff = F.lit(self.pooled)
        for stratum, value in self.cutoffs.items():
            cutoff = F.when(F.col("stratum") == stratum, value).otherwise(cutoff)
        return cutoff

    def flagged(self) -> DataFrame:
        """All rows with their cutoff and whether their repeated share reaches it."""
        return self.measured.withColumn("cutoff", self._cutoff()).withColumn("rejected", F.col("repeated_share") >= F.col("cutoff"))

    def report(self) -> DataFrame:
        """A line for each stratum: its cutoff, labelled texts by label, those rejected, and the upper bound of false rejection."""
        lines = self.holdout.withColumn("cutoff", self._cutoff()).groupBy("stratum", "label", "cutoff").agg(F.count(F.lit(1)).alias("texts"), F.count_if(F.col("score") >= F.col("cutoff")).alias("hit")).collect()
        rows = [(r.stratum, float(r.cutoff), r.label, r.texts, r.hit, upper_bound(r.hit, r.texts, ERROR / (len(self.cutoffs) + 1))) for r in sorted(lines, key=lambda r: (r.stratum, r.label))]
        return self.holdout.sparkSession.createDataFrame(rows, "stratum string, cutoff double, label string, texts long, rejected long, upper_bound double")

    def repetitive(self) -> DataFrame:
        """Keys of the rows that the cutoffs reject."""
        return self.flagged().filter(F.col("rejected") & F.col(self.key).isNotNull()).select(self.key).distinct()
