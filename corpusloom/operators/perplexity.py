"""Perplexity filter with a pluggable scorer, and counts for estimating an n-gram model."""

from __future__ import annotations

import math
import os
import re
from collections.abc import Callable, Iterable
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Perplexity
from corpusloom.session import arrow_function

_RETURNS = "struct<accepted: boolean, perplexity: double, log10_probability: double, token_count: long, reason: string>"


class Scorer(Protocol):
    """A language model."""

    def score(self, sentence: str, bos: bool = True, eos: bool = True) -> float:
        """log10 probability of a sentence."""


class ArpaModel:
    """Back-off n-gram model in ARPA format, from a file or from its lines."""

    def __init__(self, path: str | None = None, lines: Iterable[str] = ()) -> None:
        self.grams: dict[tuple[str, ...], tuple[float, float]] = {}
        self.order = 0
        if path is None:
            self._read(lines)
        else:
            with open(path, encoding="utf-8") as file:
                self._read(file)

    def _read(self, lines: Iterable[str]) -> None:
        for line in lines:
            if m := re.match(r"\\(\d+)-grams:", line):
                self.order = int(m[1])
            elif self.order and len(parts := line.rstrip("\n").split("\t")) >= 2:
                words = tuple(parts[1].split(" "))
                self.grams[words] = (float(parts[0]), float(parts[2]) if len(parts) > 2 else 0.0)

    def _step(self, context: tuple[str, ...], word: str) -> float:
        word = word if (word,) in self.grams else "<unk>"
        back = 0.0
        while True:
            found = self.grams.get((*context, word))
            if found is not None:
                return back + found[0]
            if not context:
                return back - 100.0
            back += self.grams.get(context, (0.0, 0.0))[1]
            context = context[1:]

    def score(self, sentence: str, bos: bool = True, eos: bool = True) -> float:
        """log10 probability of a sentence."""
        words = sentence.split() + (["</s>"] if eos else [])
        context: tuple[str, ...] = ("<s>",) if bos else ()
        total = 0.0
        for word in words:
            keep = max(self.order - 1, 0)
            total += self._step(context[-keep:] if keep else (), word)
            context = (*context, word)[-keep:] if keep else ()
        return total


def load_model(path: str) -> Scorer:
    """The model of a file: by the ``kenlm`` package where it is installed, else an ARPA text by ``ArpaModel``."""
    if not os.path.isfile(path):
        raise FileNotFoundError(f"no language model at {path}")
    try:
        import kenlm
    except ImportError:
        with open(path, "rb") as file:
            if b"\\data\\" not in file.read(4096):
                raise RuntimeError(f"{path} is no ARPA text, and the kenlm package that reads binary models is not installed") from None
        return ArpaModel(path)
    return kenlm.Model(path)


def scorer_of(model: Callable[[], Scorer] | None = None, path: str | None = None) -> Callable[[], Scorer]:
    """What makes the scorer in a worker; exactly one of a maker and a path all executors can read."""
    if (model is None) == (path is None):
        raise ValueError("exactly one of model and path must be given")
    return model if model is not None else lambda: load_model(path)


_loaded: dict[str, Scorer] = {}


def worker_model(name: str, load: Callable[[], Scorer]) -> Scorer:
    """This worker's model, loaded once."""
    if name not in _loaded:
        _loaded[name] = load()
    return _loaded[name]


def judge(text: str | None, model: Scorer, config: Perplexity) -> dict:
    """Score a text and hold it against the threshold."""
    tidy = re.sub(r"\s+", " ", text or "").strip()
    words = len(tidy.split())
    if words < config.min_words:
        return {"accepted": False, "perplexity": math.inf, "log10_probability": -math.inf, "token_count": words, "reason": "too_few_words_for_perplexity"}
    log = float(model.score(tidy, bos=config.include_bos, eos=config.include_eos))
    count = words + int(config.include_eos)
    exponent = -log / max(1, count)
    value = 10.0**exponent if exponent <= 308 else math.inf
    reason = None
    if not math.isfinite(value):
        reason = "non_finite_perplexity"
    elif value > config.threshold:
        reason = "perplexity_above_threshold"
    return {"accepted": reason is None, "perplexity": value, "log10_probability": log, "token_count": count, "reason": reason}


def with_perplexity(df: DataFrame, load: Callable[[], Scorer], name: str, config: Perplexity | None = None, text: str = "text", column: str = "scored", where=None) -> DataFrame:
    """The table with a struct ``column`` of the score; rows outside the condition ``where`` get null.

    ``load`` makes the scorer, once for each worker under the key ``name``. A null text has no words.
    """
    config = config or Perplexity()

    kind = pa.struct([("accepted", pa.bool_()), ("perplexity", pa.float64()), ("log10_probability", pa.float64()), ("token_count", pa.int64()), ("reason", pa.string())])

    def score(texts: pa.Array, asked: pa.Array) -> pa.Array:
        model = worker_model(name, load)
        return pa.array([judge(t, model, config) if a else None for t, a in zip(texts.to_pylist(), asked.to_pylist())], kind)

    asked = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    return df.withColumn(column, arrow_function(df.sparkSession, score, _RETURNS)(F.when(asked, F.col(text)), asked))


def normalized_perplexity(text: str | None, model: Scorer, include_bos: bool = True, include_eos: bool = True) -> float:
    """The perplexity for each word of one text, without a threshold."""
    return judge(text, model, Perplexity(threshold=1e308, include_bos=include_bos, include_eos=include_eos))["perplexity"]


def estimated_arpa(df: DataFrame, text: str = "text", words: int = 50_000, pairs: int = 200_000) -> list[str]:
    """Lines of a back-off model of pairs, estimated from the counts of all texts; the driver holds it.

    The ``words`` most frequent words and the ``pairs`` most frequent pairs of them are in the
    model, which bounds its size. What single words leave (Witten and Bell's estimate) is the mass
    of unknown words, taken to be as many as the known ones; what a word's pairs leave goes to
    its back-off.
    """
    rows = df.withColumn("__lower", F.lower(F.col(text)))
    single = ngram_counts(rows, 1, "__lower")
    whole = single.agg(F.sum("occurrences")).first()[0] or 1
    one = {r.ngram: r.occurrences for r in single.orderBy(F.desc("occurrences"), "ngram").limit(words).collect()}
    two = ngram_counts(rows, 2, "__lower").orderBy(F.desc("occurrences"), "ngram").limit(pairs).collect()
    after: dict[str, dict[str, int]] = {}
    for r in two:
        a, b = r.ngram.split(" ")
        if a in one and b in one:
            after.setdefault(a, {})[b] = r.occurrences
    chance = {w: n / (whole + len(one)) for w, n in one.items()}
    chance["<unk>"] = max(1.0 - sum(chance.values()), 1e-9) / max(len(one), 1)
    log = lambda x: f"{math.log10(max(x, 1e-12)):.6f}"
    singles, doubles = [], []
    for w in sorted(chance):
        next_words = after.get(w, {})
        size = one.get(w, 0) + len(next_words)
        given = {b: n / size for b, n in next_words.items()}
        left = (1.0 - sum(given.values())) / max(1.0 - sum(chance[b] for b in given), 1e-9)
        singles.append(f"{log(chance[w])}\t{w}\t{log(left) if given else '0'}")
        doubles += [f"{log(p)}\t{w} {b}" for b, p in sorted(given.items())]
    return ["\\data\\", f"ngram 1={len(singles)}", f"ngram 2={len(doubles)}", "", "\\1-grams:", *singles, "", "\\2-grams:", *doubles, "", "\\end\\"]


def ngram_counts(df: DataFrame, n: int, text: str = "text", least: int = 1) -> DataFrame:
    """Counts of the word n-grams of sentences with begin and end marks, from ``least`` occurrences."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != "")
    marked = df.select(F.concat(F.array(F.lit("<s>")), words, F.array(F.lit("</s>"))).alias("w"))
    count = F.size("w") - n + 1
    grams = F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice("w", i, F.lit(n)), " ")))
    return marked.select(F.explode(grams).alias("ngram")).groupBy("ngram").agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") >= least)
