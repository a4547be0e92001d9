"""Quality rules: noise removal, metrics, reasons, flags; native expressions throughout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Rules
from corpusloom.functions.text import SPACES, WORD, computed

# Lines that only number a page or lines of one.
_PAGE = r"\s*(?:page\s+\d{1,6}(?:\s+(?:of|/)\s*\d{1,6})?|\d{1,6}\s+(?:of|/)\s*\d{1,6})\s*"
_LINES = r"\s*lines?\s+\d{1,7}(?:\s*[-–]\s*\d{1,7})?\s*"
_TAG = r"</?[A-Za-z][^>]*>"


def without_markers(text: Column) -> Column:
    """Text without lines that are page or line markers; bare numbers stay."""
    line = rf"(?iU)\A(?:{_PAGE}|{_LINES})\z"
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(line)), "\n")


def without_runs(text: Column) -> Column:
    """Runs of ten or more of one character shortened to three."""
    return F.regexp_replace(text, r"(?s)(.)\1{9,}", "$1$1$1")


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def alphabetic_ratio(text: Column) -> Column:
    """Letters among the characters that are not white space."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return _share(letters, F.length(F.regexp_replace(text, f"[{SPACES}]+", "")))


def repeated_line_ratio(text: Column) -> Column:
    """Repeats among the lines of 20 or more characters, letter case and blanks aside."""
    tidy = F.transform(F.split(text, "\n", -1), lambda x: F.regexp_replace(F.lower(F.regexp_replace(x, f"[{SPACES}]+", " ")), r"\A +| +\z", ""))
    return let(F.filter(tidy, lambda x: F.length(x) >= 20), lambda lines: _share(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines)))


def repeated_ngram_ratio(words: Column, n: int) -> Column:
    """Repeats among the n-grams of words in lower case; hashes of 64 bits stand for the n-grams."""
    count = F.size(words) - n + 1

    def share(hashed: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(hashed, i, F.lit(n))))
        return F.when(count > 0, (count - F.size(F.array_distinct(grams))) / count).otherwise(F.lit(0.0))

    return let(F.transform(words, lambda w: F.xxhash64(w)), share)


def apply_rules(df: DataFrame, config: Rules | None = None, text: str = "text", name: str = "rules") -> DataFrame:
    """The table with a struct ``name``: accepted, text, reasons, flags, transformations, metrics.

    Reasons keep a fixed order. Null text counts as empty, hence as too short. A column ``name``
    of the table is replaced; all rows stay.
    """
    config = config or Rules()
    return computed(df.drop(name), name, judged(F.coalesce(F.col(text), F.lit("")), config))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.transform(F.array(value), f)[0]


def judged(raw: Column, config: Rules) -> Column:
    """The struct of ``apply_rules`` as one expression."""
    unmarked = without_markers if config.remove_page_and_line_markers else lambda c: c
    shortened = without_runs if config.collapse_repeated_punctuation else lambda c: c
    stripped = lambda c: F.regexp_replace(c, rf"\A[{SPACES}]+|[{SPACES}]+\z", "")

    def changed(marked: Column) -> Column:
        return let(shortened(marked), lambda runs: let(stripped(runs), lambda clean: result(marked, runs, clean)))

    def result(marked: Column, runs: Column, clean: Column) -> Column:
        changes = _named([(marked != raw, "removed_page_or_line_markers"), (runs != marked, "collapsed_repeated_punctuation")])
        return let(metrics(clean, config), lambda m: _verdict(clean, m, changes, config))

    return let(unmarked(raw), changed)


def metrics(clean: Column, config: Rules) -> Column:
    """The metrics of a cleaned text."""

    def of_words(words: Column) -> Column:
        chars = F.length(clean)
        return F.struct(
            chars.cast("double").alias("character_count"),
            F.size(words).cast("double").alias("word_count"),
            alphabetic_ratio(clean).cast("double").alias("alphabetic_ratio"),
            ((chars - F.length(F.replace(clean, F.lit("\ufffd"), F.lit("")))) / F.greatest(chars, F.lit(1))).cast("double").alias("replacement_character_ratio"),
            repeated_line_ratio(clean).cast("double").alias("repeated_line_ratio"),
            repeated_ngram_ratio(words, config.repeated_ngram_size).cast("double").alias("repeated_ngram_ratio"),
        )

    return let(F.regexp_extract_all(F.lower(clean), F.lit(WORD), F.lit(0)), of_words)


def _named(pairs: list[tuple[Column, str]]) -> Column:
    return F.array_compact(F.array(*[F.when(test, F.lit(reason)) for test, reason in pairs]))


def _verdict(clean: Column, m: Column, changes: Column, config: Rules) -> Column:
    html = clean.rlike(_TAG)
    reasons = _named([
        (m.character_count < config.min_characters, "too_few_characters"),
        (m.word_count < config.min_words, "too_few_words"),
        (m.character_count > config.max_characters if config.max_characters is not None else F.lit(False), "too_many_characters"),
        (m.alphabetic_ratio < config.min_alphabetic_ratio, "low_alphabetic_ratio"),
        (m.replacement_character_ratio > config.max_replacement_character_ratio, "high_replacement_character_ratio"),
        (m.repeated_line_ratio > config.max_repeated_line_ratio, "high_repeated_line_ratio"),
        (m.repeated_ngram_ratio > config.max_repeated_ngram_ratio, "high_repeated_10gram_ratio"),
        (html & F.lit(config.reject_remaining_html), "contains_html"),
    ])
    flags = _named([(html & F.lit(not config.reject_remaining_html), "contains_html")])
    return let(reasons, lambda r: F.struct((F.size(r) == 0).alias("accepted"), clean.alias("text"), r.alias("reasons"), flags.alias("flags"), changes.alias("transformations"), m.alias("metrics")))


def rejections_by_reason(ruled: DataFrame, keys: list[str], name: str = "rules") -> DataFrame:
    """Rejected rows by reason; a row counts once for each of its reasons."""
    return ruled.select(*keys, F.explode(F.col(name)["reasons"]).alias("reason")).groupBy(*keys, "reason").agg(F.count(F.lit(1)).alias("rejected_rows"))


def rejection_rates(ruled: DataFrame, keys: list[str], alarm: float = 0.10, name: str = "rules") -> DataFrame:
    """Rows, rejected and flagged rows of each stratum, their rate, and whether it exceeds ``alarm``."""
    n, bad = F.count(F.lit(1)), F.count_if(~F.col(name)["accepted"])
    flagged = F.count_if(F.size(F.col(name)["flags"]) > 0)
    return ruled.groupBy(*keys).agg(n.alias("rows"), bad.alias("rejected_rows"), flagged.alias("flagged_rows"), (bad / n).alias("rejection_rate"), (bad / n > alarm).alias("alarm"))
