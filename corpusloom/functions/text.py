"""Text measures as native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters for which Python's str.isspace() is true, as a regex class body. Those of
# one byte stand singly, so that one table decides; the others hide behind a range that few characters enter.
SPACES = r"\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
# Fixed value: a word of the quality rules, \w+ of Python's re.
WORD = r"[\p{L}\p{N}_]+"
# Fixed value: estimated tokens for each whitespace-delimited word.
TOKENS_PER_WORD = 1.3


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_count(c: Column | str) -> Column:
    """Whitespace-delimited words; null counts as empty."""
    return F.regexp_count(F.coalesce(_col(c), F.lit("")), F.lit(f"[^{SPACES}]+")).cast("long")


def tokens_of_words(words: Column) -> Column:
    """floor(1.3 x words)."""
    return F.floor(words * F.lit(TOKENS_PER_WORD)).cast("long")


def estimated_tokens(c: Column | str) -> Column:
    """Token estimate of one text, floored for each document."""
    return tokens_of_words(word_count(c))


def text_bytes(c: Column | str) -> Column:
    """UTF-8 length; null counts as empty."""
    return F.coalesce(F.octet_length(_col(c)), F.lit(0)).cast("long")


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The table with ``value`` in column ``name``, replaced in place or put last, computed once for each row.

    Later steps that name a costly value several times, or filter by it, would have it inlined
    into each of them; a generator of one row is a step that nothing is moved through.
    """
    made = F.explode(F.array(value)).alias(name)
    return df.select(*[made if c == name else F.col(f"`{c}`") for c in df.columns], *([] if name in df.columns else [made]))
