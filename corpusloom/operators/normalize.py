"""Text normalization: native expressions where they are exact, one Arrow function for the rest.

Texts of printable ASCII without ampersand or tag need no Python: entities, markup, Unicode form
and control characters leave them as they are. They pass by the Arrow function in a branch of
their own, since Spark would evaluate it for every row of a conditional.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Normalization
from corpusloom.functions.pytext import decode_text
from corpusloom.functions.text import computed

# Fixed value: blanks within a line after control characters are gone.
_BLANKS = r"[\t\x0b\x0c\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NEEDS_PYTHON = r"[^\x09\x0a\x20-\x7e]|&|<"


def layout(c: Column, config: Normalization) -> Column:
    """Blanks, blank lines and outer white space of decoded text."""
    if config.collapse_horizontal_whitespace:
        c = F.regexp_replace(F.regexp_replace(c, f"{_BLANKS}+", " "), r" +(?=\n|\z)", "")
    kept = config.max_blank_lines
    c = F.regexp_replace(c, rf"\n(?:[ \t]*\n){{{kept + 1},}}", "\n" * (kept + 1))
    if config.strip_text:
        c = F.regexp_replace(c, rf"\A(?:{_BLANKS}|\n)+|(?:{_BLANKS}|\n)+\z", "")
    return c


def normalize(df: DataFrame, config: Normalization | None = None, text: str = "text") -> DataFrame:
    """The table with its text column normalized; null becomes the empty text, other columns and rows stay."""
    config = config or Normalization()
    lines = F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"\r\n?", "\n")
    rows = computed(df, text, lines)
    hard = F.col(text).rlike(_NEEDS_PYTHON)
    decode = decode_text(df.sparkSession, F.when(hard, F.col(text)), config.decode_html_entities, config.strip_html, config.unicode_form, config.remove_control_characters)
    rows = rows.withColumn(text, F.coalesce(decode, F.col(text)))
    return computed(rows, text, layout(F.col(text), config))


def lower_case(df: DataFrame, text: str = "text") -> DataFrame:
    """The optional last step of cleaning: lower case."""
    return df.withColumn(text, F.lower(text))
