"""Corpus statistics: grouped sums, grouping sets, shares, data-quality counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import text_bytes, tokens_of_words, word_count


def _measured(df: DataFrame, text: str) -> DataFrame:
    return df.withColumns({"__bytes": text_bytes(text), "__words": word_count(text)})


def _sums() -> list[Column]:
    words = F.coalesce(F.sum("__words"), F.lit(0))
    return [
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum("__bytes"), F.lit(0)).cast("long").alias("text_bytes"),
        words.cast("long").alias("words"),
        tokens_of_words(words).alias("estimated_tokens"),
    ]


def grouped_stats(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Documents, bytes, words and estimated tokens by ``keys``; tokens are floored once for each group.

    Null texts count as empty documents, null keys form a group of their own, an empty
    table gives no rows (without keys: one row of zeros).
    """
    return _measured(df, text).groupBy(*keys).agg(*_sums())


def grouping_set_stats(df: DataFrame, sets: Sequence[Sequence[str]], text: str = "text") -> DataFrame:
    """``grouped_stats`` for several key sets in one pass; ``level`` is the number of the set's keys."""
    keys = list(dict.fromkeys(k for s in sets for k in s))
    grouped = _measured(df, text).groupingSets([[F.col(k) for k in s] for s in sets], *keys)
    gid = F.grouping_id()
    return grouped.agg(*_sums(), (F.lit(len(keys)) - F.bit_count(gid)).cast("long").alias("level")).select(
        *keys, "level", "documents", "text_bytes", "words", "estimated_tokens"
    )


def global_summary(df: DataFrame, text: str = "text", labels: Sequence[str] = ("type", "jurisdiction", "source")) -> DataFrame:
    """One row of totals and of counters for missing (null or empty) texts and labels."""
    missing = [F.count_if(F.coalesce(F.col(c), F.lit("")) == "").alias(f"missing_{c}") for c in (text, *labels)]
    return _measured(df, text).agg(*_sums(), *missing)


def rollup_shares(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Totals by each key alone with their share of all estimated tokens, in one scan; ``level`` names the key."""
    sets = _measured(df, text).groupingSets([[F.col(k)] for k in keys], *keys).agg(F.grouping_id().alias("__g"), *_sums())
    level, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, k in enumerate(keys):
        mine = F.col("__g") == (1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i))
        level, value = F.when(mine, k).otherwise(level), F.when(mine, F.col(k).cast("string")).otherwise(value)
    share = F.try_divide(F.col("estimated_tokens"), F.sum("estimated_tokens").over(Window.partitionBy("level")))
    return sets.select(level.alias("level"), value.alias("value"), "documents", "estimated_tokens").withColumn("token_share", share)


def gibibytes(size: Column | str) -> Column:
    """Bytes in GiB."""
    return (F.col(size) if isinstance(size, str) else size) / float(1 << 30)
