"""The accept path: normalize, judge by rules, optionally by perplexity, remove exact copies; every row gets a stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Normalization, Perplexity, Rules
from corpusloom.functions.hashing import stable_id
from corpusloom.functions.text import estimated_tokens
from corpusloom.operators.dedup import text_hash
from corpusloom.operators.normalize import normalize
from corpusloom.operators.perplexity import Scorer, with_perplexity
from corpusloom.operators.rules import apply_rules
from corpusloom.session import cut_lineage

ACCEPTED = ("id", "text", "corpus", "type", "jurisdiction", "source", "source_file", "source_row", "estimated_tokens", "perplexity")


def prepared(records: DataFrame, normalization: Normalization | None = None, rules: Rules | None = None, scorer: Callable[[], Scorer] | None = None, perplexity: Perplexity | None = None, score_where=None) -> DataFrame:
    """Records with cleaned ``text``, ``id``, ``estimated_tokens``, ``perplexity``, ``reasons`` and ``stage``.

    ``stage`` is rules or perplexity for a rejected row and null for one that is still in. All
    steps are row by row, so the path serves streams too.
    """
    rows = apply_rules(normalize(records, normalization), rules)
    rows = rows.withColumns({"text": F.col("rules.text"), "reasons": F.col("rules.reasons"), "stage": F.when(~F.col("rules.accepted"), "rules")}).drop("rules")
    if scorer is None:
        rows = rows.withColumn("perplexity", F.lit(None).cast("double"))
    else:
        where = F.col("stage").isNull() if score_where is None else F.col("stage").isNull() & score_where
        rows = with_perplexity(rows, scorer, "accept", perplexity, where=where)
        out = F.col("scored.reason").isNotNull()
        rows = rows.withColumns({"perplexity": F.col("scored.perplexity"), "reasons": F.when(out, F.array("scored.reason")).otherwise(F.col("reasons")), "stage": F.when(out, "perplexity").otherwise(F.col("stage"))}).drop("scored")
    return rows.withColumns({"id": stable_id("corpus", "source_file", "source_row"), "estimated_tokens": estimated_tokens("text")})


def without_exact_copies(rows: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """The rows; all but the first in scan order of equal canonical texts among those still in get stage exact_deduplication."""
    hashed = cut_lineage(rows).withColumn("__hash", text_hash(rows.sparkSession, F.when(F.col("stage").isNull(), F.col("text"))))
    first = hashed.filter("__hash IS NOT NULL").groupBy("__hash").agg(F.min(ordinal).alias("__first"))
    marked = hashed.join(first, "__hash", "left")
    copy = F.col("stage").isNull() & (F.col(ordinal) > F.col("__first"))
    return marked.withColumns({"reasons": F.when(copy, F.array(F.lit("exact_duplicate"))).otherwise(F.col("reasons")), "stage": F.when(copy, "exact_deduplication").otherwise(F.col("stage"))}).drop("__hash", "__first")


def accepted(rows: DataFrame) -> DataFrame:
    """The rows that are still in, with the fields of an accepted record."""
    return rows.filter("stage IS NULL").select(*ACCEPTED)


def rejected(rows: DataFrame) -> DataFrame:
    """The audit of the others, without their texts."""
    return rows.filter("stage IS NOT NULL").select("corpus", "source_file", "source_row", "stage", "reasons")


def stage_counters(rows: DataFrame, keys: tuple[str, ...] = ("corpus",)) -> DataFrame:
    """Rows in (those selected for the path), accepted, their tokens, and rejected by stage."""
    still = F.col("stage").isNull()
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("input_rows"), F.count_if(still).alias("accepted_rows"),
        F.coalesce(F.sum(F.when(still, F.col("estimated_tokens"))), F.lit(0)).alias("accepted_tokens"),
        F.count_if(F.col("stage") == "rules").alias("rule_rejections"), F.count_if(F.col("stage") == "perplexity").alias("perplexity_rejections"),
        F.count_if(F.col("stage") == "exact_deduplication").alias("exact_duplicates"),
    )


def rejection_counts(rows: DataFrame) -> DataFrame:
    """Rejected rows by corpus, stage and reason."""
    return rejected(rows).select("corpus", "stage", F.explode("reasons").alias("reason")).groupBy("corpus", "stage", "reason").agg(F.count(F.lit(1)).alias("rejected_rows"))
