"""Contamination of training rows by evaluation sets: exact, punctuation-insensitive and near matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import NearDuplicates
from corpusloom.functions.pytext import canonical_text
from corpusloom.operators.dedup import Comparer, sketches
from corpusloom.session import cut_lineage


def _hashes(df: DataFrame, key: str, text: str) -> DataFrame:
    canonical = canonical_text(df.sparkSession, F.coalesce(F.col(text), F.lit("")))
    rows = df.select(F.col(key).alias("k"), canonical.alias("c"))
    bare = F.regexp_replace("c", r"[^\p{L}\p{N}]+", "")
    return rows.select("k", F.sha2("c", 256).alias("exact"), F.when(bare != "", F.sha2(bare, 256)).alias("bare"))


def _near(train: DataFrame, evaluation: DataFrame, config: NearDuplicates) -> DataFrame:
    """``k``, ``e`` and ``similarity`` of alike texts: keys of the buckets first, signatures, then the shingles of what is left."""
    side = lambda df, name: df.select(F.struct(F.lit(name).alias("side"), F.monotonically_increasing_id().alias("n")).alias("ordinal"), *df.columns)
    mine, theirs = cut_lineage(side(train, "train")), cut_lineage(side(evaluation, "evaluation"))
    texts = mine.select("ordinal", "text").unionByName(theirs.select("ordinal", "text"))
    sketched = cut_lineage(texts.select("ordinal", sketches(train.sparkSession, "text", config).alias("s")).select("ordinal", "s.*"))
    rows = sketched.select("ordinal", "size", F.explode("bands").alias("key"))
    a, b = rows.filter("ordinal.side = 'train'"), rows.filter("ordinal.side = 'evaluation'").select("key", F.col("ordinal").alias("other"), F.col("size").alias("other_size"))
    sized = F.least("size", "other_size") >= F.greatest("size", "other_size") * config.similarity_threshold - 1e-6
    alike = Comparer(texts, sketched, config).alike(a.join(b, "key").filter(sized).select("ordinal", "other"))
    return alike.join(mine.select("ordinal", "k"), "ordinal").join(theirs.select(F.col("ordinal").alias("other"), "e"), "other").select("k", "e", "similarity")


def contamination(train: DataFrame, evaluation: DataFrame, key: str = "id", eval_key: str = "id", text: str = "text", eval_text: str = "text", config: NearDuplicates | None = None) -> DataFrame:
    """``key``, ``eval_key``, ``kind`` and ``similarity``: the strongest evidence for each contaminated pair's training row.

    Kinds: exact (equal canonical texts), punctuation (equal but for it), near (Jaccard of the
    word shingles). Empty and null texts match nothing. Each training row is listed once, with
    its best match.
    """
    config = config or NearDuplicates()
    mine, theirs = _hashes(train, key, text), _hashes(evaluation, eval_key, eval_text).withColumnRenamed("k", "e")
    found = []
    for column, kind, rank in (("exact", "exact", 0), ("bare", "punctuation", 1)):
        least = theirs.filter("bare IS NOT NULL").groupBy(column).agg(F.min("e").alias("e"))
        found.append(mine.filter("bare IS NOT NULL").join(least, column).select("k", "e", F.lit(kind).alias("kind"), F.lit(1.0).alias("similarity"), F.lit(rank).alias("rank")))
    near = _near(train.select(F.col(key).alias("k"), F.col(text).alias("text")), evaluation.select(F.col(eval_key).alias("e"), F.col(eval_text).alias("text")), config)
    found.append(near.select("k", "e", F.lit("near").alias("kind"), "similarity", F.lit(2).alias("rank")))
    every = found[0].unionByName(found[1]).unionByName(found[2])
    best = every.groupBy("k").agg(F.min(F.struct("rank", (-F.col("similarity")).alias("less"), "e", "kind")).alias("m"))
    return best.select(F.col("k").alias(key), F.col("m.e").alias(f"evaluation_{eval_key}"), F.col("m.kind").alias("kind"), (-F.col("m.less")).alias("similarity"))


def decontaminated(train: DataFrame, evidence: DataFrame, key: str = "id") -> DataFrame:
    """Training rows without evidence."""
    return train.join(evidence.select(key), key, "left_anti")


def same_text(train: DataFrame, evaluation: DataFrame, key: Column | str, text: str = "text") -> DataFrame:
    """Training rows whose canonical text is one of the evaluation set's."""
    theirs = evaluation.select(F.sha2(canonical_text(train.sparkSession, text), 256).alias("__h")).distinct()
    return train.withColumn("__h", F.sha2(canonical_text(train.sparkSession, text), 256)).join(theirs, "__h", "left_semi").select(key)
