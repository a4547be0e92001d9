"""Exact and near-duplicate removal with auditable matches.

Near duplicates: word shingles, MinHash signatures in Arrow batches, bands as join keys, exact
Jaccard of the candidates, connected components. Exact copies are reduced to their first row
before. A bucket's texts are first compared with its least one; what is not tied to the same
text by then is compared pair by pair, in large buckets only where the prefixes of the shingle
sets meet, which loses no pair above the threshold. A candidate's signature is compared before
its shingles are fetched.
"""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.config import NearDuplicates
from corpusloom.functions.arrays import LETTER, NUMBER, classes, code_points, runs, segment_hashes, slices
from corpusloom.functions.pytext import canonical, canonical_text
from corpusloom.operators.components import connected_components
from corpusloom.operators.joins import join_groups
from corpusloom.session import arrow_function, cut_lineage, ship_package

#: Texts of a bucket up to which pairs are made in the bucket; in larger ones by the prefixes of their shingle sets. Both are exact.
PAIRED = 64
#: Counters that tell frequent shingles from rare ones.
SLOTS = 1 << 18
#: Ordinals up to which they are broadcast.
FEW = 1_000_000
#: Standard deviations by which a candidate's signature may fall short of the threshold (chance below 3e-7).
DEVIATIONS = 5


def text_hash(spark: SparkSession, c: Column | str) -> Column:
    """SHA-256 of the canonical text."""
    return F.sha2(canonical_text(spark, c), 256)


def hashed_stream(df: DataFrame, text: str = "text", name: str = "text_hash") -> DataFrame:
    """The table with the hash of its canonical texts, by a step of its own that also serves streams."""
    ship_package(df.sparkSession)

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [hashlib.sha256(canonical(t or "").encode()).hexdigest() for t in part[text].to_pylist()]
            yield part.append_column(name, pa.array(found, pa.string()))

    return df.mapInArrow(add, T.StructType([*df.schema.fields, T.StructField(name, T.StringType())]))


def first_copies(df: DataFrame, order: Sequence[str], text: str = "text") -> DataFrame:
    """Rows that are the first of their exact copies, found by a pre-aggregated minimum so that no group meets in one task."""
    hashed = df.withColumn("text_hash", text_hash(df.sparkSession, F.coalesce(F.col(text), F.lit(""))))
    first = hashed.groupBy("text_hash").agg(F.min(F.struct(*order)).alias("first")).select("text_hash", "first.*")
    return hashed.join(first, ["text_hash", *order], "left_semi")


def shingle_sets(texts: pa.Array, config: NearDuplicates) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's word n-grams, and the texts' offsets in them.

    Words are runs of letters, numbers and underscores of the case-folded text; a text of at least
    ``min_words`` but fewer than n words has one shingle of all its words.
    """
    folded = pa.array([(t or "").casefold() for t in texts.to_pylist()], pa.large_string())
    cp, offs = code_points(folded)
    kind = classes()[cp]
    starts, ends = runs((kind == LETTER) | (kind == NUMBER) | (cp == ord("_")), offs)
    words = segment_hashes(cp, starts, ends)
    edge = np.searchsorted(starts, offs)
    count = np.diff(edge)
    grams = np.where(count >= config.min_words, np.maximum(count - config.ngram_size + 1, 1), 0)
    doc = np.repeat(np.arange(len(grams)), grams)
    first = edge[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(grams) - grams, grams)
    found = segment_hashes(words, first, np.minimum(first + config.ngram_size, edge[doc + 1]))
    order = np.lexsort((found, doc))
    found, doc = found[order], doc[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    return found[new], np.searchsorted(doc[new], np.arange(len(grams) + 1))


@cache
def coefficients(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the permutations of 64-bit hashes: all multipliers are drawn first."""
    rng = random.Random(seed)
    a = [rng.randrange(1, 1 << 64, 2) for _ in range(n)]
    return np.array(a, np.uint64), np.array([rng.randrange(1 << 64) for _ in range(n)], np.uint64)


def signatures(found: np.ndarray, edges: np.ndarray, config: NearDuplicates) -> np.ndarray:
    """Least a x h + b modulo 2^64 of each text's shingles for each permutation; all ones without shingles."""
    out = np.full((len(edges) - 1, config.num_permutations), ~np.uint64(0), np.uint64)
    full = np.flatnonzero(np.diff(edges))
    if len(full):
        for k, (a, b) in enumerate(zip(*coefficients(config.seed, config.num_permutations))):
            out[full, k] = np.minimum.reduceat(found * a + b, edges[full])
    return out


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each text and band."""
    parts = sig.reshape(len(sig), bands, sig.shape[1] // bands)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]) * np.uint64(0xD1342543DE82EF95)
    for k in range(parts.shape[2]):
        keys = (keys ^ parts[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def sketches(spark: SparkSession, text: Column | str, config: NearDuplicates) -> Column:
    """Struct of the number of shingles, the keys of the bands (none without shingles) and the last bytes of the signature."""

    def sketch(texts: pa.Array) -> pa.Array:
        sizes, keys, edges, marks = [], [], [0], []
        for part in slices(texts):
            found, at = shingle_sets(part, config)
            sig = signatures(found, at, config)
            size = np.diff(at)
            sizes.append(size)
            keys.append(band_keys(sig[size > 0], config.bands).ravel())
            edges.extend((edges[-1] + np.cumsum((size > 0) * config.bands)).tolist())
            marks.extend(row.tobytes() for row in sig.astype(np.uint8))
        none = [np.zeros(0, np.int64)]
        bands = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.concatenate(keys or none)))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(sizes or none).astype(np.int32)), bands, pa.array(marks, pa.binary())], ["size", "bands", "marks"])

    return arrow_function(spark, sketch, "struct<size: int, bands: array<long>, marks: binary>")(F.col(text) if isinstance(text, str) else text)


def shingled(spark: SparkSession, text: Column | str, config: NearDuplicates) -> Column:
    """The sorted shingle hashes of a text."""

    def shingle(texts: pa.Array) -> pa.Array:
        edges, values = [0], []
        for part in slices(texts):
            found, at = shingle_sets(part, config)
            values.append(found.view(np.int64))
            edges.extend((edges[-1] + at[1:]).tolist())
        return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.concatenate(values or [np.zeros(0, np.int64)])))

    return arrow_function(spark, shingle, "array<long>")(F.col(text) if isinstance(text, str) else text)


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Jaccard similarity of two arrays as sets."""
    both = F.size(F.array_intersect(a, b))
    return both / F.greatest(F.size(a) + F.size(b) - both, F.lit(1))


def agreeing(spark: SparkSession, a: Column, b: Column) -> Column:
    """Equal bytes of two binaries of equal length."""

    def count(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([int(np.count_nonzero(np.frombuffer(p, np.uint8) == np.frombuffer(q, np.uint8))) for p, q in zip(x.to_pylist(), y.to_pylist())], pa.int64())

    return arrow_function(spark, count, "long")(a, b)


def least_agreement(config: NearDuplicates) -> int:
    """Agreeing permutations below which a pair is taken for one under the threshold."""
    m, t = config.num_permutations, config.similarity_threshold
    return math.floor(m * t - DEVIATIONS * math.sqrt(m * t * (1 - t)))


class Comparer:
    """Compares pairs (``ordinal``, ``other``) of the texts of a table: signatures first, then shingle sets."""

    def __init__(self, texts: DataFrame, sketched: DataFrame, config: NearDuplicates) -> None:
        self.texts, self.marks, self.config = texts, sketched.select("ordinal", "marks"), config

    def _likely(self, pairs: DataFrame) -> DataFrame:
        mine, other = self.marks.withColumnRenamed("marks", "a"), self.marks.select(F.col("ordinal").alias("other"), F.col("marks").alias("b"))
        both = pairs.join(mine, "ordinal").join(other, "other")
        return both.filter(agreeing(pairs.sparkSession, F.col("a"), F.col("b")) >= least_agreement(self.config)).select("ordinal", "other")

    def sets(self, ordinals: DataFrame) -> DataFrame:
        """``ordinal`` and ``shingles`` of some texts."""
        ordinals = cut_lineage(ordinals.distinct())
        # Few ordinals are sent to the texts; else both are shuffled.
        rows = self.texts.join(F.broadcast(ordinals) if ordinals.count() <= FEW else ordinals, "ordinal", "left_semi")
        return cut_lineage(rows.select("ordinal", shingled(rows.sparkSession, "text", self.config).alias("shingles")))

    def alike(self, pairs: DataFrame) -> DataFrame:
        """The pairs, each once, that reach the threshold, with their ``similarity``."""
        likely = cut_lineage(self._likely(pairs.distinct()))
        sets = self.sets(likely.select("ordinal").unionByName(likely.select(F.col("other").alias("ordinal"))))
        mine, other = sets.withColumnRenamed("shingles", "a"), sets.select(F.col("ordinal").alias("other"), F.col("shingles").alias("b"))
        scored = likely.join(mine, "ordinal").join(other, "other").select("ordinal", "other", jaccard("a", "b").alias("similarity"))
        return cut_lineage(scored.filter(F.col("similarity") >= self.config.similarity_threshold))


def _prefixes(texts: DataFrame, threshold: float) -> DataFrame:
    """``token``, ``place`` for the first shingles of each text, rare ones first.

    Two sets of Jaccard similarity ``threshold`` share one of the first n - ceil(threshold x n) + 1
    shingles of each, in any order that is common to all texts.
    """
    slot = F.pmod("shingle", F.lit(SLOTS)).cast("int")
    found = texts.select(F.explode("shingles").alias("shingle")).groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()

    def prefix(sets: pa.Array) -> pa.Array:
        out = []
        for x in sets:
            h = x.values.to_numpy(zero_copy_only=False)
            out.append(h[np.lexsort((h, counts[h % SLOTS]))][: len(h) - int(np.ceil(threshold * len(h) - 1e-9)) + 1])
        return pa.array(out, pa.list_(pa.int64()))

    first = arrow_function(texts.sparkSession, prefix, "array<long>")("shingles")
    return texts.select("ordinal", "label", F.size("shingles").alias("size"), first.alias("first")).select("ordinal", "label", "size", F.posexplode("first").alias("place", "token"))


def _prefix_pairs(texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs of texts (``ordinal``, ``label``, ``shingles``) with other labels that may reach the threshold."""
    first = cut_lineage(_prefixes(texts, threshold))
    mixed = first.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("token")
    first = first.join(mixed, "token", "left_semi")
    other = first.select("token", *[F.col(c).alias(f"other_{c}") for c in ("ordinal", "label", "size", "place")])
    # At the first shingle that two sets share, what follows in each bounds what they share.
    bound = F.least(F.col("size") - F.col("place"), F.col("other_size") - F.col("other_place"))
    near = bound >= (F.col("size") + F.col("other_size")) * (threshold / (1 + threshold)) - 1e-6
    return first.join(other, "token").filter((F.col("other_ordinal") < F.col("ordinal")) & (F.col("other_label") != F.col("label")) & near).select("ordinal", F.col("other_ordinal").alias("other"))


def near_duplicate_edges(df: DataFrame, config: NearDuplicates, ordinal: str, text: str = "text", source: DataFrame | None = None) -> DataFrame:
    """``ordinal``, ``other`` (the lesser) and ``similarity``: links that tie all alike texts that share a bucket.

    The texts of a bucket are compared with its least one. Of those not tied to the same text
    the pairs are compared, in a bucket of more than ``PAIRED`` texts those whose prefixes meet;
    both ways find every pair above the threshold. With ``verify`` off the members of a bucket
    are tied unseen. ``source`` is a cheaper table that holds the same texts, and perhaps others, from
    which those of candidates are fetched.
    """
    texts = df.select(F.col(ordinal).alias("ordinal"), F.col(text).alias("text"))
    fetched = texts if source is None else source.select(F.col(ordinal).alias("ordinal"), F.col(text).alias("text"))
    sketched = cut_lineage(texts.select("ordinal", sketches(df.sparkSession, "text", config).alias("s")).select("ordinal", "s.*"))
    rows = sketched.select("ordinal", "size", F.explode("bands").alias("key"))
    groups = cut_lineage(rows.groupBy("key").agg(F.min("ordinal").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    total = sketched.count() * config.bands
    shared = join_groups(rows, groups, ["key"], total)
    if not config.verify:
        return shared.filter("ordinal <> least").select("ordinal", F.col("least").alias("other"), F.lit(None).cast("double").alias("similarity")).distinct()
    shared = cut_lineage(shared)
    compare, threshold = Comparer(fetched, sketched, config), config.similarity_threshold
    tied = compare.alike(shared.filter("ordinal <> least").select("ordinal", F.col("least").alias("other")))
    label = tied.groupBy("ordinal").agg(F.min("other").alias("label"))
    marked = cut_lineage(shared.join(label, "ordinal", "left").withColumn("label", F.coalesce("label", "ordinal")))
    mixed = marked.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"), F.max("n").alias("all")).filter("low < high").drop("all")
    small = marked.join(mixed.filter(F.col("n") <= PAIRED).select("key"), "key", "left_semi")
    other = small.select("key", F.col("ordinal").alias("other"), F.col("label").alias("other_label"), F.col("size").alias("other_size"))
    sized = F.least("size", "other_size") >= F.greatest("size", "other_size") * threshold - 1e-6
    pairs = small.join(other, "key").filter((F.col("other") < F.col("ordinal")) & (F.col("other") != F.col("least")) & (F.col("label") != F.col("other_label")) & sized).select("ordinal", "other")
    large = cut_lineage(mixed.filter(F.col("n") > PAIRED).select("key"))
    if not large.isEmpty():
        members = marked.join(F.broadcast(large) if large.count() <= 1000 else large, "key", "left_semi").select("ordinal", "label").distinct()
        pairs = pairs.unionByName(_prefix_pairs(compare.sets(members.select("ordinal")).join(members, "ordinal"), threshold))
    return tied.unionByName(compare.alike(pairs))


def _fallback_id(df: DataFrame, key: str, text_hash_column: str) -> Column:
    """The row's id as text; a missing or blank one is replaced by the hash of the canonical text."""
    value = F.col(key).cast("string")
    return F.when(F.trim(value) != "", value).otherwise(F.concat(F.lit("sha256:"), text_hash_column))


def deduplicate(df: DataFrame, config: NearDuplicates | None = None, ordinal: str = "doc_id", text: str = "text", record_id: str | None = None) -> DataFrame:
    """The table with ``representative``, ``dedup_cluster_id`` and ``kind`` for every row.

    ``ordinal`` gives the scan order and must be unique and not null. ``kind`` is kept, exact (the
    same canonical text as the representative's) or near; a row alone in its cluster is its own representative. Exact copies take part in near
    duplicates through their first row. Null and empty texts are copies of each other.
    ``dedup_cluster_id`` hashes the representative's ``record_id`` (by default its ordinal); a
    blank id is replaced by the hash of the canonical text.
    """
    config = config or NearDuplicates()
    hashed = df.withColumn("__hash", text_hash(df.sparkSession, F.coalesce(F.col(text), F.lit(""))))
    known = cut_lineage(hashed.select(F.col(ordinal).alias("__ordinal"), "__hash", _fallback_id(df, record_id or ordinal, "__hash").alias("__id")))
    groups = cut_lineage(known.groupBy("__hash").agg(F.min("__ordinal").alias("__first"), F.count(F.lit(1)).alias("n")))
    known = join_groups(known, groups, ["__hash"], known.count()).select("__ordinal", "__first", "__id")
    heads = df.select(ordinal, text).join(groups.select(F.col("__first").alias(ordinal)), ordinal, "left_semi")
    clusters = connected_components(near_duplicate_edges(heads, config, ordinal, text, df).select("ordinal", "other"))
    sizes = cut_lineage(clusters.withColumnRenamed("node", "__first"))
    whole = known.join(sizes, "__first", "left").select("__ordinal", "__first", "__id", F.coalesce("component", "__first").alias("representative"))
    kind = F.when(F.col("__ordinal") == F.col("representative"), "kept").when(F.col("__first") == F.col("representative"), "exact").otherwise("near")
    whole = cut_lineage(whole.withColumn("kind", kind))
    names = whole.filter("kind = 'kept'").select("representative", F.concat(F.lit("sha256:"), F.sha2("__id", 256)).alias("dedup_cluster_id"))
    members = whole.groupBy("representative").agg(F.count(F.lit(1)).alias("n")).join(names, "representative")
    labelled = join_groups(whole, cut_lineage(members), ["representative"], whole.count()).select(F.col("__ordinal").alias(ordinal), "representative", "kind", "dedup_cluster_id")
    return df.join(labelled, ordinal)


def match_audit(labelled: DataFrame, config: NearDuplicates | None = None, ordinal: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each removed row: its representative, kind, cluster and similarity with the representative.

    An exact copy has similarity 1; that of a near duplicate may lie below the threshold where a
    chain of others ties the two. Only near duplicates and their representatives are shingled.
    """
    config = config or NearDuplicates()
    slim = labelled.select(F.col(ordinal).alias("o"), "representative", "kind", "dedup_cluster_id", F.col(text).alias("t"))
    near = slim.filter("kind = 'near'").select("o", "representative", "dedup_cluster_id", shingled(slim.sparkSession, "t", config).alias("s"))
    asked = near.groupBy("representative").agg(F.count(F.lit(1)).alias("n"))
    heads = slim.filter("kind = 'kept'").select("representative", "t").join(asked, "representative").select("representative", "n", shingled(slim.sparkSession, "t", config).alias("head"))
    scored = join_groups(cut_lineage(near), cut_lineage(heads), ["representative"], labelled.count())
    out = scored.select(F.col("o").alias("duplicate"), "representative", F.lit("near").alias("kind"), jaccard("s", "head").alias("similarity"), F.col("dedup_cluster_id").alias("cluster_id"))
    exact = slim.filter("kind = 'exact'").select(F.col("o").alias("duplicate"), "representative", "kind", F.lit(1.0).alias("similarity"), F.col("dedup_cluster_id").alias("cluster_id"))
    return out.unionByName(exact)


def preferred_copies(df: DataFrame, cluster: str, quality: Sequence[str], key: str) -> DataFrame:
    """The row of each cluster that is least in the columns ``quality``, then in ``key``, instead of the earliest."""
    best = df.groupBy(cluster).agg(F.min(F.struct(*quality, key)).alias("b")).select(F.col(f"b.{key}").alias(key))
    return df.join(best, key, "left_semi")
