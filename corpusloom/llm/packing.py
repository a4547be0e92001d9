"""Packing texts into containers of fixed token capacity by lexical retrieval.

Documents are ordered by the least hashes of their rarer words, so that those that share words
lie near each other, and cut into shards of bounded size along that order. Each shard holds an
inverted BM25 index of its documents, weighted by the word counts of the whole corpus; the
largest unused document seeds a container and the index returns its unused neighbours, best
first, which fill the container greedily; what is left is closed with the largest unused
documents that fit. A text above the capacity is cut into full containers and a remainder, which
is packed like a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import tokens as tk
from corpusloom.llm.kernel import LETTER, MARK, NUMBER, blocks, classes, lowered, runs, segment_hashes
from corpusloom.session import arrow_function, cut_lineage

#: Tokens and rows of a shard.
SHARD_TOKENS, SHARD_ROWS = 1 << 21, 20_000
#: Counters of the documents that hold a word; words beyond their number share counters.
SLOTS = 1 << 20
#: A word in more than this share of the documents says nothing about where a document belongs.
COMMON = 0.02
K1, B = 1.2, 0.75
_PROFILE = "struct<tokens: long, terms: array<int>, freqs: array<int>>"
_PACKED = "container long, doc_id long, piece int, first_token long, tokens long"


def term_lists(cp: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed words of each text, their frequencies, and the texts' offsets in both."""
    kind = classes()[cp]
    starts, ends = runs((kind == LETTER) | (kind == NUMBER) | (kind == MARK), offs)
    terms = (segment_hashes(lowered()[cp], starts, ends) >> np.uint64(32)) if len(cp) else np.zeros(0, np.uint64)
    doc = np.searchsorted(offs, starts, "right") - 1
    keys, freq = np.unique((doc.astype(np.uint64) << np.uint64(32)) | terms, return_counts=True)
    edge = np.searchsorted(keys >> np.uint64(32), np.arange(len(offs), dtype=np.uint64))
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32), freq.astype(np.int32), edge.astype(np.int32)


def lexical_profile(spark: SparkSession, text: str, vocabulary: str) -> Column:
    """Tokens, hashed words and word frequencies of a text in one pass."""
    ranks = tk.shared_ranks(spark, vocabulary)

    def measure(texts: pa.Array) -> pa.Array:
        counter = tk.worker_counter(vocabulary, ranks)
        sizes, terms, freqs, edges, base = [], [], [], [np.zeros(1, np.int32)], 0
        for cp, offs in blocks(texts):
            t, f, e = term_lists(cp, offs)
            sizes.append(counter.counts(cp, offs))
            terms.append(t)
            freqs.append(f)
            edges.append(e[1:] + base)
            base += len(t)
        none = [np.zeros(0, np.int64)]
        at = pa.array(np.concatenate(edges), pa.int32())
        lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x or none).astype(np.int32))) for x in (terms, freqs)]
        return pa.StructArray.from_arrays([pa.array(np.concatenate(sizes or none)), *lists], ["tokens", "terms", "freqs"])

    return arrow_function(spark, measure, _PROFILE)(F.col(text))


class Corpus:
    """What the index knows of all documents: how many there are, their mean length, and in how many a word occurs."""

    def __init__(self, documents: int, mean_length: float, counts: np.ndarray) -> None:
        self.documents, self.mean_length, self.counts = documents, max(mean_length, 1e-9), counts

    def frequency(self, terms: np.ndarray) -> np.ndarray:
        """Documents that hold each word."""
        return self.counts[terms.astype(np.int64) & (SLOTS - 1)]


def word_counts(items: DataFrame) -> Corpus:
    """The corpus' counts from its profiles; at most ``SLOTS`` counters reach the driver."""
    slot = F.col("term").bitwiseAND(F.lit(SLOTS - 1))
    found = items.select(F.explode("terms").alias("term")).groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    words = F.aggregate("freqs", F.lit(0).cast("long"), lambda a, x: a + x)
    n, length = items.agg(F.count(F.lit(1)), F.coalesce(F.avg(words), F.lit(0.0))).first()
    return Corpus(n, length, counts)


def places(edges: np.ndarray, terms: np.ndarray, corpus: Corpus) -> tuple[np.ndarray, np.ndarray]:
    """Two keys of each document: the least of two hashes among its words that are neither everywhere nor nowhere else."""
    df = corpus.frequency(terms)
    telling = (df > 1) & (df <= max(2, COMMON * corpus.documents))
    doc = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    out = []
    for salt in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        h = (terms.astype(np.uint32).astype(np.uint64) + np.uint64(1)) * np.uint64(salt)
        h ^= h >> np.uint64(32)
        h = (h * np.uint64(0xD1342543DE82EF95)) >> np.uint64(1)
        key = np.full(len(edges) - 1, np.iinfo(np.int64).max, np.int64)
        np.minimum.at(key, doc[telling], h[telling].astype(np.int64))
        out.append(key)
    return out[0], out[1]


class Index:
    """Inverted BM25 index of one shard's items."""

    def __init__(self, edges: np.ndarray, terms: np.ndarray, freqs: np.ndarray, corpus: Corpus) -> None:
        n = len(edges) - 1
        doc = np.repeat(np.arange(n), np.diff(edges))
        length = np.bincount(doc, freqs, n)
        norm = K1 * (1 - B + B * length / corpus.mean_length)
        names, word = np.unique(terms, return_inverse=True)
        df = np.minimum(corpus.frequency(names), corpus.documents)
        idf = np.log1p((corpus.documents - df + 0.5) / (df + 0.5))
        weight = idf[word] * freqs * (K1 + 1) / (freqs + norm[doc])
        order = np.argsort(word, kind="stable")
        self.n, self.edges, self.word = n, edges, word
        self.doc, self.weight = doc[order], weight[order]
        self.start = np.searchsorted(word[order], np.arange(len(names) + 1))

    def scores(self, item: int) -> np.ndarray:
        """BM25 of all items against the words of one."""
        words = self.word[self.edges[item] : self.edges[item + 1]]
        if len(words) == 0:
            return np.zeros(self.n)
        at = np.concatenate([np.arange(a, b) for a, b in zip(self.start[words], self.start[words + 1])])
        return np.bincount(self.doc[at], self.weight[at], self.n)


def fill(sizes: np.ndarray, capacity: int, scores, order: np.ndarray) -> list[list[int]]:
    """Containers of item numbers; ``scores(item)`` rates all items as company of one. Sizes are 1 to capacity."""
    unused = np.ones(len(sizes), bool)
    by_size: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in order[::-1].tolist():
        by_size[sizes[i]].append(i)
    left = np.array([len(x) for x in by_size])
    out = []

    def take(i: int) -> int:
        unused[i] = False
        left[sizes[i]] -= 1
        box.append(i)
        return int(sizes[i])

    for seed in order.tolist():
        if not unused[seed]:
            continue
        box: list[int] = []
        gap = capacity - take(seed)
        if left[: gap + 1].any():
            rated = scores(seed)
            near = np.flatnonzero(unused & (rated > 0) & (sizes <= gap))
            near = near[np.argsort(-rated[near], kind="stable")]
            while len(near):
                gap -= take(int(near[0]))
                near = near[1:][sizes[near[1:]] <= gap]
        while len(fits := np.flatnonzero(left[: gap + 1])):
            stack = by_size[fits[-1]]
            while not unused[stack[-1]]:
                stack.pop()
            gap -= take(stack.pop())
        out.append(box)
    return out


def pack_shard(first: int, ids: list, tokens: np.ndarray, edges: np.ndarray, terms: np.ndarray, freqs: np.ndarray, capacity: int, corpus: Corpus, retrieval: bool = True) -> Iterator[tuple]:
    """Rows (container, id, piece, first token, tokens) of one shard, containers numbered from ``first``; an item of no tokens takes a place of size 0."""
    number = first
    rest = np.where(tokens > capacity, tokens % capacity, tokens)
    for i in np.flatnonzero(tokens > capacity).tolist():
        for piece in range(int(tokens[i] // capacity)):
            yield number, ids[i], piece, piece * capacity, capacity
            number += 1
    items = np.flatnonzero(rest > 0)
    index = Index(edges, terms, freqs, corpus)
    order = np.argsort(-rest[items], kind="stable")
    rate = (lambda i: index.scores(int(items[i]))[items]) if retrieval else lambda i: np.zeros(len(items))
    for box in fill(rest[items], capacity, rate, order):
        for k in box:
            i = int(items[k])
            piece = int(tokens[i] // capacity) if tokens[i] > capacity else 0
            yield number, ids[i], piece, piece * capacity, int(rest[i])
        number += 1
    for i in np.flatnonzero(tokens == 0).tolist():
        yield max(number - 1, first), ids[i], 0, 0, 0


def _flat(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges, words and frequencies of a table of profiles."""
    terms, freqs = part["terms"].combine_chunks(), part["freqs"].combine_chunks()
    edges = np.concatenate(([0], np.cumsum(terms.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
    return edges, terms.flatten().to_numpy(zero_copy_only=False), freqs.flatten().to_numpy(zero_copy_only=False)


def pack(
    df: DataFrame, capacity: int, text: str = "text", key: str = "doc_id", vocabulary: str = tk.VOCABULARY, shard_tokens: int = SHARD_TOKENS, shard_rows: int = SHARD_ROWS, retrieval: bool = True
) -> DataFrame:
    """Containers of at most ``capacity`` tokens holding every document of the table once.

    Rows: container, doc_id, piece, first_token, tokens. Only a text above the capacity has
    several pieces. Null and empty texts have 0 tokens and lie in a container of their shard;
    repeated rows are packed each; an empty table gives no rows. Containers never cross shards,
    so each shard wastes at most its last few containers. Equal texts, however many, are split
    over shards. Where shards begin depends on the ranges that Spark samples. Without
    ``retrieval`` documents are packed by size alone (for comparison).
    """
    if capacity < 1:
        raise ValueError("capacity must be at least one token")
    spark = df.sparkSession
    items = df.select(F.col(key).cast("long").alias("doc_id"), lexical_profile(spark, text, vocabulary).alias("p"))
    items = cut_lineage(items.select("doc_id", "p.tokens", "p.terms", "p.freqs"))
    corpus = word_counts(items)
    total = items.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_tokens), -(-corpus.documents // shard_rows))
    shared = spark.sparkContext.broadcast(corpus)

    def place(terms: pa.Array) -> pa.Array:
        edges = np.concatenate(([0], np.cumsum(terms.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
        a, b = places(edges, terms.flatten().to_numpy(zero_copy_only=False), shared.value)
        return pa.StructArray.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    placed = items.withColumn("place", arrow_function(spark, place, "struct<a: long, b: long>")("terms"))
    order = ["place", "doc_id", "tokens"]
    dealt = placed.repartitionByRange(shards, *order).sortWithinPartitions(*order).drop("place")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 40, [], 0

        def close() -> pa.RecordBatch:
            nonlocal number
            part = pa.Table.from_batches(held)
            rows = list(pack_shard(number, part["doc_id"].to_pylist(), part["tokens"].to_numpy(), *_flat(part), capacity, shared.value, retrieval))
            number = max(r[0] for r in rows) + 1
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["container", "doc_id", "piece", "first_token", "tokens"])

        for batch in batches:
            # Ranges are even in rows; one of long texts is cut into several shards.
            for at in range(0, batch.num_rows, 1000):
                piece = batch.slice(at, 1000)
                held.append(piece)
                size += int(piece["tokens"].to_numpy().sum())
                if size > 2 * shard_tokens:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    return dealt.mapInArrow(packed, _PACKED)


def split_documents(packed: DataFrame) -> DataFrame:
    """Ids of the documents that packing had to split, each once."""
    return packed.filter("piece > 0 AND doc_id IS NOT NULL").select("doc_id").distinct()


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, tokens, unused tokens, the fill, and the least number of containers possible."""
    total = F.coalesce(F.sum("tokens"), F.lit(0))
    boxes = F.count(F.lit(1))
    return packed.groupBy("container").agg(F.sum("tokens").alias("tokens")).agg(
        boxes.alias("containers"),
        total.alias("tokens"),
        (boxes * capacity - total).alias("unused_tokens"),
        F.try_divide(total, boxes * capacity).alias("fill"),
        F.ceil(total / capacity).alias("least_containers"),
    )
