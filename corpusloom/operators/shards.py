"""Token-bounded shards: greedy next-fit over a global order, encoding and digests.

All that next-fit carries from document to document is the token position at which the open
shard began. Positions are cut into slices of many shards. For each position at which a chain
of shards may enter a slice the position at which it leaves it is found in the slice alone; the
chain from the first document is then followed over the slices by path doubling.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.sampling import prefix_sums
from corpusloom.session import cut_lineage, ship_package

#: Shards' worth of tokens in a slice.
SLICE_SHARDS = 64


def next_starts(x: np.ndarray, before: np.ndarray, after: np.ndarray, target: int, total: int) -> np.ndarray:
    """Where the shards after those that begin at positions ``x`` begin; ``total`` where there is none.

    ``before`` and ``after`` are the positions of documents with tokens around which the search
    is done: the next shard begins with the document that holds position x + target, or after it
    if it is the first of its shard.
    """
    if len(after) == 0:
        return np.full(len(x), total)
    i = np.searchsorted(after, x + target, "right")
    known = i < len(after)
    i = np.minimum(i, len(after) - 1)
    return np.where(known, np.where(before[i] > x, before[i], after[i]), total)


def _entries(rows: DataFrame, width: int, target: int, total: int) -> DataFrame:
    """``entry`` and ``leave``: positions at which shards may begin first in a slice, and where that chain first begins one in a later slice."""
    full = rows.filter("__tokens > 0").select("__before", "__tokens", "slice")
    early = full.filter(F.col("__before") % width <= target).filter("slice > 0").withColumn("slice", F.col("slice") - 1)
    behind = full.filter(F.col("__tokens") > target).select((F.col("__before") + F.col("__tokens")).alias("__before")).filter(F.col("__before") < total)
    asked = behind.select("__before", F.lit(0).cast("long").alias("__tokens"), F.floor(F.col("__before") / width).alias("slice"))

    def leave(key: tuple, part: pa.Table) -> pa.Table:
        low, high = key[0].as_py() * width, (key[0].as_py() + 1) * width
        before, tokens = part["__before"].to_numpy(), part["__tokens"].to_numpy()
        x = np.unique(before[(before >= low) & (before < high) & ((tokens == 0) | (before - low <= target))])
        order = np.argsort(before[tokens > 0], kind="stable")
        begin = before[tokens > 0][order]
        end = begin + tokens[tokens > 0][order]
        at = x.copy()
        while (inside := at < high).any() and (at[inside] < total).any():
            at[inside] = next_starts(at[inside], begin, end, target, total)
            if (at >= total)[inside].all():
                break
        return pa.table([pa.array(x, pa.int64()), pa.array(at, pa.int64())], ["entry", "leave"])

    return cut_lineage(full.unionByName(early).unionByName(asked).groupBy("slice").applyInArrow(leave, "entry long, leave long"))


def _reached(entries: DataFrame, total: int) -> list[int]:
    """The entries on the chain from position 0, by path doubling; one for each slice at most."""
    spark = entries.sparkSession
    jump, reached = entries.filter(F.col("leave") < total), [0]
    while True:
        known = spark.createDataFrame([(x,) for x in reached], "entry long")
        more = [r.leave for r in jump.join(F.broadcast(known), "entry").collect()]
        if not set(more) - set(reached):
            return sorted(reached)
        reached = sorted({*reached, *more})
        after = jump.select(F.col("entry").alias("leave"), F.col("leave").alias("next"))
        jump = cut_lineage(jump.join(after, "leave").select("entry", F.col("next").alias("leave")))


def assign_shards(df: DataFrame, order: Sequence[str], tokens: str, target: int, slice_shards: int = SLICE_SHARDS) -> DataFrame:
    """The table with ``shard``, from 0, by next-fit in the given order; null tokens count 0.

    A document opens a shard if none is open, or if the open one has tokens and would exceed the
    target with it; a document above the target gets a shard of its own. ``order`` must be unique.
    Only (order, tokens) are sorted, in slices; texts are joined afterwards.
    """
    if target < 1:
        raise ValueError("the target must be at least one token")
    order = list(order)
    ship_package(df.sparkSession)
    slim = df.select(*order, F.coalesce(F.col(tokens), F.lit(0)).cast("long").alias("__tokens"))
    rows = cut_lineage(prefix_sums(slim, order, "__tokens", "__before").withColumn("__before", F.col("__before").cast("long")))
    total = rows.agg(F.coalesce(F.max(F.col("__before") + F.col("__tokens")), F.lit(0))).first()[0]
    width = target * slice_shards
    rows = rows.withColumn("slice", F.floor(F.least(F.col("__before"), F.lit(max(total - 1, 0))) / width))
    known = {0: 0} if total <= width else {x // width: x for x in _reached(_entries(rows, width, target, total), total)}
    ends = rows.filter(F.col("__tokens") > target).select((F.col("__before") + F.col("__tokens")).alias("e")).filter(F.col("e").isin(*known.values(), total))
    after_large = {r.e for r in ends.collect()}
    early = rows.filter((F.col("__tokens") > 0) & (F.col("__before") % width <= target) & (F.col("__before") >= width))
    mine = rows.withColumn("__own", F.lit(True))
    lent = early.withColumns({"slice": F.col("slice") - 1, "__own": F.lit(False)})
    schema = T.StructType([*slim.drop("__tokens").schema.fields, T.StructField("slice", T.LongType()), T.StructField("local", T.LongType()), T.StructField("starts", T.LongType())])

    def place(key: tuple, part: pa.Table) -> pa.Table:
        number = key[0].as_py()
        before, size, own = (part[c].to_numpy() for c in ("__before", "__tokens", "__own"))
        by = np.argsort(before[size > 0], kind="stable")
        sizes, begin = size[size > 0][by], before[size > 0][by]
        end = begin + sizes
        starts, x = [], known.get(number, total)
        while x < min((number + 1) * width, total):
            starts.append(x)
            x = int(next_starts(np.array([x]), begin, end, target, total)[0])
        if x == total and total in after_large and number == max(total - 1, 0) // width:
            starts.append(x)
        # A document without tokens goes to the shard before the one that begins at its position, but not if that is above the target.
        large = np.isin(starts, [*after_large, *end[sizes > target].tolist()])
        local = np.searchsorted(np.array(starts, np.int64) * 2 - large, 2 * before + np.where(size > 0, 1, -1), "right")
        out = part.append_column("local", pa.array(local, pa.int64())).append_column("starts", pa.array(np.full(len(local), len(starts)), pa.int64()))
        return out.filter(pa.array(own)).select(schema.names).cast(pa.schema([(f.name, out.schema.field(f.name).type) for f in schema.fields]))

    numbered = cut_lineage(mine.unionByName(lent).groupBy("slice").applyInArrow(place, schema))
    counts = {r.slice: r.n for r in numbered.groupBy("slice").agg(F.max("starts").alias("n")).collect()}
    base, upto = [], 0
    for number in sorted(counts):
        base.append((number, upto))
        upto += counts[number]
    bases = df.sparkSession.createDataFrame(base, "slice long, __base long")
    shard = F.greatest(F.col("__base") + F.col("local") - 1, F.lit(0)).alias("shard")
    return df.join(numbered.join(F.broadcast(bases), "slice").select(*order, shard), order)


def packed_sequences(df: DataFrame, order: Sequence[str], tokens: str, length: int) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens: documents in order, each with an end token behind it, cut where a sequence is full.

    Columns of the order, ``sequence``, ``first_token`` (of the document) and ``tokens``, the end
    token counted; the last sequence may be short. Null tokens count 0.
    """
    if length < 1:
        raise ValueError("a sequence must hold at least one token")
    own = (F.coalesce(F.col(tokens), F.lit(0)) + 1).cast("long")
    rows = prefix_sums(df.select(*order, own.alias("__own")), list(order), "__own", "__before")
    first, last = F.floor(F.col("__before") / length), F.floor((F.col("__before") + F.col("__own") - 1) / length)
    cut = rows.withColumn("sequence", F.explode(F.sequence(first, last)))
    begin, end = F.col("sequence") * length, (F.col("sequence") + 1) * length
    held = F.least(end, F.col("__before") + F.col("__own")) - F.greatest(begin, F.col("__before"))
    return cut.select(*order, "sequence", F.greatest(begin - F.col("__before"), F.lit(0)).cast("long").alias("first_token"), held.cast("long").alias("tokens"))


def shard_statistics(sharded: DataFrame, tokens: str = "estimated_tokens") -> DataFrame:
    """Documents and tokens of each shard."""
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens"))


def encode(row: dict) -> bytes:
    """One JSON line: keys in their order, default separators, no escapes beyond JSON's."""
    return (json.dumps(row, ensure_ascii=False) + "\n").encode("utf-8")


def write_shards(sharded: DataFrame, folder: str, order: Sequence[str], columns: Sequence[str], prefix: str = "shard") -> list[dict]:
    """Write a JSONL file for each shard and return name, documents, bytes and SHA-256 of each.

    Executors write beside the final name and rename, so a task that is run again leaves one
    file. The folder must be one that all executors share.
    """
    import os

    os.makedirs(folder, exist_ok=True)
    ship_package(sharded.sparkSession)
    own, order = list(columns), list(order)

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, now = [], None

        def finish() -> None:
            if now is not None:
                now["file"].close()
                os.replace(now["path"], now["final"])
                made.append((now["shard"], os.path.basename(now["final"]), now["documents"], now["bytes"], now["digest"].hexdigest()))

        for part in parts:
            for row in part.to_dict("records"):
                if now is None or now["shard"] != row["shard"]:
                    finish()
                    final = os.path.join(folder, f"{prefix}-{row['shard']:05d}.jsonl")
                    path = f"{final}.{os.getpid()}.part"
                    now = {"shard": row["shard"], "final": final, "path": path, "file": open(path, "wb"), "documents": 0, "bytes": 0, "digest": hashlib.sha256()}  # noqa: SIM115
                line = encode({c: None if row[c] is pd.NA or row[c] != row[c] else row[c] for c in own})
                now["file"].write(line)
                now["digest"].update(line)
                now["documents"] += 1
                now["bytes"] += len(line)
        finish()
        yield pd.DataFrame(made, columns=["shard", "file", "documents", "bytes", "sha256"])

    placed = sharded.select("shard", *dict.fromkeys([*order, *own])).repartition("shard").sortWithinPartitions("shard", *order)
    files = placed.mapInPandas(write, "shard long, file string, documents long, bytes long, sha256 string")
    return [r.asDict() for r in files.orderBy("shard").collect()]
