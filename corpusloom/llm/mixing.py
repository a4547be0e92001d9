"""Mixtures of sources with target shares of the total size, by Sainte-Lague apportionment.

The mixture's size is cut into blocks of equal tokens. Sources get blocks by the highest
quotients weight / (2 x blocks + 1) up to what their documents hold when each is taken
``max_repeats`` times; a source's blocks go to its shards in the same manner. A shard's
documents, in a seeded order, fill blocks; every block is taken as often as the quota holds the
whole shard, and once more if it is among those drawn for the rest.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.labels import source_label
from corpusloom.llm.tokens import VOCABULARY, token_count
from corpusloom.session import cut_lineage, ship_package

#: Tokens of a block.
BLOCK_TOKENS = 1024
#: Rows of a shard, and the most groups of shards; the driver holds sources x groups totals.
SHARD_ROWS, GROUPS = 100_000, 1024


def sainte_lague(weights: Sequence[Fraction | int], seats: int, caps: Sequence[int]) -> list[int]:
    """Seats by highest quotients weight / (2 seats + 1), none above its cap; ties go to the first.

    The seats that every divisor in question grants are given at once and only the rest,
    at most about as many as there are weights, one by one.
    """
    n, got, full = len(weights), [0] * len(weights), [w <= 0 or c <= 0 for w, c in zip(weights, caps)]
    while (left := seats - sum(got[i] for i in range(n) if full[i])) > 0 and not all(full):
        free = [i for i in range(n) if not full[i]]
        total = sum(Fraction(weights[i]) for i in free)
        sure = {i: max(0, int(Fraction(weights[i]) * max(Fraction(0), left - Fraction(len(free), 2)) / total + Fraction(1, 2))) for i in free}
        over = [i for i in free if sure[i] >= caps[i]]
        for i in over:
            got[i], full[i] = caps[i], True
        if over:
            continue
        for i in free:
            got[i] = sure[i]
        queue = [(-Fraction(weights[i]) / (2 * got[i] + 1), i) for i in free]
        heapq.heapify(queue)
        for _ in range(left - sum(sure.values())):
            if not queue:
                break
            _, i = heapq.heappop(queue)
            got[i] += 1
            if got[i] < caps[i]:
                heapq.heappush(queue, (-Fraction(weights[i]) / (2 * got[i] + 1), i))
        break
    return got


def block_caps(tokens: int, repeats: int, block_tokens: int) -> int:
    """Whole blocks that hold ``tokens`` taken ``repeats`` times."""
    return -(-tokens * repeats // block_tokens)


class Mixture:
    """The quotas of a mixture, its report and its documents.

    Null and empty texts hold 0 tokens. Sources are compared by their one spelling; a document
    whose source is not among the targets is not taken but counts for the mixture's size. A
    source without rows has 0 tokens. Repeated rows are documents of their own. Blocks that a
    short source cannot fill go to the others by their quotients, and the report shows it.
    No document is taken more than ``max_repeats`` times.
    """

    def __init__(
        self, df: DataFrame, targets: DataFrame, seed: int = 42, text: str = "text", key: str = "doc_id", vocabulary: str = VOCABULARY,
        block_tokens: int = BLOCK_TOKENS, shard_rows: int = SHARD_ROWS,
    ) -> None:
        spark = df.sparkSession
        ship_package(spark)
        self.spark, self.seed, self.block_tokens = spark, seed, block_tokens
        wanted = targets.select("source", source_label("source").alias("label"), "target_share", "max_repeats").orderBy("source").collect()
        sized = df.select(
            F.col(key).alias("doc_id"),
            source_label("source").alias("source"),
            F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("priority"),
            token_count(spark, text, vocabulary).alias("tokens"),
        )
        sized = cut_lineage(sized)
        shards = max(1, -(-sized.count() // shard_rows))
        names = sorted({r.label for r in wanted})
        # The lowest bits choose the shard, the others order its documents.
        self.sized = sized.filter(F.col("source").isin(names)).withColumn("shard", F.pmod("priority", F.lit(shards)))
        cells = cut_lineage(self.sized.groupBy("source", "shard").agg(F.sum("tokens").alias("tokens")).withColumn("group", F.pmod("shard", F.lit(GROUPS))))
        groups = {(r.source, r.group): r.tokens for r in cells.groupBy("source", "group").agg(F.sum("tokens").alias("tokens")).collect()}
        self.total = sized.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
        have = {s: sum(v for (k, _), v in groups.items() if k == s) for s in names}
        share = [Fraction(repr(float(r.target_share or 0))) for r in wanted]
        repeats = [max(0, r.max_repeats or 0) for r in wanted]
        blocks = -(-self.total // block_tokens)
        caps = [block_caps(have[r.label], m, block_tokens) for r, m in zip(wanted, repeats)]
        unbounded = sainte_lague(share, blocks, [blocks] * len(wanted))
        granted = sainte_lague(share, blocks, caps)
        self.lines, by_group, limit = [], {}, {}
        for r, part, m, asked, b, cap in zip(wanted, share, repeats, unbounded, granted, caps):
            own = [groups.get((r.label, i), 0) for i in range(GROUPS)]
            for i, n in enumerate(sainte_lague(own, b, [block_caps(x, m, block_tokens) for x in own])):
                by_group[r.label, i] = n
            limit[r.label] = m
            # Blocks are whole, so where all that a source holds is granted or wanted the tokens themselves decide.
            target = part * self.total
            short = cap <= asked + 1 and have[r.label] * m < target
            self.lines.append((r.source, r.label, float(part), m, have[r.label], float(target), short, asked, b * block_tokens))

        def quotas(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("shard", ignore_index=True)
            source, own = part["source"][0], part["tokens"].tolist()
            m = limit[source]
            got = sainte_lague(own, by_group[source, int(part["group"][0])], [block_caps(x, m, block_tokens) for x in own])
            return pd.DataFrame({"source": source, "shard": part["shard"], "quota": got, "max_repeats": m})

        self.quotas = cut_lineage(cells.filter("tokens > 0").groupBy("source", "group").applyInPandas(quotas, "source string, shard long, quota long, max_repeats long"))

    def documents(self) -> DataFrame:
        """doc_id, source, tokens and the copies of each document that the mixture takes.

        A document belongs to the block that holds its middle token; one without tokens to the
        block at its place.
        """
        one = F.lit(self.block_tokens)
        before = Window.partitionBy("source", "shard").orderBy("priority", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
        middle = F.coalesce(F.sum("tokens").over(before), F.lit(0)) + F.floor(F.col("tokens") / 2)
        placed = cut_lineage(self.sized.withColumn("block", F.floor(middle / one)))
        sizes = placed.groupBy("source", "shard", "block").agg(F.sum("tokens").alias("n")).join(self.quotas, ["source", "shard"])
        shard = Window.partitionBy("source", "shard")
        drawn = shard.orderBy(F.xxhash64(F.lit(self.seed), "source", "shard", "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.withColumns({"whole": F.sum("n").over(shard), "upto": F.coalesce(F.sum("n").over(drawn), F.lit(0))})
        wanted = F.least(F.col("quota") * one, F.col("whole") * F.col("max_repeats"))
        rounds = F.when(F.col("whole") > 0, F.floor(wanted / F.col("whole"))).otherwise(0)
        # A drawn block is taken if more of it lies within what is left of the quota than beyond.
        more = F.when(2 * F.col("upto") + F.col("n") < 2 * (wanted - rounds * F.col("whole")), 1).otherwise(0)
        taken = sizes.select("source", "shard", "block", F.least(rounds + more, F.col("max_repeats")).alias("copies")).filter("copies > 0")
        return placed.join(taken, ["source", "shard", "block"]).select("doc_id", "source", "tokens", "copies")

    def report(self) -> DataFrame:
        """A line for each target: its spelling, target, wanted, planned and actual tokens and shares, and whether its documents fall short."""
        plan = self.spark.createDataFrame(
            self.lines, "source string, label string, target_share double, max_repeats long, available_tokens long, target_tokens double, short boolean, wanted_blocks long, planned_tokens long"
        )
        actual = self.documents().groupBy(F.col("source").alias("label")).agg(F.sum(F.col("tokens") * F.col("copies")).alias("actual_tokens"), F.max("copies").alias("most_copies"))
        all_tokens = F.sum("actual_tokens").over(Window.partitionBy())
        return plan.join(F.broadcast(actual), "label", "left").fillna(0, ["actual_tokens", "most_copies"]).withColumn("actual_share", F.try_divide(F.col("actual_tokens"), all_tokens)).drop("label")

    def short(self) -> DataFrame:
        """Targets to which the apportionment grants no more blocks than they hold, and that hold fewer tokens than their share."""
        return self.spark.createDataFrame([(x[0],) for x in self.lines if x[6]], "source string").distinct()
