"""Splits that keep related records together: grouped iterative stratification.

Policy groups that share a user message of the same direction are tied; the components are the
units that are placed. Their label vectors (rows in all and by each value of each label column,
however many there are) are aggregated as cells, the largest components are placed first, the
others in shards of bounded size, where components with the same rare label lie together: the
label that is rarest among what is outstanding comes first, and its components go to the split
that needs it most. Of splits whose needs differ by less than the component has of the label,
those come first that have room for the component's other labels, and of these the one that is
short most by this label and those used up before, so that labels of a row or two do not all go
to the largest split.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.labels import split_label
from corpusloom.operators.components import connected_components
from corpusloom.operators.joins import join_groups
from corpusloom.session import arrow_function, cut_lineage, ship_package

#: Components of more than this share of all rows are placed first, in one task; there are at most its reciprocal.
LARGE_SHARE = 0.001
#: Components of a shard.
SHARD_COMPONENTS = 20_000
#: Slices by which a component's pairs are made.
SLICES = 16


def bare_message(text: str) -> str:
    """A message without blanks, letter case and compatibility or composed forms."""
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return "".join(folded.split())


def bare_messages(spark: SparkSession, c: Column) -> Column:
    """``bare_message`` of a column; null stays null."""

    def strip(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else bare_message(t) for t in texts.to_pylist()], pa.string())

    return arrow_function(spark, strip, "string")(c)


def prompts(df: DataFrame) -> DataFrame:
    """policy_group, direction and ``prompt``, a hash of the bare message, for each user message of each row."""
    said = df.select("policy_group", "direction", F.explode("messages").alias("m")).filter("lower(m.role) = 'user'")
    bare = said.select("policy_group", "direction", bare_messages(df.sparkSession, F.col("m.content")).alias("bare")).filter("bare <> ''")
    return bare.select("policy_group", "direction", F.sha2(F.concat_ws("\0", F.coalesce("direction", F.lit("")), "bare"), 256).alias("prompt"))


def tied_groups(df: DataFrame) -> DataFrame:
    """``node`` (policy_group) and ``component`` for every policy group of the table.

    Each group of a message is tied to the message's least group, so a message that a third of
    all rows share gives one edge for each group. Null groups and empty messages tie nothing.
    """
    pairs = cut_lineage(prompts(df).filter("policy_group IS NOT NULL").select("policy_group", "prompt").distinct())
    least = pairs.groupBy("prompt").agg(F.min("policy_group").alias("least"))
    edges = pairs.join(least, "prompt").filter("policy_group <> least").select("policy_group", "least")
    return connected_components(edges, df.select("policy_group"))


def group_classes(components: DataFrame) -> DataFrame:
    """``policy_group``, ``class_id`` and the number of other groups (``links``) for each group that is tied to another."""
    tied = cut_lineage(components)
    sizes = cut_lineage(tied.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    rows = join_groups(tied, sizes, ["component"], tied.count())
    return rows.select(F.col("node").alias("policy_group"), F.col("component").alias("class_id"), (F.col("n") - 1).alias("links"))


def group_pairs(components: DataFrame) -> DataFrame:
    """Pairs of different groups of one component, smaller first."""
    tied = group_classes(components).select(F.col("policy_group").alias("node"), F.col("class_id").alias("component"))
    a = tied.select(F.col("node").alias("policy_group_a"), "component", F.pmod(F.xxhash64("node"), F.lit(SLICES)).cast("int").alias("slice"))
    b = tied.select(F.col("node").alias("policy_group_b"), "component", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice"))
    return a.join(b, ["component", "slice"]).filter("policy_group_a < policy_group_b").select("policy_group_a", "policy_group_b")


def stratify(counts: np.ndarray, need: np.ndarray) -> np.ndarray:
    """The split of each component. counts: components x labels; need: splits x labels, used up as components are placed."""
    unit, label = np.nonzero(counts)
    return stratify_cells(unit, label, counts[unit, label], len(counts), need)


def stratify_cells(unit: np.ndarray, label: np.ndarray, n: np.ndarray, units: int, need: np.ndarray, goal: np.ndarray | None = None, turn: int = 0) -> np.ndarray:
    """``stratify`` of counts ``n`` by component and label, of which only those above 0 are given.

    ``goal``: what each split needs of all labels, if more than those of ``need``. ``turn``: which
    turn of the splits comes first, so that a label of few components in each of many shards
    does not go to the same split in all of them.
    """
    goal = [float(x) for x in (need.sum(1) if goal is None else goal)]
    places, owed = [s for s, x in enumerate(goal) if x > 0] or range(len(goal)), [0.0] * len(goal)
    by_unit = np.argsort(unit, kind="stable")
    unit, label, n = unit[by_unit], label[by_unit], n[by_unit].astype(float)
    starts = np.searchsorted(unit, np.arange(units + 1))
    size = np.bincount(unit, n, units)
    by_label = np.lexsort((unit, -size[unit], label))
    first = np.searchsorted(label[by_label], np.arange(need.shape[1] + 1))
    place, left = np.full(units, -1), np.bincount(label, n, need.shape[1]).tolist()

    def put(i: int, k: int, count: float) -> None:
        mine = slice(starts[i], starts[i + 1])
        others = list(zip(label[mine].tolist(), n[mine].tolist()))
        wants = need[:, k].tolist()
        most = max(wants[s] for s in places)
        near = [s for s in places if wants[s] >= most or wants[s] > most - count]
        if len(near) > 1:
            for _, other, x in sorted(((left[other], other, x) for other, x in others), reverse=True):
                near = [s for s in near if need[s, other] >= x] or near
                if len(near) == 1:
                    break
        best = max(near, key=lambda s: wants[s] + owed[s])
        place[i] = best
        need[best, label[mine]] -= n[mine]
        for other, x in others:
            left[other] -= x
            if left[other] > 0:
                heappush(heap, (left[other], other))
            else:
                # What a label that is used up leaves unmet is made up for with the next ones.
                for s in places:
                    owed[s] += need[s, other]

    whole, one = sum(goal[s] for s in places), float(n.mean()) if len(n) else 0.0
    for _ in range(turn if whole > 0 else 0):
        for s in places:
            owed[s] += one * goal[s] / whole
        owed[max(places, key=owed.__getitem__)] -= one
    heap = [(x, k) for k, x in enumerate(left) if x > 0]
    heapify(heap)
    while heap:
        x, k = heappop(heap)
        if x == left[k]:
            for c in by_label[first[k] : first[k + 1]]:
                if place[unit[c]] < 0:
                    put(unit[c], k, n[c])
    for i in np.flatnonzero(place < 0):
        put(i, 0, 0.0)
    return place


def length_class(messages: str = "messages") -> Column:
    """Powers of two of the characters of all messages."""
    size = F.aggregate(messages, F.lit(0), lambda n, m: n + F.coalesce(F.length(m.content), F.lit(0)))
    return F.floor(F.log2(F.greatest(F.coalesce(size, F.lit(0)), F.lit(1)))).cast("int")


def row_labels(labels: Sequence[Column | str]) -> Column:
    """The labels of a row: one for being a row, and one for its value in each label column."""
    values = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in labels]
    return F.array(F.lit("row"), *[F.concat(F.lit(f"{k}="), v) for k, v in enumerate(values)])


def _with_component(df: DataFrame) -> DataFrame:
    """The rows with the ``component`` they belong to; rows without a group are kept out of the join on groups."""
    spark = df.sparkSession
    components = cut_lineage(tied_groups(df))
    grouped, alone = df.filter("policy_group IS NOT NULL"), df.filter("policy_group IS NULL")
    sizes = grouped.groupBy("policy_group").agg(F.count(F.lit(1)).alias("n"))
    known = cut_lineage(sizes.join(components.withColumnRenamed("node", "policy_group"), "policy_group"))
    whole = df.count()
    placed = join_groups(grouped, known.select("policy_group", "n", F.col("component").alias("__component")), ["policy_group"], whole)

    first = F.get(F.filter("messages", lambda m: (F.lower(m.role) == "user") & (m.content != "")), 0)["content"]
    alone = alone.withColumn("__bare", bare_messages(spark, first))
    alone = cut_lineage(alone.withColumn("__prompt", F.when(F.col("__bare") != "", F.sha2(F.concat_ws("\0", F.coalesce("direction", F.lit("")), "__bare"), 256))).drop("__bare"))
    asked = alone.filter("__prompt IS NOT NULL").groupBy("__prompt").agg(F.count(F.lit(1)).alias("n"))
    owners = prompts(grouped).select(F.col("prompt").alias("__prompt"), "policy_group").distinct().join(asked.select("__prompt"), "__prompt", "left_semi")
    owners = owners.join(components.withColumnRenamed("node", "policy_group"), "policy_group").groupBy("__prompt").agg(F.min("component").alias("__owner"))
    owned = cut_lineage(asked.join(owners, "__prompt", "left"))
    said = join_groups(alone.filter("__prompt IS NOT NULL"), owned, ["__prompt"], whole)
    said = said.withColumn("__component", F.coalesce("__owner", F.concat(F.lit("row:"), "__prompt")))
    silent = alone.filter("__prompt IS NULL").withColumn("__component", F.concat(F.lit("row:"), F.sha2(F.coalesce("id", F.lit("")), 256)))
    names = [*df.columns, "__component"]
    parts = placed.select(names).unionByName(said.select(names)).unionByName(silent.select(names))
    return parts.drop("component").withColumnRenamed("__component", "component")


def assign_splits(df: DataFrame, targets: DataFrame, labels: Sequence[Column | str] = ("direction",), seed: int = 42, shard_components: int = SHARD_COMPONENTS) -> DataFrame:
    """The table with its new ``assigned_split`` and its ``component``.

    Rows without a policy group go with the groups that share a user message of theirs, else
    with the rows of the same message. A row without messages and group stands alone by its id.
    The given split is ignored; rows delivered twice stay and lie together. Splits are those of
    ``targets``; a null share is 0. An empty table gives an empty result.
    """
    spark = df.sparkSession
    ship_package(spark)
    shares = [(r.split, float(r.target_share or 0)) for r in targets.select(split_label("split").alias("split"), "target_share").orderBy("split").collect()]
    names = [s for s, _ in shares]
    rows = cut_lineage(_with_component(df.drop("assigned_split")))
    cells = cut_lineage(rows.select("component", F.explode(row_labels(labels)).alias("label")).groupBy("component", "label").agg(F.count(F.lit(1)).alias("n")))
    vectors = cells.filter("label = 'row'").select("component", F.col("n").alias("rows"))
    size, components = vectors.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count(F.lit(1))).first()
    share, kinds = np.array([s for _, s in shares]), len(labels) + 1

    def place_large(part: pd.DataFrame) -> pd.DataFrame:
        label, first = np.unique(part["label"].to_numpy(str), return_index=True)
        need = share[:, None] * part["whole"].to_numpy(float)[first][None, :]
        place = stratify_cells(part["unit"].to_numpy(), np.searchsorted(label, part["label"].to_numpy(str)), part["n"].to_numpy(), part["unit"].max() + 1, need, share * size * kinds)
        return pd.DataFrame({"unit": np.arange(len(place)), "split": place})

    large = [r.component for r in vectors.filter(F.col("rows") > LARGE_SHARE * size).orderBy(F.desc("rows"), F.xxhash64(F.lit(seed), "component")).collect()]
    placed = []
    if large:
        theirs = cells.join(F.broadcast(spark.createDataFrame(list(zip(large, range(len(large)))), "component string, unit long")), "component")
        theirs = theirs.join(cells.groupBy("label").agg(F.sum("n").alias("whole")), "label")
        placed = theirs.select("unit", "label", "n", "whole").groupBy().applyInPandas(place_large, "unit long, split long").collect()
    known = spark.createDataFrame([(large[r.unit], names[r.split]) for r in placed], "component string, assigned_split string")

    # Of each label: what splits still need, the rows outstanding and the components that have them.
    open_ = F.col("assigned_split").isNull()
    needs = [F.sum("n") * F.lit(s) - F.coalesce(F.sum(F.when(F.col("assigned_split") == k, F.col("n"))), F.lit(0)) for k, s in shares]
    found = cells.join(F.broadcast(known), "component", "left").groupBy("label").agg(F.array(*needs).alias("need"), F.sum(F.when(open_, F.col("n"))).alias("rest"), F.count_if(open_).alias("units"))
    found = cut_lineage(found.filter("units > 0"))
    rest = cells.join(F.broadcast(known.select("component")), "component", "left_anti")
    rest = join_groups(rest, found, ["label"], found.agg(F.coalesce(F.sum("units"), F.lit(0))).first()[0], size="units")
    shards = max(1, -(-(components - len(large)) // shard_components))
    rarest = F.min(F.struct("rest", "label", "units")).over(Window.partitionBy("component"))
    key = F.when(F.col("rarest.units") <= shard_components, F.xxhash64("rarest.label")).otherwise(F.xxhash64("component"))

    def place_shard(part: pd.DataFrame) -> pd.DataFrame:
        known = pd.DataFrame({"component": part["component"].unique()})
        known = known.assign(o=pd.util.hash_pandas_object(known["component"] + str(seed), index=False)).sort_values(["o", "component"])
        turn, known = int(known["o"].iloc[0] % 997), known["component"]
        unit = pd.Index(known).get_indexer(part["component"])
        names_, first, label = np.unique(part["label"].to_numpy(str), return_index=True, return_inverse=True)
        n = part["n"].to_numpy(float)
        need = np.stack(part["need"].to_numpy()[first]).T * (np.bincount(label, n) / part["rest"].to_numpy(float)[first])[None, :]
        return pd.DataFrame({"component": known, "assigned_split": [names[k] for k in stratify_cells(unit, label, n, len(known), need, turn=turn)]})

    others = rest.withColumn("rarest", rarest).withColumn("shard", F.pmod(key, F.lit(shards))).drop("rarest", "units").groupBy("shard").applyInPandas(place_shard, "component string, assigned_split string")
    chosen = cut_lineage(known.unionByName(others))
    return join_groups(rows, cut_lineage(chosen.join(vectors.select("component", F.col("rows").alias("n")), "component")), ["component"], size).drop("n")


def split_report(assigned: DataFrame, targets: DataFrame, labels: Sequence[Column | str] = ("direction",)) -> DataFrame:
    """Rows, target and actual share of each split, its largest drift of a label's share, and the policy groups that lie in several splits (none)."""
    parts = assigned.select(F.col("assigned_split").alias("split"), F.explode(row_labels(labels)).alias("label"))
    cells = cut_lineage(parts.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n")))
    by_label = cells.groupBy("label").agg(F.sum("n").alias("whole"))
    lines = targets.select(split_label("split").alias("split"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"))
    shares = F.broadcast(lines).join(by_label, F.lit(True)).join(cells, ["split", "label"], "left").fillna(0, ["n"])
    apart = assigned.filter("policy_group IS NOT NULL").groupBy("policy_group").agg(F.count_distinct("assigned_split").alias("n")).filter("n > 1").count()
    row = F.col("label") == "row"
    drift = F.abs(F.col("n") / F.col("whole") - F.col("target_share"))
    got = shares.groupBy("split").agg(F.sum(F.when(row, F.col("n"))).alias("rows"), F.max(F.when(row, F.col("n") / F.col("whole"))).alias("actual_share"), F.max(drift).alias("largest_drift"))
    return lines.join(got, "split", "left").fillna(0, ["rows"]).select("split", "target_share", "rows", "actual_share", "largest_drift", F.lit(apart).cast("long").alias("groups_apart"))
