"""Samples whose strata match target proportions, by min-cost flow on the counts of the strata.

The networks have a node for each type, each stratum and each jurisdiction. In the first, each
stratum asks for all it needs; the arc beside its availability is slack, dearer than all others,
and exposes what the stratum lacks. In the second exactly the rows of the sample flow: arcs from
the source to the types and from the jurisdictions to the sink carry the margins, lower bounds
the floors, and what a stratum can't give is drawn from others at the least cost for the margins.
The quotas of the strata are drawn by controlled random rounding: whole numbers beside the exact
shares, which they equal on average, with margins and total kept. The driver holds the strata of
the target table only.
"""

from __future__ import annotations

import random
from collections import defaultdict
from fractions import Fraction
from math import ceil, floor, inf

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.labels import jurisdiction_label, type_label
from corpusloom.session import cut_lineage

#: Costs of a row outside its stratum, outside a margin, of a row that is not there, and of a row that a floor lacks.
OFF_STRATUM, OFF_MARGIN, SLACK, OFF_FLOOR = 1, 10, 1000, 100_000
#: Rows in a bucket of the seeded order of a stratum.
BUCKET_ROWS = 50_000


class Network:
    """Min-cost flow by successive cheapest paths over integer capacities."""

    def __init__(self) -> None:
        self.arcs: list[list] = []
        self.out: dict = defaultdict(list)

    def add(self, a, b, capacity: int, cost: int) -> int:
        """An arc; its number serves ``flow``."""
        self.out[a].append(len(self.arcs))
        self.arcs.append([b, capacity, cost])
        self.out[b].append(len(self.arcs))
        self.arcs.append([a, 0, -cost])
        return len(self.arcs) - 2

    def flow(self, arc: int) -> int:
        """What flows through an arc."""
        return self.arcs[arc + 1][1]

    def send(self, source, sink, amount: int) -> int:
        """Send up to ``amount`` at the least cost; what was sent."""
        sent = 0
        while sent < amount:
            cost, via, queue = defaultdict(lambda: inf, {source: 0}), {}, [source]
            while queue:
                nearer = []
                for a in queue:
                    for k in self.out[a]:
                        b, room, price = self.arcs[k]
                        if room > 0 and cost[a] + price < cost[b]:
                            cost[b], via[b] = cost[a] + price, k
                            nearer.append(b)
                queue = list(dict.fromkeys(nearer))
            if sink not in via:
                break
            path, at = [], sink
            while at != source:
                path.append(via[at])
                at = self.arcs[via[at] ^ 1][0]
            push = min(amount - sent, *(self.arcs[k][1] for k in path))
            for k in path:
                self.arcs[k][1] -= push
                self.arcs[k ^ 1][1] += push
            sent += push
        return sent


Cell = tuple[str, str]


def rounded(shares: dict[Cell, Fraction], seed: int) -> dict[Cell, int]:
    """Whole numbers beside ``shares`` (whose total is whole), each equal to its share on average, with every margin rounded to a neighbour.

    Cells beside the table fill its margins to whole numbers. While cells are broken, a cycle of
    them, in turn along rows and columns, is shifted by the most that one way allows; the way is
    drawn such that no cell changes on average.
    """
    rng = random.Random(seed)
    table: dict[tuple, Fraction] = {(("t", t), ("j", j)): Fraction(x) for (t, j), x in shares.items()}
    for side in (0, 1):
        sums: dict = defaultdict(Fraction)
        for cell, x in list(table.items()):
            if cell[side][0] == "tj"[side]:
                sums[cell[side]] += x
        for node, x in sums.items():
            fill = (node, ("j*", "")) if side == 0 else (("t*", ""), node)
            table[fill] = table.get(fill, Fraction(0)) + ceil(x) - x

    def cycle() -> list[tuple] | None:
        near: dict = defaultdict(list)
        for cell, x in table.items():
            if x.denominator > 1:
                for node in cell:
                    near[node].append(cell)
        if not near:
            return None
        node = min(near)
        path, seen = [], {node: 0}
        while True:
            cell = next(c for c in near[node] if not path or c != path[-1])
            node = cell[1] if cell[0] == node else cell[0]
            path.append(cell)
            if node in seen:
                return path[seen[node] :]
            seen[node] = len(path)

    while ring := cycle():
        up, down = ring[::2], ring[1::2]
        more = min([ceil(table[c]) - table[c] for c in up] + [table[c] - floor(table[c]) for c in down])
        less = min([table[c] - floor(table[c]) for c in up] + [ceil(table[c]) - table[c] for c in down])
        step = more if rng.random() < less / (more + less) else -less
        for c in up:
            table[c] += step
        for c in down:
            table[c] -= step
    return {(t, j): int(table[("t", t), ("j", j)]) for t, j in shares}


def lacking_rows(needs: dict[Cell, int], available: dict[Cell, int]) -> dict[Cell, int]:
    """What each stratum (type, jurisdiction) lacks: the flow through its slack arc."""
    rows, columns = defaultdict(int), defaultdict(int)
    for (t, j), n in needs.items():
        rows[t] += n
        columns[j] += n
    net = Network()
    for t, n in rows.items():
        net.add("source", ("t", t), n, 0)
    for j, n in columns.items():
        net.add(("j", j), "sink", n, 0)
    slack = {}
    for cell, n in needs.items():
        net.add(("t", cell[0]), cell, n, 0)
        net.add(cell, ("j", cell[1]), available.get(cell, 0), 0)
        slack[cell] = net.add(cell, ("j", cell[1]), n, SLACK)
    net.send("source", "sink", sum(needs.values()))
    return {c: net.flow(k) for c, k in slack.items()}


def plan_draw(quotas: dict[Cell, int], floors: dict[Cell, int], available: dict[Cell, int]) -> dict[Cell, int]:
    """Rows to draw from each stratum: as many in all as the quotas say, or as the floors if they are more, where that many are there.

    No stratum that has them gives fewer than its floor; beyond the floors quotas and margins of
    the quotas are kept as well as can be.
    """
    rows, columns = defaultdict(int), defaultdict(int)
    for (t, j), n in quotas.items():
        rows[t] += n
        columns[j] += n
    net = Network()
    whole = sum(available.get(c, 0) for c in quotas)
    for t, n in rows.items():
        net.add("source", ("t", t), n, 0)
        net.add("source", ("t", t), whole, OFF_MARGIN)
    for j, n in columns.items():
        net.add(("j", j), "sink", n, 0)
        net.add(("j", j), "sink", whole, OFF_MARGIN)
    drawn = {}
    for cell, quota in quotas.items():
        there = available.get(cell, 0)
        least = min(floors.get(cell, 0), there)
        net.add(("t", cell[0]), cell, least, -OFF_FLOOR)
        net.add(("t", cell[0]), cell, max(0, min(quota, there) - least), 0)
        net.add(("t", cell[0]), cell, there, OFF_STRATUM)
        drawn[cell] = net.add(cell, ("j", cell[1]), there, 0)
    net.send("source", "sink", min(whole, max(sum(quotas.values()), sum(min(f, available.get(c, 0)) for c, f in floors.items()))))
    return {c: net.flow(k) for c, k in drawn.items()}


def distinct_records(df: DataFrame) -> DataFrame:
    """One row for each (source_file, source_row) with its labels, those of its first delivery.

    A row without source_file or source_row is a record of its own kind: rows equal in both count once.
    """
    labelled = df.select("source_file", "source_row", type_label("type", "text_type").alias("type"), jurisdiction_label("jurisdiction").alias("jurisdiction"), "loaded_at")
    first = F.min(F.struct(F.col("loaded_at").isNull().alias("late"), "loaded_at", "type", "jurisdiction")).alias("f")
    return labelled.groupBy("source_file", "source_row").agg(first).select("source_file", "source_row", "f.type", "f.jurisdiction")


class StratifiedSample:
    """A sample of ``fraction`` of the records with the shares of ``targets``.

    The sample has exactly that size, rounded, unless the floors ask for more or the strata hold
    less. A stratum needs the larger of ``min_rows`` and ``target_share`` of the size; what the
    strata lack is drawn from others as near to the margins as can be. Null shares and floors are
    0; lines of one stratum spelled differently are one stratum. An empty table gives an empty
    sample in which every stratum with a floor falls short.
    """

    def __init__(self, df: DataFrame, targets: DataFrame, fraction: Fraction = Fraction(1, 5), seed: int = 42) -> None:
        self.spark, self.seed = df.sparkSession, seed
        rows = targets.select("type", "jurisdiction", type_label("type").alias("t"), jurisdiction_label("jurisdiction").alias("j"), "target_share", "min_rows").collect()
        self.records = cut_lineage(distinct_records(df))
        counts = {(r.type, r.jurisdiction): r.n for r in self.records.join(F.broadcast(targets.select(type_label("type").alias("type"), jurisdiction_label("jurisdiction").alias("jurisdiction")).distinct()), ["type", "jurisdiction"]).groupBy("type", "jurisdiction").agg(F.count(F.lit(1)).alias("n")).collect()}
        total = self.records.count()
        size = fraction * total
        shares, floors = defaultdict(Fraction), defaultdict(int)
        for r in rows:
            shares[r.t, r.j] += Fraction(repr(float(r.target_share or 0)))
            floors[r.t, r.j] = max(floors[r.t, r.j], r.min_rows or 0)
        needs = {c: max(Fraction(floors[c]), x * size) for c, x in shares.items()}
        lacking = lacking_rows({c: ceil(x) for c, x in needs.items()}, counts)
        weight = sum(shares.values())
        quotas = rounded({c: x * round(size) / weight if weight else Fraction(0) for c, x in shares.items()}, seed)
        self.plan = plan_draw(quotas, floors, counts)
        self.lines = [
            (r.type, r.jurisdiction, float(r.target_share or 0), int(r.min_rows or 0), float(needs[r.t, r.j]), quotas[r.t, r.j], counts.get((r.t, r.j), 0), self.plan[r.t, r.j], lacking[r.t, r.j])
            for r in rows
        ]

    def report(self) -> DataFrame:
        """A line for each target: rows needed, the drawn quota, rows available, drawn and lacking."""
        return self.spark.createDataFrame(self.lines, "type string, jurisdiction string, target_share double, min_rows long, needed_rows double, quota_rows long, available_rows long, drawn_rows long, lacking_rows long")

    def short(self) -> DataFrame:
        """Targets, as spelled, whose records do not suffice."""
        return self.report().filter("lacking_rows > 0").select("type", "jurisdiction").distinct()

    def sample(self) -> DataFrame:
        """source_file, source_row, type and jurisdiction of the drawn records, the first of each stratum in a seeded order."""
        quotas = self.spark.createDataFrame([(*c, q) for c, q in self.plan.items()], "type string, jurisdiction string, quota long")
        most = max([x[6] for x in self.lines], default=0)
        buckets = max(1, -(-most // BUCKET_ROWS))
        priority = F.xxhash64(F.lit(self.seed), "source_file", "source_row")
        place = F.floor((priority.cast("double") / 2.0**64 + 0.5) * buckets).cast("int")
        ranked = self.records.join(F.broadcast(quotas), ["type", "jurisdiction"]).withColumns({"priority": priority, "bucket": F.least(place, F.lit(buckets - 1))})
        sizes = ranked.groupBy("type", "jurisdiction", "bucket", "quota").agg(F.count(F.lit(1)).alias("n"))
        below = F.sum("n").over(Window.partitionBy("type", "jurisdiction").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
        room = sizes.select("type", "jurisdiction", "bucket", "n", (F.col("quota") - F.coalesce(below, F.lit(0))).alias("room")).filter("room > 0")
        open_rows = ranked.join(room, ["type", "jurisdiction", "bucket"])
        whole, edge = open_rows.filter("n <= room"), open_rows.filter("n > room")
        order = Window.partitionBy("type", "jurisdiction", "bucket").orderBy("priority", "source_file", "source_row")
        names = ["source_file", "source_row", "type", "jurisdiction"]
        return whole.select(names).unionByName(edge.withColumn("rank", F.row_number().over(order)).filter("rank <= room").select(names))
