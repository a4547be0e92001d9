"""Joins that stay even where one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys with more than one part in so many of all rows are joined by broadcast; there are at most so many.
HOT_KEYS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], total: int, size: str = "n", look: bool = True) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, which has one row for each key and the number ``size`` of rows with it.

    Keys that hold more than one part in ``HOT_KEYS`` of the ``total`` rows are at most ``HOT_KEYS``
    (times what ``total`` understates), so they are broadcast and their rows stay where they are;
    the rows of all other keys are shuffled. ``groups`` should be checkpointed or cheap: it is
    looked at first, so that rows are read once where no key is hot; without ``look`` they are
    read twice. Null keys join nothing.
    """
    keys = list(keys)
    cut = max(total / HOT_KEYS, 1.0)
    if look and groups.filter(F.col(size) > cut).isEmpty():
        return rows.join(groups, keys).select(*rows.columns, *[c for c in groups.columns if c not in keys])
    others = [c for c in groups.columns if c not in keys]
    renamed = {c: f"__hot_{c}" for c in others}
    hot = groups.filter(F.col(size) > cut).withColumnsRenamed(renamed).withColumn("__hot", F.lit(True))
    marked = rows.join(F.broadcast(hot), keys, "left")
    done = marked.filter("__hot").select(*rows.columns, *[F.col(v).alias(k) for k, v in renamed.items()])
    rest = marked.filter("__hot IS NULL").select(*rows.columns)
    return done.unionByName(rest.join(groups.filter(F.col(size) <= cut), keys).select(*rows.columns, *others))
