"""Ids, priorities and sampling predicates from SHA-256; all independent of partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sha(*parts: Column | str, separator: str = "\0") -> Column:
    """Lower-case hexadecimal SHA-256 of the parts, joined by a separator; null parts count as empty."""
    return F.sha2(F.concat_ws(separator, *[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]), 256)


def stable_id(corpus: Column | str, source_file: Column | str, source_row: Column | str) -> Column:
    """Id of a record by where it physically stands."""
    return F.concat(F.lit("sha256:"), sha(corpus, source_file, source_row))


def threshold_hex(probability: float) -> str | None:
    """The 16 hexadecimal digits below which a share ``probability`` of 64-bit hashes lies; none if all do."""
    return None if probability >= 1 else f"{int(max(probability, 0.0) * 2**64):016x}"


def sampled(seed: int, corpus: str | Column, source_file: Column | str, source_row: Column | str, probability: float) -> Column:
    """Whether a record's hash falls into the share ``probability``; a larger share selects a superset."""
    limit = threshold_hex(probability)
    if limit is None:
        return F.lit(True)
    name = F.lit(corpus) if isinstance(corpus, str) else corpus
    return F.substring(sha(F.lit(str(seed)), name, source_file, source_row), 1, 16) < F.lit(limit)


def priority(seed: int, record_id: Column | str) -> Column:
    """Place of a record in the seeded order."""
    return sha(F.lit(str(seed)), record_id)


def hash_bucket(hexadecimal: Column | str, buckets: int) -> Column:
    """Remainder of the first 64 bits of a hexadecimal hash."""
    return F.pmod(F.conv(F.substring(_col(hexadecimal), 1, 16), 16, 10).cast("decimal(20,0)"), F.lit(buckets).cast("decimal(20,0)")).cast("long")


def bucket_rank_key(seed: int, bucket: Column) -> Column:
    """Hash by which shuffle buckets are ordered."""
    return sha(F.lit(str(seed)), F.lit("bucket"), bucket)


def split_of(seed: int, cluster: Column | str, cuts: dict[str, int], modulus: int = 10_000) -> Column:
    """Split of a cluster by its hash: each split takes its number of the ``modulus`` places, the last the rest."""
    place = hash_bucket(sha(cluster, F.lit(str(seed)), separator=""), modulus)
    out, upto = None, 0
    names = list(cuts)
    for name in names[:-1]:
        upto += cuts[name]
        out = F.when(place < upto, name) if out is None else out.when(place < upto, name)
    return F.lit(names[-1]) if out is None else out.otherwise(names[-1])
