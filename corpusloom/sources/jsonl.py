"""JSON-lines sources with physical row numbers, and their reduction to corpus records."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.operators.joins import join_groups
from corpusloom.session import cut_lineage, ship_package

LEGAL = T.StructType([T.StructField(n, T.StringType()) for n in ("language", "type", "text_type", "jurisdiction", "source", "text")])
REPLAY = T.StructType([T.StructField("text", T.StringType()), T.StructField("meta", T.StructType([T.StructField("redpajama_set_name", T.StringType())]))])


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def discover(spark: SparkSession, patterns: str | Sequence[str]) -> list[str]:
    """The files that the glob patterns (or folders) match, sorted by path; fails if there is none."""
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for pattern in [patterns] if isinstance(patterns, str) else patterns:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        fs = path.getFileSystem(conf)
        for status in fs.globStatus(path) or ():
            inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [x.getPath().toString() for x in inside if x.isFile() and x.getPath().getName()[0] not in "._"]
    if not found:
        raise FileNotFoundError(f"no input file matches {patterns}")
    return sorted(set(found))


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``source_file``, ``file_rank``, ``source_row`` (from 1) and ``value`` of every line, blank ones too.

    A row's running id less the first one of its block is its place in the block that a task
    reads; the lines of the blocks before are added. No file needs to lie in one task, and no
    line passes through Python. Malformed UTF-8 becomes U+FFFD. Fails if no file matches.
    """
    files = discover(spark, paths)
    read = spark.read.text(files).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id")
    )
    sizes = cut_lineage(read.groupBy("path", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")))
    upto = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Paths are as many as the driver has listed.
    ranks = spark.createDataFrame(list(enumerate(r.path for r in sizes.select("path").distinct().orderBy("path").collect())), "file_rank int, path string")
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("n").over(upto), F.lit(0))).join(ranks, "path")
    placed = join_groups(read, cut_lineage(offsets.select("path", "block", "first", "offset", "file_rank", "n")), ["path", "block"], sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    return placed.select("source_file", "file_rank", (F.col("id") - F.col("first") + F.col("offset") + 1).alias("source_row"), F.make_valid_utf8("value").alias("value"))


def _reduced(value: object, kind: T.DataType) -> object:
    """A JSON value as a field of the schema holds it: texts as they are, other values as their JSON."""
    if isinstance(kind, T.StructType):
        return {f.name: _reduced(value.get(f.name), f.dataType) for f in kind.fields} if isinstance(value, dict) else None
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def parsed_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The lines' JSON objects as ``record`` (the fields of ``schema``, all texts or structs of them), or the reason in ``error``; parsed once, by a strict reader."""
    ship_package(lines.sparkSession)
    kind = to_arrow_type(schema)

    def parse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            errors, records = [], []
            for text in part["value"].to_pylist():
                try:
                    value = json.loads(text or "")
                    error = None if isinstance(value, dict) else "json_value_is_not_an_object"
                except ValueError as e:
                    value, error = None, f"invalid_json:{e.msg if hasattr(e, 'msg') else e}"
                errors.append(error)
                records.append(None if error else _reduced(value, schema))
            yield part.append_column("error", pa.array(errors, pa.string())).append_column("record", pa.array(records, kind))

    return lines.mapInArrow(parse, _with(_with(lines.schema, "error", T.StringType()), "record", schema))


def filled(*names: Column) -> Column:
    """The first of the columns that is neither null nor empty, else UNKNOWN."""
    return F.coalesce(*[F.when(n != "", n) for n in names], F.lit("UNKNOWN"))


def legal_records(parsed: DataFrame, corpus: str, raw: bool = False) -> DataFrame:
    """Records of the legal corpus: labels with their stand-ins, physical identity and scan order.

    With ``raw`` also lines that hold no record (``is_bad``), and the labels and text as they stand (``raw_…``).
    """
    r = F.col("record")
    rows = parsed if raw else parsed.filter("error IS NULL")
    # A line that holds no record lacks no label.
    extra = [F.when(F.col("error").isNotNull(), "-").otherwise(c).alias(n) for c, n in zip((F.coalesce(r["type"], r["text_type"]), r["jurisdiction"], r["source"], r["text"]), ("raw_type", "raw_jurisdiction", "raw_source", "raw_text"))]
    return rows.select(
        F.lit(corpus).alias("corpus"), "source_file", "source_row", filled(r["type"], r["text_type"]).alias("type"), filled(r["jurisdiction"]).alias("jurisdiction"),
        filled(r["source"]).alias("source"), r["text"].alias("text"), F.struct(F.lit(0).alias("corpus_rank"), F.col("file_rank").cast("long").alias("major"), F.col("source_row").cast("long").alias("minor")).alias("ordinal"),
        *([F.col("error").isNotNull().alias("is_bad"), *extra] if raw else []),
    )


def replay_records(parsed: DataFrame, corpus: str) -> DataFrame:
    """Records of the replay corpus, in the order that takes a line of every file in turn."""
    r = F.col("record")
    return parsed.filter("error IS NULL").select(
        F.lit(corpus).alias("corpus"), "source_file", "source_row", F.lit("general").alias("type"), F.lit("N/A").alias("jurisdiction"),
        filled(r["meta"]["redpajama_set_name"]).alias("source"), r["text"].alias("text"), F.struct(F.lit(1).alias("corpus_rank"), F.col("source_row").cast("long").alias("major"), F.col("file_rank").cast("long").alias("minor")).alias("ordinal"),
    )


def first_rows(lines: DataFrame, rows: int | None) -> DataFrame:
    """The first ``rows`` scanned lines in the order of files and rows, for a run that is limited on purpose."""
    if rows is None:
        return lines
    sizes = {r.file_rank: r.n for r in lines.groupBy("file_rank").agg(F.count(F.lit(1)).alias("n")).collect()}
    keep, left = F.lit(False), rows
    for rank in sorted(sizes):
        if left <= 0:
            break
        keep = keep | ((F.col("file_rank") == rank) & (F.col("source_row") <= left))
        left -= sizes[rank]
    return lines.filter(keep)


def sample_rows(records: DataFrame, rows: int, characters: int, text: str = "text") -> DataFrame:
    """The first ``rows`` records with texts cut to ``characters`` and ids ``sample-<n>``: a sample to try settings on."""
    first = records.orderBy("ordinal").limit(rows)
    numbered = first.withColumn("id", F.concat(F.lit("sample-"), F.row_number().over(Window.orderBy("ordinal")).cast("string")))
    return numbered.withColumn(text, F.left(text, F.lit(characters)))


def source_inventory(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Path, bytes and SHA-256 of each file, read in parts by the executors, so files may have any size."""
    ship_package(spark)
    listed = spark.createDataFrame([(p,) for p in discover(spark, paths)], "path string").repartition("path")

    def digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for part in parts:
            rows = []
            for path in part["path"].to_pylist():
                # The local file system by itself, others as Arrow knows them by their scheme.
                system, at = (fs.LocalFileSystem(), path[5:]) if path.startswith("file:") else fs.FileSystem.from_uri(path)
                sha, size = hashlib.sha256(), 0
                with system.open_input_stream(at) as stream:
                    while block := stream.read(1 << 22):
                        sha.update(block)
                        size += len(block)
                rows.append((path, size, sha.hexdigest()))
            if rows:
                yield pa.record_batch([pa.array(c) for c in zip(*rows)], ["path", "bytes", "sha256"])

    return listed.mapInArrow(digest, "path string, bytes long, sha256 string")


def line_inventory(parsed: DataFrame) -> DataFrame:
    """Valid and invalid rows of each file."""
    return parsed.groupBy("source_file").agg(F.count_if(F.col("error").isNull()).alias("valid_rows"), F.count_if(F.col("error").isNotNull()).alias("invalid_rows"))


def input_manifest(spark: SparkSession, paths: str | Sequence[str], parsed: DataFrame) -> DataFrame:
    """Path, bytes, SHA-256, valid and invalid rows of each input file."""
    files = source_inventory(spark, paths).withColumn("source_file", F.substring_index("path", "/", -1))
    return files.join(line_inventory(parsed), "source_file", "left").fillna(0, ["valid_rows", "invalid_rows"]).select("path", "bytes", "sha256", "valid_rows", "invalid_rows")
