"""Parquet to JSON lines with verification, and relabelled benchmark tables."""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from corpusloom.session import ship_package
from corpusloom.sources.jsonl import discover

LETTERS = string.ascii_uppercase


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The table; fails if a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def multiple_choice_rows(df: DataFrame, subject: str) -> DataFrame:
    """question, choices, label, answer_index and subject; fails on another subject or an answer outside the choices."""
    require_columns(df, ["question", "subject", "choices", "answer"])
    ok = (F.col("subject") == subject) & (F.col("answer") >= 0) & (F.col("answer") < F.size("choices")) & (F.size("choices") <= len(LETTERS))
    answer = F.when(F.coalesce(ok, F.lit(False)), F.col("answer")).otherwise(F.raise_error(F.lit(f"a row is not a valid question of {subject}")))
    rows = df.withColumn("answer_index", answer)
    return rows.select("question", "choices", F.substring(F.lit(LETTERS), F.col("answer_index").cast("int") + 1, F.lit(1)).alias("label"), "answer_index", "subject")


def instruct_rows(df: DataFrame) -> DataFrame:
    """The table of an instruction benchmark, with all its columns; fails if a needed one is missing."""
    return require_columns(df, ["answer", "index", "task_type", "task_name", "inputs"])


def write_json_lines(df: DataFrame, folder: str, overwrite: bool = False, rows_per_file: int | None = None, partition_by: Sequence[str] = ()) -> None:
    """Write JSON lines; refuses a folder that exists unless told otherwise. Null fields are kept."""
    writer = df.write.mode("overwrite" if overwrite else "errorifexists").option("ignoreNullFields", "false")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*partition_by) if partition_by else writer).json(folder)


def read_rows(spark: SparkSession, source: str) -> DataFrame:
    """Rows of a Parquet table, or of a folder of Arrow files (streams, as data set libraries store them)."""
    try:
        arrow = [p for p in discover(spark, source) if p.endswith(".arrow")]
    except FileNotFoundError:
        arrow = []
    return arrow_rows(spark, arrow) if arrow else spark.read.parquet(source)


def arrow_rows(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Rows of Arrow stream or file-format files, a task for each file, in batches as they are stored."""
    ship_package(spark)

    def open_batches(path: str) -> Iterator[pa.RecordBatch]:
        system, at = (fs.LocalFileSystem(), path[5:]) if path.startswith("file:") else fs.FileSystem.from_uri(path)
        with system.open_input_file(at) as source:
            if source.read(6) == b"ARROW1":
                reader = pa.ipc.open_file(source)
                yield from (reader.get_batch(i) for i in range(reader.num_record_batches))
            else:
                source.seek(0)
                yield from pa.ipc.open_stream(source)

    schema = from_arrow_schema(next(open_batches(files[0])).schema)
    listed = spark.createDataFrame([(p,) for p in files], "path string").repartition(len(files), "path")
    return listed.mapInArrow(lambda parts: (b for part in parts for p in part["path"].to_pylist() for b in open_batches(p)), schema)


def convert(spark: SparkSession, source: str, folder: str, drop: Sequence[str] = (), overwrite: bool = False, preview: int = 0) -> tuple[int, list[dict]]:
    """Parquet to JSON lines without loss; the rows written, verified by reading them again, and the first few."""
    df = read_rows(spark, source).drop(*drop)
    write_json_lines(df, folder, overwrite)
    read, written = df.count(), spark.read.text(folder).count()
    if read != written:
        raise ValueError(f"{written} of {read} rows were written")
    return written, [r.asDict(recursive=True) for r in df.limit(preview).collect()] if preview else []


def language_export(df: DataFrame, folder: str, language: str = "en", rows_per_file: int = 1_000_000) -> None:
    """Rows of one language in files of bounded length."""
    write_json_lines(df.filter(F.col("language") == language), folder, rows_per_file=rows_per_file)
