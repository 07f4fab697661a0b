"""Reading and writing files."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from obsloom.functions.calendar import parse_time
from obsloom.operators.aggregate import union_all
from obsloom.operators.conform import widen_numeric


def read_raw_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV files with a header, all columns as text. One path, glob or list of files with one header."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.option("header", True).option("enforceSchema", False).csv(paths)


def files_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """The files below the paths by their first line; one job for all of them, one row per file."""
    lines = spark.read.text(list(paths)).select("_metadata.file_path", "_metadata.file_block_start", "value")
    starts = lines.where("file_block_start = 0").withColumn("at", F.monotonically_increasing_id())
    found: dict[str, list[str]] = {}
    for row in starts.groupBy("file_path").agg(F.min_by("value", "at").alias("header")).orderBy("file_path").collect():
        found.setdefault(row["header"], []).append(row["file_path"])
    return found


def read_mixed_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """CSV files whose headers differ, in whatever folders, united by column name: one scan per header."""
    return union_all([read_raw_csv(spark, same) for same in files_by_header(spark, paths).values()])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def rows_with_schema(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few rows from the program, with declared types."""
    return spark.createDataFrame(list(rows), schema)


def read_first(spark: SparkSession, sources: Sequence[tuple[str, str]]) -> DataFrame:
    """The first (format, path) that can be read; formats are ``parquet``, ``csv`` and ``table``."""
    readers: Mapping[str, Callable[[str], DataFrame]] = {
        "parquet": spark.read.parquet,
        "csv": lambda path: read_raw_csv(spark, path),
        "table": spark.read.table,
    }
    missing = []
    for kind, path in sources:
        try:
            return readers[kind](path)
        except AnalysisException as error:
            missing.append(f"{kind} {path}: {error.getCondition()}")
    raise FileNotFoundError("no source can be read: " + "; ".join(missing))


def read_wide(spark: SparkSession, path: str, time: str = "time") -> tuple[DataFrame, int, list[str]]:
    """Parquet with numbers widened to double and a text time parsed: (frame, rows, columns)."""
    df = widen_numeric(spark.read.parquet(path))
    if time in df.columns and isinstance(df.schema[time].dataType, T.StringType):
        df = df.withColumn(time, parse_time(F.col(time)))
    return df, df.count(), df.columns


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the file a row came from and the time it was read."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file")).withColumn(
        "bronze_ingested_at", F.current_timestamp()
    )


def stamped(df: DataFrame, out: str = "update_at") -> DataFrame:
    return df.withColumn(out, F.current_timestamp())


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with header, one per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)
