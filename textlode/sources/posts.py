"""CSV posts: readers and writer."""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlode.operators.corpus import union_all

CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def list_csv(spark: SparkSession, folder: str, skip_prefix: str | None = None) -> list[str]:
    """The `*.csv` entries of a folder, sorted, without those whose name starts with `skip_prefix`."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(posixpath.join(folder, "*.csv"))
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted(status.getPath().toString() for status in files.globStatus(pattern) or [])
    return [p for p in found if not skip_prefix or not posixpath.basename(p).startswith(skip_prefix)]


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | None = None,
    header: bool = True,
    multi_line: bool = True,
    tolerant: bool = False,
) -> DataFrame:
    """CSV files as strings; with `schema`, the given names in the order of the file.

    A header that has other names than `schema` is an error.  Texts may hold
    line breaks; where they are known not to, `multi_line=False` lets Spark
    split large files.  `tolerant` keeps malformed rows in `_corrupt_record`;
    a file that cannot be read is an error all the same (see `readable_files`).
    """
    reader = spark.read.options(**CSV_OPTIONS).option("header", header).option("multiLine", multi_line)
    if schema is not None:
        if tolerant:
            schema = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
        reader = reader.schema(schema).option("enforceSchema", not header)
    if tolerant:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    return reader.csv(paths)


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one CSV entry (a file, or a folder of files with one header)."""
    return tuple(spark.read.options(**CSV_OPTIONS).option("header", True).csv(path).columns)


def readable_files(
    spark: SparkSession, paths: list[str], header: Callable[[SparkSession, str], tuple[str, ...]] = header_of
) -> tuple[dict[tuple[str, ...], list[str]], DataFrame]:
    """The paths by their header, and `(path, error)` for those that cannot be read."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    failed = []
    for path in paths:
        try:
            by_header.setdefault(header(spark, path), []).append(path)
        except Exception as error:  # noqa: BLE001 - whatever the reader raises is reported
            failed.append((path, str(error).split("\n", 1)[0][:300]))
    return by_header, spark.createDataFrame(failed, "path string, error string")


def read_posts(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | None = None,
    skip_prefix: str | None = "combined",
    multi_line: bool = True,
) -> DataFrame:
    """All CSV entries of a folder as one frame; an unreadable one or an empty folder is an error.

    Entries may have different headers: those of one header are read together
    and the groups united by column name.  With `schema` its columns are taken
    by name, and a file without one of them is an error.
    """
    rows, report = read_posts_reported(spark, folder, schema, skip_prefix, multi_line)
    if (bad := report.head()) is not None:
        raise ValueError(f"cannot read {bad.path}: {bad.error}")
    return rows


def read_posts_reported(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | None = None,
    skip_prefix: str | None = "combined",
    multi_line: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The rows of the readable CSV entries of a folder, and `(path, error)` for the others."""
    paths = list_csv(spark, folder, skip_prefix)
    if not paths:
        raise FileNotFoundError(f"no CSV files in {folder}")
    by_header, report = readable_files(spark, paths)
    if not by_header:
        raise ValueError(f"no readable CSV file in {folder}")
    frames = []
    for names, group in by_header.items():
        fields = T.StructType([T.StructField(name, T.StringType()) for name in names])
        rows = read_csv(spark, group, fields, multi_line=multi_line)
        frames.append(rows if schema is None else read_column(rows, *schema.fieldNames()))
    return union_all(*frames), report


def read_column(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns; a missing one is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")
    return df.select(*columns)


def rows_per_file(df: DataFrame) -> DataFrame:
    """`(file_path, n)` of a frame read from files; reads no text."""
    path = F.col("_metadata.file_path").alias("file_path")
    return df.select(path).groupBy("file_path").agg(F.count("*").alias("n"))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True) -> None:
    df.write.options(**CSV_OPTIONS).option("header", header).mode(mode).csv(path)
