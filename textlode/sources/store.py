"""Corpus tables on shared storage: plain Parquet with a version as partition column.

A write adds rows of the next version to one or more tables and then a row per table to the table `commits`.
Readers take the versions that it names, so a set of tables changes at once, a failed write is not
read, and no file is overwritten while it is read.  An append leaves the earlier versions of a table, a replacement hides them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlode.operators.joins import lookup_join
from textlode.schemas import SEARCH_LOG, SEARCHES
from textlode.session import fresh_dir

VERSION = "version"
COMMITS = "version long, name string, replaces boolean"


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(hadoop_path)


def commits(spark: SparkSession, base: str) -> DataFrame:
    """`(version, name, replaces)`: the tables that each version wrote."""
    if not exists(spark, f"{base}/commits"):
        return spark.createDataFrame([], COMMITS)
    return spark.read.schema(COMMITS).parquet(f"{base}/commits")


def _newest(spark: SparkSession, base: str) -> int:
    return commits(spark, base).agg(F.coalesce(F.max(VERSION), F.lit(0))).head()[0]


def _write(spark: SparkSession, base: str, tables: dict[str, DataFrame], replaces: bool) -> int:
    number = _newest(spark, base) + 1
    for name, df in tables.items():
        # What a failed attempt left under this number is replaced.
        df.write.mode("overwrite").option("parquet.bloom.filter.enabled#lemma", True).parquet(f"{base}/{name}/{VERSION}={number}")
    done = [(number, name, replaces) for name in tables]
    spark.createDataFrame(done, COMMITS).coalesce(1).write.mode("append").parquet(f"{base}/commits")
    return number


def write_version(spark: SparkSession, base: str, tables: dict[str, DataFrame]) -> int:
    """A new version in which the named tables hold these rows only; other tables stay as they are."""
    return _write(spark, base, tables, True)


def append_version(spark: SparkSession, base: str, tables: dict[str, DataFrame]) -> int:
    """A new version holding the stored rows of all tables and the given ones; only these are written."""
    return _write(spark, base, tables, False)


def require_version(spark: SparkSession, base: str) -> int:
    """The newest version; searching without one is an error."""
    number = _newest(spark, base)
    if not number:
        raise FileNotFoundError(f"no corpus in {base}: load data first")
    return number


def _versions(spark: SparkSession, base: str, name: str, number: int) -> list[int]:
    """Versions whose rows a table has at a version: those since it was last replaced."""
    written = commits(spark, base).filter((F.col("name") == name) & (F.col(VERSION) <= number)).orderBy(VERSION).collect()
    last = max((r.version for r in written if r.replaces), default=0)
    return [r.version for r in written if r.version >= last]


def read_version(spark: SparkSession, base: str, name: str, version: int | None = None) -> DataFrame:
    """One table as of a version, by default the newest; a table that was not written by then is an error."""
    found = _versions(spark, base, name, require_version(spark, base) if version is None else version)
    if not found:
        raise KeyError(f"version {version or 'newest'} of {base} holds no table {name}")
    return spark.read.parquet(f"{base}/{name}").filter(F.col(VERSION).isin(found)).drop(VERSION)


def load_or_create(
    spark: SparkSession, base: str, name: str, schema: T.StructType, overwrite: bool = False
) -> DataFrame:
    """The stored table, or an empty one when there is none or `overwrite` is set."""
    if not overwrite and _versions(spark, base, name, _newest(spark, base)):
        return read_version(spark, base, name)
    return spark.createDataFrame([], schema)


def delete_version(
    spark: SparkSession, base: str, ids: DataFrame, names: list[str], key: str = "doc_id"
) -> tuple[int, int]:
    """A new version without the rows whose key is listed; its number, and the rows deleted from the first table.

    The named tables are written anew, the others stay as they are.
    """
    gone = ids.select(key).distinct()
    before = {name: read_version(spark, base, name) for name in names}
    hits = lookup_join(before[names[0]], gone, [key], "left_semi").count()
    return write_version(spark, base, {name: lookup_join(df, gone, [key], "left_anti") for name, df in before.items()}), hits


def settle(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read back.

    For a table several jobs go on from: it is computed once, and a lost
    executor does not bring its whole lineage back.  The folder stays for as long as a result may read it;
    `session.release` deletes all that an application wrote so.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_spread(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table in at least as many pieces as there are cores.

    A table of many files or row groups is read as it is.  One of few, which
    would keep most cores idle, is dealt out to all cores after the scan.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def log_hits(hits: DataFrame, path: str) -> None:
    """Appends `(query_id, rank, doc_id, score)` with the time of the search."""
    rows = hits.withColumn("logged_at", F.current_timestamp())
    columns = [F.col(f.name).cast(f.dataType) for f in SEARCH_LOG.fields]
    rows.select(*columns).write.mode("append").parquet(path)


def log_searches(hits: DataFrame, queries: DataFrame, places: DataFrame, path: str) -> None:
    """Appends a row per hit with the query's text, all positions found in the document, and the time of the search.

    `hits(query_id, rank, doc_id, score)`, `queries(query_id, text)`, `places(query_id, doc_id, start, stop)`.  A hit without a place
    has an empty list.
    """
    spots = places.groupBy("query_id", "doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("positions"))
    rows = hits.join(spots, ["query_id", "doc_id"], "left").join(queries.select("query_id", F.col("text").alias("query_text")), "query_id", "left")
    none = F.array().cast(SEARCHES["positions"].dataType)
    rows = rows.withColumns({"logged_at": F.current_timestamp(), "positions": F.coalesce("positions", none)})
    rows.select(*[F.col(f.name).cast(f.dataType) for f in SEARCHES.fields]).write.mode("append").parquet(path)


def cluster_tokens(tokens: DataFrame) -> DataFrame:
    """Token rows laid out by lemma, so that file statistics serve lemma lookups."""
    return tokens.repartitionByRange("lemma", "doc_id").sortWithinPartitions("lemma", "doc_id")
