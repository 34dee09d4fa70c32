"""Joins of a large side with a side whose size is checked first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

# A side is broadcast only when it was counted to hold at most this many rows.
BROADCAST_ROWS = 200_000
# Copies of the small side, and so pieces of each hot key, beyond that size.
SALTS = 32
# Pieces at least of rows that grow manyfold.
PIECES = 200


def unused(name: str, *columns: str) -> str:
    """`name`, or with underscores added, so that it is none of the columns in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(df: DataFrame) -> DataFrame:
    """The columns under plain names, `c0`, `c1`, ..; batch functions cannot take every name."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def within(df: DataFrame, max_rows: int) -> bool:
    """Whether `df` has at most `max_rows` rows; reads no more than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join `big` with a lookup side; `how` is inner, left, left_semi or left_anti.

    A counted-small lookup side is broadcast, so `big` is not shuffled.  A
    larger one is copied `salts` times and the rows of `big` are spread over
    the copies, so that no key of `big`, however hot, ends up in one task.
    Spark takes the copies for as few bytes as the stored table and would
    broadcast them all through the driver, so both sides are told to be merged.
    """
    return hinted_join(big, small, on, how, within(small, max_rows), salts)


def hinted_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str,
    fits: bool,
    salts: int = SALTS,
) -> DataFrame:
    """`lookup_join` for callers that already know whether `small` fits."""
    if fits:
        return big.join(F.broadcast(small), on, how)
    name = unused("_salt", *big.columns, *small.columns)
    salt = F.pmod(F.xxhash64(*map(quoted, big.columns)), F.lit(salts))
    copies = small.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return big.withColumn(name, salt).join(copies.hint("merge"), [*on, name], how).drop(name)


def spread_by(df: DataFrame, *keys: str) -> DataFrame:
    """`df` dealt out by `keys`, for rows that grow manyfold behind: so many pieces that are not merged for being small."""
    pieces = max(PIECES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(pieces, *map(quoted, keys))


def one_per_key(lookup: DataFrame, *keys: str) -> DataFrame:
    """The smallest row of each key, so that a form listed twice multiplies no rows."""
    rest = [c for c in lookup.columns if c not in keys]
    row = unused("_row", *lookup.columns)
    least = F.min(F.struct(*map(quoted, rest))).alias(row)
    return lookup.groupBy(*map(quoted, keys)).agg(least).select(*map(quoted, keys), *[F.col(row).getField(c).alias(c) for c in rest])


def top_per_group(
    df: DataFrame, groups: list[str], order: list[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first `n` rows of each group, with their rank.

    The filter on the row number lets every task keep only its own first `n`
    rows of a group before the shuffle, so a hot group is never moved whole.
    """
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
