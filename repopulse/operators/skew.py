"""Joins and groupings that stay even when one key holds a large share of the rows.

The idea is the same everywhere: count rows per key (few columns, combined map-side), keep the
keys above ``rows_per_split`` and spread each of them over ``rows / rows_per_split`` sub-keys.
Every other key takes the ordinary join and is not replicated.

Where both sides may have very many rows of a key, both are cut, and every pair of blocks is a join key of its own
(``grid_join``).

The list of split keys is made once and broadcast. Its length is bounded by construction, not by a cut: a key is split
when it has more than ``rows_per_split`` rows and more than one ``MAX_SPLIT_KEYS``-th of all rows, and
fewer than ``MAX_SPLIT_KEYS`` keys can have that many. Every key above the limit is split.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SPLIT = 4_000_000
MAX_SPLIT_KEYS = 10_000

_SPLITS, _SPLIT = "_splits", "_split"


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_split: int = ROWS_PER_SPLIT,
             rows: Column | None = None) -> DataFrame:
    """Keys with more than ``rows_per_split`` rows and the number of sub-keys they need.

    ``rows`` is given when ``df`` is already counted (one row per key and partial count).
    """
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n") if rows is None
                                    else F.sum(rows).alias("_n"))
    return hottest(counted, keys, rows_per_split)


def hottest(counted: DataFrame, keys: Sequence[str], rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """``hot_keys`` of rows that are one a key already, with its rows as ``_n``: no shuffle."""
    share = counted.select(F.ceil(F.coalesce(F.sum("_n"), F.lit(0)) / MAX_SPLIT_KEYS)).scalar()
    limit = F.greatest(F.lit(rows_per_split), share)
    return (counted.filter(F.col("_n") > limit)
            .select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias(_SPLITS)))


def split_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """Add the sub-key of every row; 0 for keys that are not hot."""
    salt = F.pmod(F.xxhash64(*spread_by), F.col(_SPLITS)).cast("int")
    return (df.join(F.broadcast(hot), list(keys), "left")
            .withColumn(_SPLIT, F.coalesce(salt, F.lit(0))).drop(_SPLITS))


def replicate_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One copy of each row per sub-key of its key."""
    last = F.coalesce(F.col(_SPLITS), F.lit(1)) - 1
    return (df.join(F.broadcast(hot), list(keys), "left")
            .withColumn(_SPLIT, F.explode(F.sequence(F.lit(0), last))).drop(_SPLITS))


def settled(hot: DataFrame) -> DataFrame | None:
    """The list made once, as rows of the plan; None if no key is hot. It is bounded as said above."""
    rows = hot.collect()
    return hot.sparkSession.createDataFrame(rows, hot.schema) if rows else None


def split_join(facts: DataFrame, dims: DataFrame, keys: Sequence[str], spread_by: Sequence[str],
               hot: DataFrame | None, how: str = "inner",
               strategy: str | None = None, partitions: int | None = None) -> DataFrame:
    """Equi-join of a large, possibly skewed side with a side that has few rows per key.

    ``hot`` are the keys to split, None if there are none.

    ``strategy`` is a join hint for sides that are both large by nature; without one Spark decides
    by size. ``partitions`` is for large facts whose tasks must not grow with the rows. Without hot keys this is the plain join.
    """
    at, hot = [*keys], None if hot is None else settled(hot)
    if hot is not None:
        facts, dims, at = split_hot(facts, hot, keys, spread_by), replicate_hot(dims, hot, keys), [*keys, _SPLIT]
    facts = facts.repartition(partitions, *at) if partitions else facts
    return facts.join(dims.hint(strategy) if strategy else dims, at, how).drop(_SPLIT)


def row_counts(df: DataFrame, keys: Sequence[str], rows: Column | None = None) -> DataFrame:
    """Rows of each key, as one side of ``hot_products``."""
    return df.groupBy(*keys).agg((F.count("*") if rows is None else F.sum(rows)).alias("_rows"))


def hot_products(left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Keys whose rows of both sides (``row_counts``) make more than ``rows_per_split`` rows of the join, and the grid
    that cuts each: ``_across`` blocks of the left side times ``_down`` blocks of the right one.

    There are as many cells as limits in the product; blocks are chosen so that both sides are copied alike, and
    no side gets more blocks than it has rows.
    """
    both = left.select(*keys, F.col("_rows").alias("_l")).join(right.select(*keys, F.col("_rows").alias("_r")), list(keys))
    both = both.withColumn("_n", F.col("_l").cast("double") * F.col("_r"))
    share = both.select(F.coalesce(F.sum("_n"), F.lit(0.0)) / MAX_SPLIT_KEYS).scalar()
    cells = F.ceil(F.col("_n") / F.greatest(F.lit(float(rows_per_split)), share))
    across = F.least(F.col("_l"), F.greatest(F.lit(1), F.round(F.sqrt(cells * F.col("_l") / F.col("_r"))).cast("long")))
    grid = both.withColumn("_cells", cells).filter(F.col("_cells") > 1).withColumn("_across", across)
    grid = grid.withColumn("_down", F.least(F.col("_r"), F.ceil(F.col("_cells") / F.col("_across"))))
    grid = grid.withColumn("_across", F.least(F.col("_l"), F.ceil(F.col("_cells") / F.col("_down"))))
    return grid.select(*keys, F.col("_across").cast("int"), F.col("_down").cast("int"))


def cut_side(df: DataFrame, grid: DataFrame, keys: Sequence[str], spread_by: Sequence[str], own: str, other: str) -> DataFrame:
    """Rows with their block on their own axis of the grid, one copy for each block of the other axis."""
    block = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col(own)).cast("int"), F.lit(0))
    return (df.join(F.broadcast(grid), list(keys), "left")
            .withColumn(f"{own}_block", block)
            .withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)))
            .drop(own, other))


def grid_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_by: Sequence[str], right_by: Sequence[str],
              rows_per_split: int = ROWS_PER_SPLIT, left_counts: DataFrame | None = None, right_counts: DataFrame | None = None) -> DataFrame:
    """Inner equi-join of two sides that may both have very many rows of one key.

    Every cell of a hot key's grid is a join key of its own, so a task makes about ``rows_per_split`` rows of it however
    many the key has. ``left_by`` and ``right_by`` spread a side's rows of one key; counts may be given where
    the sides are dear to make. Without hot keys this is the plain join.
    """
    left_counts = row_counts(left, keys) if left_counts is None else left_counts
    right_counts = row_counts(right, keys) if right_counts is None else right_counts
    grid = settled(hot_products(left_counts, right_counts, keys, rows_per_split))
    if grid is None:
        return left.join(right, list(keys))
    cells = ["_across_block", "_down_block"]
    return (cut_side(left, grid, keys, left_by, "_across", "_down")
            .join(cut_side(right, grid, keys, right_by, "_down", "_across"), [*keys, *cells]).drop(*cells))
