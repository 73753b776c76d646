"""Ranking rows within keys: the newest version of each key, first rows, full histories."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hazeline.functions.clock import ingest_instant
from hazeline.session import cut_lineage
from hazeline.specs import FILE, INGEST_TOKEN

# A key with more rows than this is not left to one task when every version is ranked.
HOT_KEY_ROWS = 5_000_000


def newest_first(tie_break: Sequence[str | Column] = ()) -> list[Column]:
    """Latest ingest time first, then file name, then the tie-breaks, all descending."""
    last = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in tie_break]
    return [
        ingest_instant(F.col(INGEST_TOKEN)).desc_nulls_last(),
        F.col(FILE).desc_nulls_last(),
        *last,
    ]


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key, or of the whole frame if there are no keys.

    Spark keeps only ``n`` rows per key and input partition before the shuffle
    (``WindowGroupLimit``, or ``TakeOrderedAndProject`` without keys), so a key holding a large
    share of all rows still reaches its task as a handful of rows.
    """
    if not keys:
        return df.orderBy(*order).limit(n)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    return first_rows(df, keys, order, 1)


def version_history(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    rank_column: str = "version_rank",
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Every row with its rank within its key.

    Ranking needs all rows of a key in order, so a plain window would put a key holding a third
    of the table into one task. One pass over the key columns finds such keys, however many; their rows are
    range-partitioned by key *and* order, ranked slice by slice, and shifted by the size of the
    slices before. All other keys take the plain window.
    """
    ranked = _window_rank(keys, order).cast("bigint").alias(rank_column)
    names = [f"_k{i}" for i in range(len(keys))]
    counts = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("_n"))
    hot = cut_lineage(counts.where(F.col("_n") > hot_key_rows), "hot-keys")
    hot_rows = hot.agg(F.sum("_n")).first()[0]
    if not hot_rows:
        return df.select("*", ranked)
    hot = hot.select(*names)
    is_hot = _all(F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names))
    cold = df.join(hot, is_hot, "left_anti").select("*", ranked)

    # Copies that tie on every order column are told apart by where they lie in stored files. Read
    # from a shuffle instead, a repeated task could number them differently and lose one.
    stored = cut_lineage(df.join(hot, is_hot, "left_semi"), "hot-versions")
    slices = 1 + ceil(hot_rows / hot_key_rows)
    placed = cut_lineage(
        stored.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(max(slices, 2), *keys, *order, "_row")
        .withColumn("_slice", F.spark_partition_id()),
        "version-slices",
    )
    earlier = Window.partitionBy(*names).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice and key in it; how it is joined is left to Spark.
    renamed = [F.col(k).alias(n) for k, n in zip(keys, names)]
    shifts = (
        placed.groupBy(*renamed, F.col("_slice").alias("_s"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    )
    same_slice = is_hot & (F.col("_slice") == F.col("_s"))
    within = _window_rank([*keys, "_slice"], [*order, F.col("_row").asc()])
    hot_ranked = (
        placed.withColumn("_within", within)
        .join(shifts, same_slice)
        .select(*df.columns, (F.col("_shift") + F.col("_within")).cast("bigint").alias(rank_column))
    )
    return cold.unionByName(hot_ranked)


def _window_rank(keys: Sequence[str], order: Sequence[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
