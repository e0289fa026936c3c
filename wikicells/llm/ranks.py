"""Ranks and running sums over large groups, without a group ever meeting in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hex digits of the shuffle key that cut a group into buckets: 4096 buckets.
DIGITS = 3


def shuffle_key(seed: str, *columns: Column) -> Column:
    """A seeded random-looking key, the same on every engine that knows md5."""
    return F.md5(F.concat_ws(":", F.lit(seed), *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)))


def stratum(column: Column) -> Column:
    """A join key for a nullable string; in code-point order, null last."""
    return F.when(column.isNull(), "1").otherwise(F.concat(F.lit("0"), column))


def ranked(df: DataFrame, group: str, key: str, ties: list[str], value: str) -> DataFrame:
    """Adds, by order of `key` and `ties` within `group`: rank from 0, `before` (sum of `value`
    before the row), `group_rows` and `group_total`.

    Rows are sorted in buckets of the key's leading digits only. Counts of the buckets, at most
    4096 a group whatever its size, give the offsets.
    """
    df = df.withColumn("bucket_", F.substring(key, 1, DIGITS))
    buckets = df.groupBy(group, "bucket_").agg(F.count("*").alias("n_"), F.sum(value).alias("v_"))
    ahead = Window.partitionBy(group).orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    buckets = buckets.select(
        group, "bucket_",
        F.coalesce(F.sum("n_").over(ahead), F.lit(0)).alias("rows_ahead_"),
        F.coalesce(F.sum("v_").over(ahead), F.lit(0)).alias("value_ahead_"),
        F.sum("n_").over(whole).alias("group_rows"),
        F.sum("v_").over(whole).alias("group_total"),
    )
    within = Window.partitionBy(group, "bucket_").orderBy(key, *ties)
    return (
        df.withColumn("rank_", F.row_number().over(within))
        .withColumn("sum_", F.sum(value).over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .join(buckets, [group, "bucket_"])
        .withColumn("rank", F.col("rows_ahead_") + F.col("rank_") - 1)
        .withColumn("before", F.col("value_ahead_") + F.col("sum_") - F.col(value))
        .drop("bucket_", "rank_", "sum_", "rows_ahead_", "value_ahead_")
    )
