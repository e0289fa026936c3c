"""Comparing tables as multisets of rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff_rows(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``actual`` and ``expected`` counts.

    One shuffle; copies are counted before it, so a row with very many copies
    sends one row per task.
    """
    columns = expected.columns
    both = actual.select(
        *columns, F.lit(1).alias("in_actual"), F.lit(0).alias("in_expected")
    ).unionByName(
        expected.select(*columns, F.lit(0).alias("in_actual"), F.lit(1).alias("in_expected"))
    )
    return (
        both.groupBy(*columns)
        .agg(F.sum("in_actual").alias("actual_copies"), F.sum("in_expected").alias("expected_copies"))
        .where(F.col("actual_copies") != F.col("expected_copies"))
    )


def same_rows(actual: DataFrame, expected: DataFrame) -> bool:
    """Whether two tables hold the same rows, in any order, copies counted."""
    return set(actual.columns) == set(expected.columns) and diff_rows(actual, expected).isEmpty()
