"""Row and column spans out of an attribute text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def span(attributes: Column, name: str) -> Column:
    """First number after ``name=``, 1 where there is none.

    The number may belong to a later attribute when the value itself has no
    digit (``rowspan="" colspan=3`` gives 3 for both). A number that does not
    fit 64 bits gives the largest one that does.
    """
    # Fixed value: how a span is written.
    found = F.regexp_extract(attributes, rf"(^|\s){name} *=\D*(\d+)", 2)
    one = F.lit(1).cast("bigint")
    return F.when(~attributes.contains(name) | (found == ""), one).otherwise(
        F.coalesce(found.try_cast("bigint"), F.lit(2**63 - 1))
    )


def row_span(attributes: Column) -> Column:
    return span(attributes, "rowspan")


def col_span(attributes: Column) -> Column:
    return span(attributes, "colspan")
