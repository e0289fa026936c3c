"""What the vector searches share: rows that take part, tiles of bounded size, merged answers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wikicells.llm.scratch import settle

#: Rows of a tile's sides, on average.
QUERIES, ROWS = 1024, 4096


def usable(vectors: DataFrame, every: int, zero: bool) -> DataFrame:
    """Rows that take part: (row, vec_id, vector array<double>, dims, is_query), settled, with row ids of their own.

    Vectors take part that are neither null nor empty and hold neither null nor non-finite
    components; those of only zeros if `zero`. Queries are rows whose vec_id is divisible by `every`.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(fine & (F.size("vector") > 0), F.lit(False))
    if not zero:
        good = good & F.exists("vector", lambda x: x != 0)
    rows = rows.where(good).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "vector", F.size("vector").alias("dims"),
        F.coalesce(F.col("vec_id") % every == 0, F.lit(False)).alias("is_query"),
    )
    return settle(rows)


def blocks(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Adds `block`: rows of equal keys, spread by a hash over blocks of `size` rows on average, and the number of `blocks`."""
    counts = rows.groupBy(*keys).agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    return rows.join(counts, keys).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A matrix of vectors of one length."""
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def smallest(candidates: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Those of `candidates` (places in `score` and `ids`) that come first by score, then by id."""
    if len(candidates) > k:  # a heap's work, all at once: what ties with the k-th stays until ids decide
        worst = np.partition(score[candidates], k - 1)[k - 1]
        candidates = candidates[score[candidates] <= worst]
    return candidates[np.lexsort((ids[candidates], score[candidates]))][:k]


def tiles(queries: DataFrame, rows: DataFrame, keys: list[str], solve: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Runs `solve(queries, rows)` for each tile, that is for each value of `keys` that both sides have."""
    both = queries.select(*keys, "row", F.lit(None).cast("long").alias("vec_id"), "vector", F.lit(True).alias("asks")).union(
        rows.select(*keys, "row", "vec_id", "vector", F.lit(False).alias("asks"))
    )

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks")
        return solve(table.filter(asks), table.filter(pc.invert(asks)))

    return both.groupBy(*keys).applyInArrow(run, schema)


def best(found: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """The k first answers of each query row, with their rank, out of those of its tiles."""
    window = Window.partitionBy("query_row").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
