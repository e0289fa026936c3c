"""Nearest neighbours by a block matrix join on int8 vectors with error bounds."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikicells.llm.vectors import QUERIES, ROWS, best, blocks, matrix, tiles, usable

#: Rounding of bounds, relative; far above that of double precision.
SLACK = 1e-9
#: Stands for a null id: null ids come last among ties.
NO_ID = 2**63 - 1


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scale of each row, length of each row's quantisation error)."""
    scale = np.abs(x).max(axis=1) / 127
    scale = np.where(scale > 0, scale, 1.0)
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    return codes, scale, np.sqrt(((x - codes * scale[:, None]) ** 2).sum(axis=1))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of int8 rows, exact: floats hold integers up to 2^24 (2^53), and multiply faster than integers."""
    kind = np.float32 if left.shape[1] * 127 * 127 < 2**24 else np.float64
    return (left.astype(kind) @ right.astype(kind).T).astype(np.float64)


def bounds(queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the Euclidean distances, from int8 products and error lengths."""
    (a, s, e), (b, t, f) = quantised(queries), quantised(rows)
    norm = lambda codes, scale: (codes.astype(np.float64) ** 2).sum(axis=1) * scale**2
    n, m = norm(a, s), norm(b, t)
    total = np.add.outer(n, m)
    squared = total - 2 * products(a, b) * np.multiply.outer(s, t)
    # cancelled digits count as error as well
    about, lost = np.sqrt(np.maximum(squared, 0)), np.add.outer(e, f) + SLACK * np.sqrt(total)
    wide = np.sqrt(np.maximum(squared, 0) + SLACK * total)
    return np.maximum(np.sqrt(np.maximum(squared - SLACK * total, 0)) - lost, 0), np.maximum(about, wide) + lost


def distances(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, components added in order."""
    return np.sqrt(np.cumsum((rows - query) ** 2, axis=1)[:, -1])


def _tile(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left) and len(right):
            queries, rows = matrix(left.column("vector")), matrix(right.column("vector"))
            query_row, row = left.column("row").to_numpy(), right.column("row").to_numpy()
            ids = right.column("vec_id").fill_null(NO_ID).to_numpy()
            low, high = bounds(queries, rows)
            for i in range(len(queries)):
                other = np.flatnonzero(row != query_row[i])
                if len(other) > k:
                    other = other[low[i][other] <= np.partition(high[i][other], k - 1)[k - 1]]
                survivors = zip(distances(queries[i], rows[other]).tolist(), ids[other].tolist(), row[other].tolist(), strict=True)
                out += [(int(query_row[i]), *hit) for hit in heapq.nsmallest(k, survivors)]
        query_row, score, ids, row = zip(*out, strict=True) if out else ((),) * 4
        return pa.table({
            "query_row": pa.array(query_row, pa.int64()), "row": pa.array(row, pa.int64()),
            "vec_id": pa.array([None if i == NO_ID else i for i in ids], pa.int64()), "score": pa.array(score, pa.float64()),
        })

    return run


def nearest(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows nearest to each query by Euclidean distance. Exact.

    Queries and rows are cut into blocks; a pair of blocks is a tile and a task. In it int8 products
    give each distance up to the quantisation errors of the two vectors; rows whose lower bound
    exceeds the k-th least upper bound are out, the others' distances are computed from the original
    vectors in double precision. A heap keeps the k first answers of a query and tile, and those of
    all tiles are merged.

    Queries are rows whose vec_id is divisible by `every`; candidates are all other rows (a repeated
    vec_id is another row), also such of null vec_id. Ties go to the smaller vec_id, null last. Null,
    empty and zero vectors, and those with null or non-finite components, take no part; vectors of
    other lengths are no candidates. Fewer candidates than k give fewer rows, an empty table none.
    Other columns are left out.
    """
    rows = usable(vectors, every, zero=False)
    queries = blocks(rows.where("is_query"), ["dims"], QUERIES).select("dims", "row", "vector", F.col("block").alias("query_block"), F.col("blocks").alias("query_blocks"))
    sizes = queries.select("dims", "query_blocks").distinct()
    data = blocks(rows, ["dims"], ROWS).select("dims", "row", "vec_id", "vector", "block", "blocks")
    counts = data.select("dims", "blocks").distinct()
    left = queries.join(counts, "dims").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = data.join(sizes, "dims").withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    tile = ["dims", "query_block", "block"]
    found = tiles(left, right, tile, _tile(k), "query_row long, row long, vec_id long, score double")
    found = best(found, k, [F.col("score"), F.col("vec_id").asc_nulls_last(), F.col("row")])
    names = rows.where("is_query").select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"))
    return found.join(names, "query_row").select("query_id", "rank", "vec_id", "score")
