"""Exact top-k search by inner product: a Voronoi kNN join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikicells.llm.scratch import settle
from wikicells.llm.vectors import QUERIES, ROWS, best, blocks, matrix, smallest, tiles, usable

#: Pivots, a bounded sample of the rows: as many cells for each length of vectors.
PIVOTS = 48
#: Lengths of vectors that get cells; vectors of rarer lengths share one cell a length.
LENGTHS = 16
#: Relative rounding that bounds allow for.
SLACK = 1e-9
NO_ID = 2**63 - 1


def _chosen(rows: DataFrame, pivots: int) -> dict[int, np.ndarray]:
    """Up to so many pivots for each of the commonest lengths: the rows of least hash."""
    common = [r["dims"] for r in rows.groupBy("dims").count().orderBy(F.desc("count"), "dims").limit(LENGTHS).collect()]
    out = {}
    for dims in common:
        sample = rows.where(F.col("dims") == dims).select("vector").distinct().orderBy(F.xxhash64("vector"), "vector").limit(pivots)
        out[dims] = np.array([r["vector"] for r in sample.collect()])
    return out


def _cells(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds the nearest pivot's number (`cell`) and distance (`away`); 0 and null where a length has no pivots."""
    schema = "row long, vec_id long, vector array<double>, dims int, is_query boolean, cell int, away double"

    def run(batches):
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            cell, away = np.zeros(len(dims), np.int32), np.full(len(dims), np.nan)
            for d in np.unique(dims):
                if d in pivots:
                    at = np.flatnonzero(dims == d)
                    x, p = matrix(pa.chunked_array([batch.column("vector").take(pa.array(at))])), pivots[d]
                    squared = (x**2).sum(axis=1)[:, None] - 2 * x @ p.T + (p**2).sum(axis=1)
                    cell[at] = squared.argmin(axis=1)
                    away[at] = np.sqrt(((x - p[cell[at]]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(away, mask=np.isnan(away))], names=[*batch.schema.names, "cell", "away"]
            )

    return rows.mapInArrow(run, schema)


def needed(queries: list, data: list, pivots: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(query cell, data cell) that can hold one of the k best of a query, from summaries of the cells.

    Summaries are (cell, rows, radius). By Cauchy and Schwarz the product of q and x differs from that
    of their pivots by |p_q| r_x + r_q |p_x| + r_q r_x at most. Cells in the order of what they have
    at least, until they hold k rows besides the query, bound the k-th best from below; cells with
    less at most are out.
    """
    lengths, out = np.sqrt((pivots**2).sum(axis=1)), []
    cell, count, radius = (np.array([d[i] for d in data]) for i in range(3))
    for query, _, reach in queries:
        middle = pivots[cell] @ pivots[query]
        spread = lengths[query] * radius + reach * lengths[cell] + reach * radius
        spread += SLACK * (lengths[query] + reach) * (lengths[cell] + radius)
        order = np.argsort(-(middle - spread), kind="stable")
        enough = np.searchsorted(np.cumsum(count[order]), k + 1)
        least = (middle - spread)[order[enough]] if enough < len(order) else -np.inf
        out += [(query, int(c)) for c in cell[middle + spread >= least]]
    return out


def _plan(spark: SparkSession, cells: DataFrame, pivots: dict[int, np.ndarray], k: int) -> DataFrame:
    """(dims, query_cell, cell) to be solved. Summaries, and so the plan, are bounded by the number of pivots."""
    summary = cells.where(F.col("dims").isin(*pivots)).groupBy("dims", "cell").agg(
        F.count("*").alias("n"), F.max("away").alias("away"), F.sum(F.col("is_query").cast("int")).alias("q"),
        F.max(F.when(F.col("is_query"), F.col("away"))).alias("reach"),
    ).collect() if pivots else []
    pairs = []
    for dims, p in pivots.items():
        own = [r for r in summary if r["dims"] == dims]
        found = needed([(r["cell"], r["q"], r["reach"]) for r in own if r["q"]], [(r["cell"], r["n"], r["away"]) for r in own], p, k)
        pairs += [(dims, a, b) for a, b in found]
    return spark.createDataFrame(pairs, "dims int, query_cell int, cell int")


def _solve(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left) and len(right):
            queries, rows = matrix(left.column("vector")), matrix(right.column("vector"))
            query_row, row = left.column("row").to_numpy(), right.column("row").to_numpy()
            ids = right.column("vec_id").fill_null(NO_ID).to_numpy()
            most = np.abs(queries).max() * np.abs(rows).max() * queries.shape[1]
            if most < 2**53:  # sums of doubles are exact
                scores = (queries @ rows.T).astype(np.int64)
            else:
                scores = np.array(queries.astype(np.int64).astype(object) @ rows.astype(np.int64).astype(object).T, np.int64)
            for i in range(len(queries)):
                found = smallest(np.flatnonzero(row != query_row[i]), -scores[i], ids, k)
                out.append((np.full(len(found), query_row[i]), row[found], ids[found], scores[i][found]))
        query_row, row, ids, score = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4
        return pa.table({"query_row": query_row, "row": row, "vec_id": pa.array(ids, mask=ids == NO_ID), "score": score})

    return run


def top_products(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest inner product with each query. Exact.

    Components become floor(scale * x). Rows and queries are grouped by their nearest pivot. From
    each group's size and radius follows which data groups may hold one of a query group's answers;
    only those are replicated to it. Groups are cut into blocks of bounded size, so a group may be of
    any size; a pair of blocks is solved in one task and hands on its k best for each query.

    Queries are rows whose vec_id is divisible by `every`; candidates are all other rows (a repeated
    vec_id is another row), also such of null vec_id. Ties go to the smaller vec_id, null last. Null
    and empty vectors, and those with null or non-finite components, take no part; zero vectors do.
    Vectors of other lengths are no candidates. Scores have to fit a long, else the task fails.
    Fewer candidates than k give fewer rows, an empty table none. Other columns are left out.
    """
    spark = vectors.sparkSession
    whole = F.transform("embedding", lambda x: F.floor(scale * x.cast("double")).cast("double"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = usable(vectors.select("vec_id", F.when(fine, whole).alias("embedding")), every, zero=True)
    chosen = _chosen(rows, pivots)
    cells = settle(_cells(rows, chosen))
    rare = rows.where(~F.col("dims").isin(*chosen)) if chosen else rows.limit(0)
    plan = _plan(spark, cells, chosen, k).union(rare.select("dims", F.lit(0), F.lit(0)).distinct())
    queries = blocks(cells.where("is_query"), ["dims", "cell"], QUERIES).select(
        "dims", "row", "vector", F.col("cell").alias("query_cell"), F.col("block").alias("query_block"), F.col("blocks").alias("query_blocks")
    )
    data = blocks(cells, ["dims", "cell"], ROWS).select("dims", "row", "vec_id", "vector", "cell", "block", "blocks")
    sizes = queries.select("dims", "query_cell", "query_blocks").distinct()
    counts = data.select("dims", "cell", "blocks").distinct()
    pairs = plan.join(sizes, ["dims", "query_cell"]).join(counts, ["dims", "cell"])
    tile = ["dims", "query_cell", "query_block", "cell", "block"]
    left = queries.join(pairs.drop("query_blocks"), ["dims", "query_cell"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = data.join(pairs.drop("blocks"), ["dims", "cell"]).withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1))
    )
    found = tiles(left, right, tile, _solve(k), "query_row long, row long, vec_id long, score long")
    found = best(found, k, [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("row")])
    names = rows.where("is_query").select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"))
    return found.join(names, "query_row").select("query_id", "rank", "vec_id", "score")
