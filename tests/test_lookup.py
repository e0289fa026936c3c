"""Looking up pages in a stored index of streams."""

import pytest
from pyspark.sql import functions as F

import wikicells as wc
from wikicells.sources.index import stream_ranges, streams_with_pages
from wikicells.sources.lookup import id_ranges

PAGES = 100_000


@pytest.fixture(scope="module")
def index(spark):
    """Four files with 250 streams of 100 pages; ids have gaps, and the third file holds odd ids of the second."""
    n = F.col("id")
    file = F.floor(n / 25_000)
    page = F.when(file.isin(1, 2), 50_000 + (n % 25_000) * 4 + file).otherwise(n * 2)
    path = F.concat(F.lit("/d/w-20201220-pages-articles-multistream-index1.txt-p"), file.cast("string"), F.lit(".bz2"))
    return spark.range(PAGES).select(
        path.alias("index_path"), F.lit("w").alias("dump_id"), (F.floor(n % 25_000 / 100) * 7000 + 600).alias("offset"), page.alias("page_id"), F.lit("t").alias("title")
    ).repartition(8, "page_id")


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.range(4).select(
        F.lit("w").alias("dump_id"),
        F.concat(F.lit("/d/w-20201220-pages-articles-multistream-index1.txt-p"), F.col("id").cast("string"), F.lit(".bz2")).alias("index_path"),
        F.concat(F.lit("/d/data-p"), F.col("id").cast("string")).alias("data_path"), F.lit(2_000_000).cast("long").alias("data_length"),
    )


@pytest.fixture(scope="module")
def stored(spark, index, pairs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "streams")
    wc.write_stream_index(wc.streams_with_ids(index, pairs), path, group_rows=16)
    return path


def rows_read(df):
    """Rows that the file scans of an executed plan gave, by Spark's own metric."""
    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = [node.metrics().apply("numOutputRows").value()] if name == "FileSourceScanExec" else []
        children = node.children()
        return own + [n for i in range(children.size()) for n in walk(children.apply(i))]

    return walk(df._jdf.queryExecution().executedPlan())


def test_few_pages_read_a_small_part(spark, index, pairs, stored):
    ids = [0, 2, 199, 60_001, 60_002, 77_777, 99_001, 149_998, 150_000, 199_998]
    wanted = spark.createDataFrame([(i,) for i in [*ids, ids[0], None]], "page_id long")
    found = wc.find_streams(spark, stored, wanted)
    rows = sorted(found.collect())
    expected = streams_with_pages(stream_ranges(wc.stream_offsets(index), pairs), index, wanted)
    assert rows == sorted(expected.select(found.columns).collect()) and len(rows) >= 5
    read = rows_read(found)
    assert len(read) == 2 and all(0 < n <= 16 * 2 * len(ids) < PAGES // 100 for n in read)


def test_many_pages(spark, index, pairs, stored):
    wanted = spark.range(0, 200_000, 333).select(F.col("id").alias("page_id"))
    found = wc.find_streams(spark, stored, wanted)
    expected = streams_with_pages(stream_ranges(wc.stream_offsets(index), pairs), index, wanted)
    assert sorted(found.collect()) == sorted(expected.select(found.columns).collect())


@pytest.mark.parametrize("ids", [[], [None], [1], [-5, 10**12]])
def test_pages_that_no_stream_holds(spark, stored, ids):
    wanted = spark.createDataFrame([("w", i) for i in ids], "dump_id string, page_id long")
    assert wc.find_streams(spark, stored, wanted).collect() == []


def test_ranges_are_few_and_tight(spark):
    wanted = spark.createDataFrame([(i,) for i in [3, 4, 5, 1000, 2**40]], "page_id long")
    assert id_ranges(wanted, 2) == [(3, 1000), (2**40, 2**40)]
    assert id_ranges(spark.range(10_000).select(F.col("id").alias("page_id")), 4) == [(0, 2499), (2500, 4999), (5000, 7499), (7500, 9999)]
