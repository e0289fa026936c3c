"""A stored index of streams, of which a lookup of pages reads the parts it needs.

The index files of a dump are text: finding a few pages in them means reading all lines. Stored once
as Parquet, in the order of page ids and in small row groups, the least and largest ids of a row group
tell whether it can hold a wanted page.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wikicells.sources.index import stream_offsets, stream_ranges

#: Streams of a row group, the unit that is read or skipped.
GROUP_ROWS = 512
#: Ranges of ids, at most, by which row groups are chosen.
RANGES = 256
#: Ids of a block, as a power of two; streams and wanted pages meet by blocks.
BLOCK_BITS = 10

_STREAM = ("index_path", "data_path", "start", "end", "pages", "first_page_id", "last_page_id")


def streams_with_ids(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """``stream_ranges`` of an index, with the ``page_ids`` of each stream and their ``blocks``.

    A stream holds about 100 pages, so both are short.
    """
    ids = index.groupBy("index_path", F.col("offset").alias("start")).agg(F.sort_array(F.collect_set("page_id")).alias("page_ids"))
    blocks = F.array_distinct(F.transform("page_ids", lambda i: F.shiftright(i, BLOCK_BITS)))
    return stream_ranges(stream_offsets(index), pairs).join(ids, ["index_path", "start"]).withColumn("blocks", blocks)


def write_stream_index(streams: DataFrame, path: str, mode: str = "errorifexists", group_rows: int = GROUP_ROWS) -> None:
    """Store ``streams_with_ids`` for ``find_streams``, a folder per dump, in the order of page ids."""
    ordered = streams.repartitionByRange("dump_id", "first_page_id", "start").sortWithinPartitions("dump_id", "first_page_id", "start")
    (
        ordered.select("dump_id", *_STREAM, "page_ids", "blocks")
        .write.mode(mode).option("parquet.block.row.count.limit", group_rows).partitionBy("dump_id").parquet(path)
    )


def id_ranges(wanted: DataFrame, most: int = RANGES) -> list[tuple[int, int]]:
    """At most so many ranges, both ends included, that hold all wanted ids.

    The span of the ids is cut into buckets of equal width, each gives the range of the ids that are
    really in it: few rows, however many ids there are.
    """
    ends = wanted.agg(F.min("page_id").alias("low"), F.max("page_id").alias("high")).first()
    if ends.low is None:
        return []
    width = max(1, -(-(ends.high - ends.low + 1) // most))
    bucket = F.floor((F.col("page_id") - ends.low) / F.lit(width)).cast("long")
    found = wanted.where("page_id IS NOT NULL").groupBy(bucket.alias("bucket")).agg(F.min("page_id").alias("low"), F.max("page_id").alias("high"))
    return sorted((row.low, row.high) for row in found.collect())


def _may_hold(ranges: list[tuple[int, int]]) -> Column:
    """Whether a stream's ids reach into a range; simple comparisons, which Parquet checks by row group."""
    reach = [(F.col("first_page_id") <= high) & (F.col("last_page_id") >= low) for low, high in ranges]
    return reduce(lambda a, b: a | b, reach, F.lit(False))


def find_streams(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The streams of a stored index that hold a wanted page, for ``read_streams``.

    ``wanted`` is ``(page_id)``, or ``(dump_id, page_id)`` where the index has several dumps; ids that
    no stream holds, null ids and repeated ids do no harm. The row groups that may hold one are read;
    in these, streams and ids meet by blocks of ids, and between the first and the last id of a
    stream its own ids decide.
    """
    keys = [key for key in ("dump_id", "page_id") if key in wanted.columns]
    wanted = wanted.select(*keys)
    streams = spark.read.parquet(path).where(_may_hold(id_ranges(wanted)))
    by_block = wanted.distinct().withColumn("block", F.shiftright("page_id", BLOCK_BITS))
    by = [*keys[:-1], "block"]
    held = streams.select("dump_id", "index_path", "start", "first_page_id", "last_page_id", "page_ids", F.explode("blocks").alias("block"))
    inside = F.col("page_id").between(F.col("first_page_id"), F.col("last_page_id"))
    hit = held.join(by_block, by).where(inside & F.array_contains("page_ids", F.col("page_id"))).select("index_path", "start")
    return streams.join(hit, ["index_path", "start"], "left_semi").select("dump_id", *_STREAM)
