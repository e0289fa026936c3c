"""The index files of a multistream dump."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wikicells.sources.files import dump_id_of, plain_path

# Fixed value: the format of an index line, ``offset:page_id:title``.
_LINE = r"(?s)^(\d+):(\d+):(.*)$"

# Streams are looked up in blocks of 1 GiB of the file.
_BLOCK_BITS = 30


def read_index(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(index_path, dump_id, offset, page_id, title)`` of every index line.

    Titles may hold any character. A line of another form stops the job with the
    line and its file: without it, two streams would melt into one.
    """
    lines = spark.read.text(path).where("value != ''").select(
        plain_path(F.col("_metadata.file_path")).alias("index_path"), "value"
    )
    broken = F.raise_error(F.concat_ws(" ", F.lit("no index line in"), "index_path", F.lit(":"), "value"))
    checked = lines.withColumn("value", F.when(F.col("value").rlike(_LINE), F.col("value")).otherwise(broken))
    return checked.select(
        "index_path",
        dump_id_of(F.col("index_path")).alias("dump_id"),
        F.regexp_extract("value", _LINE, 1).cast("bigint").alias("offset"),
        F.regexp_extract("value", _LINE, 2).cast("bigint").alias("page_id"),
        F.regexp_extract("value", _LINE, 3).alias("title"),
    )


def stream_offsets(index: DataFrame) -> DataFrame:
    """The streams of each file: offset, number of pages, first and last page id.

    Index lines are in page order, about 100 to a stream, so the partial
    aggregate before the shuffle leaves one row per stream.
    """
    return index.groupBy("index_path", "offset").agg(
        F.count(F.lit(1)).alias("pages"),
        F.min("page_id").alias("first_page_id"),
        F.max("page_id").alias("last_page_id"),
    )


def stream_ranges(offsets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Byte ranges of the streams, ``start`` inclusive and ``end`` exclusive.

    A stream ends where the next one of its file starts, the last at the end of
    the file. The streams of a block of the file are gathered in one row; only
    these rows, one per GiB, are ordered over the file and joined with the
    listing, and the index is read once.
    """
    stream = F.struct("offset", "pages", "first_page_id", "last_page_id")
    over = Window.partitionBy("index_path").orderBy("block")
    blocks = (
        offsets.withColumn("block", F.shiftright("offset", _BLOCK_BITS))
        .groupBy("index_path", "block")
        .agg(F.sort_array(F.collect_list(stream)).alias("streams"))
        .withColumn("next_block", F.lead(F.col("streams")[0]["offset"]).over(over))
    )
    files = pairs.select("index_path", "dump_id", "data_path", "data_length")
    following = lambda i: F.get(F.col("streams"), i + 1)["offset"]
    ended = F.transform(
        "streams", lambda s, i: F.struct(s.alias("stream"), F.coalesce(following(i), "next_block", "data_length").alias("end"))
    )
    return (
        blocks.join(files, "index_path")
        .select("index_path", "dump_id", "data_path", F.explode(ended).alias("range"))
        .select(
            "index_path",
            "dump_id",
            "data_path",
            F.col("range.stream.offset").alias("start"),
            "range.end",
            "range.stream.pages",
            "range.stream.first_page_id",
            "range.stream.last_page_id",
        )
    )


def streams_with_pages(ranges: DataFrame, index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The streams that hold a wanted page, for ``wanted(page_id)``.

    Page ids are those of one wiki: with more dumps in the index, give
    ``wanted(dump_id, page_id)``.
    """
    keys = [key for key in ("dump_id", "page_id") if key in wanted.columns]
    hit = index.join(wanted.select(*keys), keys, "left_semi").select(
        "index_path", F.col("offset").alias("start")
    )
    return ranges.join(hit, ["index_path", "start"], "left_semi")
