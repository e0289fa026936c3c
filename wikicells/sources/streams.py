"""Reading selected streams of a multistream dump by byte range."""

import bz2
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikicells.sources.files import dump_id_of
from wikicells.sources.pages import PAGE_END, PAGE_START, pages_of_chunks

# The functions below travel with the tasks: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_READ_BYTES = 1 << 20
_BATCH_CHARACTERS = 8 << 20

# Hadoop's names of stores, and Arrow's.
_STORES = {
    "": "file", "file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs",
    "abfs": "abfs", "abfss": "abfss",
}


def _open(path: str):
    from urllib.parse import quote

    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        scheme, rest = "", path
    if _STORES.get(scheme) == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    # plain paths here, URIs there
    system, name = fs.FileSystem.from_uri(f"{_STORES[scheme]}:{quote(rest, safe='/:@')}")
    return system.open_input_file(name)


def check_stores(ranges: DataFrame) -> None:
    """Fails on the driver if a path is in a store that the reader of byte ranges does not know."""
    scheme = F.regexp_extract("data_path", r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    unknown = [r.scheme for r in ranges.select(scheme.alias("scheme")).distinct().where(~F.col("scheme").isin(*_STORES)).limit(9).collect()]
    if unknown:
        raise ValueError(f"byte ranges cannot be read from {', '.join(sorted(unknown))}; known are {', '.join(filter(None, _STORES))}")


class DamagedStream(Exception):
    """Bytes that do not unpack."""


def _chunks_of_range(path: str, start: int, end: int) -> Iterator[str]:
    """Page chunks of the bytes ``[start, end)``, decompressed as they are read."""
    unzip, rest, mark, first = bz2.BZ2Decompressor(), b"", PAGE_END.encode(), start
    with _open(path) as source:
        source.seek(start)
        while start < end:
            packed = source.read(min(_READ_BYTES, end - start))
            if not packed:
                raise ValueError(f"{path} ends {end - start} bytes before its byte range")
            start += len(packed)
            while packed:
                try:
                    unpacked = unzip.decompress(packed)
                except OSError as error:
                    raise DamagedStream(f"damaged stream in {path}, bytes {first} to {end}: {error}") from error
                *pages, rest = (rest + unpacked).split(mark)
                yield from (page.decode("utf-8") for page in pages)
                packed = unzip.unused_data
                if unzip.eof:
                    unzip = bz2.BZ2Decompressor()
    if PAGE_START.encode() in rest:  # a page that the stream cuts off
        yield rest.decode("utf-8", "replace")


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def packed(dump: str, held: list[str | None], damaged: str | None = None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held, pa.string()), pa.array([dump] * len(held), pa.string()), pa.array([damaged] * len(held), pa.string())],
            names=["value", "dump_id", "damaged"],
        )

    for batch in batches:
        for row in batch.to_pylist():
            held: list[str] = []
            size = 0
            damaged = None
            try:
                for chunk in _chunks_of_range(row["data_path"], row["start"], row["end"]):
                    held.append(chunk)
                    size += len(chunk)
                    if size >= _BATCH_CHARACTERS:
                        yield packed(row["dump_id"], held)
                        held, size = [], 0
            except DamagedStream as error:
                damaged = str(error)
            if held:
                yield packed(row["dump_id"], held)
            if damaged:
                yield packed(row["dump_id"], [None], damaged)


def read_streams(ranges: DataFrame, partitions: int | None = None, with_tables_only: bool = False) -> DataFrame:
    """Pages of the streams in ``ranges(data_path, start, end)``.

    Local files, HDFS, S3, Google and Azure stores can be read by byte range;
    another one raises an error here. A range that its file does not hold stops
    the job, a page cut off by the end of its range is kept as corrupt. A stream
    whose bytes do not unpack costs the pages behind the damage, and is a row with
    its file and bytes in ``corrupt``; the next range starts anew.

    The rows are few and small but each stands for about 100 pages of work, so
    they are spread over a fixed number of tasks, which adaptive execution does
    not merge.
    """
    spark = ranges.sparkSession
    if partitions is None:
        partitions = max(
            spark.sparkContext.defaultParallelism * 4,
            int(spark.conf.get("spark.sql.shuffle.partitions")),
        )
    check_stores(ranges)
    named = ranges.select("data_path", dump_id_of(F.col("data_path")).alias("dump_id"), "start", "end")
    chunks = named.repartition(partitions, "data_path", "start").mapInArrow(_read_batches, "value string, dump_id string, damaged string")
    return pages_of_chunks(chunks, with_tables_only)
