"""Dump files written from rendered pages, for trying out the sources."""

import bz2
import html
import sys
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache
from urllib.parse import quote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The writer travels with the tasks: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEADER = '<mediawiki xml:lang="en">\n  <siteinfo>\n    <sitename>Fixture</sitename>\n  </siteinfo>\n'
FOOTER = "</mediawiki>\n"


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def shared_folder(spark: SparkSession) -> str:
    """A new folder where the cluster keeps its checkpoints, a local one in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def write_xml(pages: DataFrame, folder: str, mode: str = "errorifexists") -> str:
    """One bz2 XML file per partition, through the XML sink."""
    pages.select(
        F.col("page_name").alias("title"),
        F.lit(0).alias("ns"),
        F.col("page_id").alias("id"),
        F.struct(
            F.col("page_id").alias("id"),
            F.struct(F.length("text").alias("_bytes"), F.col("text").alias("_VALUE")).alias("text"),
        ).alias("revision"),
    ).write.mode(mode).format("xml").options(
        rowTag="page", rootTag="mediawiki", compression="bzip2"
    ).save(folder)
    return folder


def page_xml(page_id: int, title: str | None, text: str, broken: bool = False) -> str:
    """A page of a dump; ``broken`` leaves out the end of the title, None the title."""
    head = "" if title is None else f"    <title>{html.escape(title)}{'' if broken else '</title>'}\n"
    return (
        f"  <page>\n{head}    <ns>0</ns>\n    <id>{page_id}</id>\n"
        f"    <revision>\n      <id>{page_id}</id>\n      <model>wikitext</model>\n"
        f'      <text bytes="{len(text)}" xml:space="preserve">{html.escape(text)}</text>\n'
        "    </revision>\n  </page>\n"
    )


DUMP = "fixture-20201220-pages-articles-multistream"


def names(range_key: str, dump: str = DUMP) -> tuple[str, str]:
    return f"{dump}1.xml-{range_key}.bz2", f"{dump}-index1.txt-{range_key}.bz2"


def _file_system(folder: str):
    from pyarrow import fs

    if folder.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(folder, safe="/:@"))


def write_multistream(
    folder: str, range_key: str, pages: Iterator[tuple], per_stream: int = 100, dump: str = DUMP, with_index: bool = True,
    damaged: int | None = None,
) -> tuple[int, int]:
    """One data file and its index: a header stream, page streams, a footer stream.

    ``pages`` are ``(page_id, title, text)``, or with a fourth field ``broken``.
    The stream with the page ``damaged`` gets bytes in its middle that are wrong.

    Both files get their names when they are complete, so that a second attempt
    of a task does no harm. Gives the number of streams and of pages.
    """
    system, place = _file_system(folder)
    system.create_dir(place)
    attempt = f"{place}/_{uuid.uuid4().hex}"
    streams = count = 0
    with (
        system.open_output_stream(f"{attempt}.data", compression=None) as data,
        system.open_output_stream(f"{attempt}.index", compression=None) as packed_index,
        bz2.open(packed_index, "wt", encoding="utf-8") as index,
    ):
        data.write(bz2.compress(HEADER.encode()))
        held: list[str] = []
        hit = False

        def stream() -> bytes:
            packed = bytearray(bz2.compress("".join(held).encode()))
            if hit:
                middle = len(packed) // 2
                packed[middle : middle + 8] = bytes(255 - byte for byte in packed[middle : middle + 8])
            return bytes(packed)

        for page in pages:
            hit = hit or page[0] == damaged
            index.write(f"{data.tell()}:{page[0]}:{page[1]}\n")
            held.append(page_xml(*page))
            count += 1
            if len(held) == per_stream:
                data.write(stream())
                streams, held, hit = streams + 1, [], False
        if held:
            data.write(stream())
            streams += 1
        data.write(bz2.compress(FOOTER.encode()))
    for kind, name in zip(("data", "index"), names(range_key, dump), strict=True):
        if with_index or kind == "data":
            system.move(f"{attempt}.{kind}", f"{place}/{name}")
    return streams, count


def write_dump(
    pages: DataFrame, folder: str, per_stream: int = 100, per_file: int = 1000, dump: str = DUMP, with_index: bool = True,
    damaged: int | None = None,
) -> str:
    """A multistream dump: each file has the next ``per_file`` page ids, in order.

    Pages with a true ``broken`` column get a title that does not end.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import chain, groupby

        rows = chain.from_iterable(batch.to_pylist() for batch in batches)
        for i, group in groupby(rows, key=lambda row: row["file"]):
            streams, count = write_multistream(
                folder,
                f"p{i * per_file}p{(i + 1) * per_file - 1}",
                ((r["page_id"], r["page_name"], r["text"], r.get("broken", False)) for r in group),
                per_stream, dump, with_index, damaged,
            )
            yield pa.RecordBatch.from_pydict({"streams": [streams], "pages": [count]})

    numbered = pages.withColumn("file", F.floor(F.col("page_id") / per_file))
    spread = numbered.repartition("file").sortWithinPartitions("file", "page_id")
    spread.mapInArrow(write, "streams bigint, pages bigint").agg(F.sum("pages")).collect()
    return folder
