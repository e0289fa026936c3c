"""Pages of a dump."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikicells.sources.files import dump_id_of, plain_path

# The page elements of the dump format that are used.
PAGE_SCHEMA = (
    "title STRING, id BIGINT, revision STRUCT<text: STRUCT<_VALUE: STRING>>, "
    "_corrupt_record STRING"
)
PAGE_START, PAGE_END = "<page>", "</page>"
DATA_FILES = "*.xml*"

# Leading white space of a page text decides whether its first table counts.
_XML_OPTIONS = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}


def pages_of_chunks(chunks: DataFrame, with_tables_only: bool = False) -> DataFrame:
    """``value`` chunks that end before ``</page>`` to pages.

    What comes before ``<page>`` (the header of a dump) is cut off; a chunk
    without it (the footer) is dropped. A page that is not well-formed XML or
    has no title keeps its XML in ``corrupt`` and has nulls elsewhere.
    ``dump_id`` goes along if there is one. A chunk with ``damaged``, a message of
    the reader, is a row with that as ``corrupt``.

    ``with_tables_only`` drops pages without an opening table marker before
    they are decoded.
    """
    value = F.col("value")
    wanted = value.contains(PAGE_START)
    if with_tables_only:
        wanted = wanted & value.contains("{|")
    kept = chunks.where(wanted | F.col("damaged").isNotNull() if "damaged" in chunks.columns else wanted)
    page = F.concat(
        F.substring(value, F.instr(value, PAGE_START), F.length(value)), F.lit(PAGE_END)
    )
    known = [name for name in ("dump_id", "damaged") if name in chunks.columns]
    decoded = kept.select(*known, page.alias("xml")).select(
        *known, "xml", F.from_xml("xml", PAGE_SCHEMA, _XML_OPTIONS).alias("page")
    )
    titled = F.col("page._corrupt_record").isNull() & F.col("page.title").isNotNull()
    corrupt = F.when(~titled, F.col("xml"))
    return decoded.select(
        F.when(titled, F.col("page.id")).alias("page_id"),
        F.when(titled, F.col("page.title")).alias("page_name"),
        F.when(titled, F.col("page.revision.text._VALUE")).alias("text"),
        (F.coalesce("damaged", corrupt) if "damaged" in known else corrupt).alias("corrupt"),
        *(name for name in known if name != "damaged"),
    )


def with_dump_id(texts: DataFrame) -> DataFrame:
    """``(value, dump_id)`` of a text source."""
    return texts.select("value", dump_id_of(plain_path(F.col("_metadata.file_path"))).alias("dump_id"))


def read_chunks(spark: SparkSession, path: str | list[str], pattern: str = DATA_FILES) -> DataFrame:
    """The XML between page ends, one chunk per page, and the dump it is from.

    The text source splits bz2 files at block borders, so one file is read by
    many tasks. ``</page>`` cannot occur in a page text, where ``<`` is escaped.
    """
    return with_dump_id(
        spark.read.option("lineSep", PAGE_END).option("pathGlobFilter", pattern).text(path)
    )


def read_pages(spark: SparkSession, path: str | list[str], with_tables_only: bool = False) -> DataFrame:
    """``(page_id, page_name, text, corrupt, dump_id)`` of dump files or a folder."""
    return pages_of_chunks(read_chunks(spark, path), with_tables_only)


def rejected_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(value)``: the pages of a dump that are not well-formed XML or have no title.

    A load keeps those with tables aside, see ``read_rejected``, so that one
    broken page does not stop it.
    """
    pages = read_pages(spark, path)
    return pages.where(F.col("corrupt").isNotNull()).select(F.col("corrupt").alias("value"))
