"""From a dump to the result tables."""

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wikicells.operators.extract import extract_tables
from wikicells.operators.parse import ParsedTables, data_of, info_of, parse_records
from wikicells.options import OBSERVED
from wikicells.plans.tables import read_loaded, write_records
from wikicells.sources.files import dump_files, dump_id_of, pair_files, without_glob
from wikicells.sources.index import read_index, stream_offsets, stream_ranges
from wikicells.sources.pages import DATA_FILES, read_pages
from wikicells.sources.streams import read_streams


def paired_files(spark: SparkSession, folder: str) -> list[str]:
    """The data files of a folder that have an index file, as paths for Spark's readers.

    Like any listing, this is as long as there are files.
    """
    pairs = pair_files(dump_files(spark, without_glob(folder)))
    paths = [without_glob(row.data_path) for row in pairs.select("data_path").collect()]
    if not paths:
        raise ValueError(f"{folder} has no data file with an index file")
    return sorted(paths)


def new_files(spark: SparkSession, folder: str, out: str, paired: bool = True) -> list[Row]:
    """``(path, dump_id, file, length)`` of the data files that loads of the kind ``once`` have not brought into ``out``.

    Like any listing, this is as long as there are files.
    """
    if paired:
        files = pair_files(dump_files(spark, without_glob(folder))).select(F.col("data_path").alias("path"), F.col("data_length").alias("length"))
    else:
        files = dump_files(spark, folder, DATA_FILES).select("path", "length")
    named = files.select("path", dump_id_of(F.col("path")).alias("dump_id"), F.substring_index("path", "/", -1).alias("file"), "length")
    return sorted(named.join(read_loaded(spark, out), ["dump_id", "file", "length"], "left_anti").select(named.columns).collect())


def dump_records(spark: SparkSession, path: str | list[str], dialect: str = OBSERVED) -> DataFrame:
    """All result rows of dump files or a folder, by one narrow pass.

    Rows with ``corrupt`` are pages with tables that could not be read.
    """
    pages = read_pages(spark, path, with_tables_only=True)
    return parse_records(extract_tables(pages, dialect), dialect)


def records_by_stream(spark: SparkSession, folder: str, dialect: str = OBSERVED) -> DataFrame:
    """``dump_records`` of a folder whose data files are read stream by stream, as their index has them.

    A damaged stream is a row with ``corrupt``, and the streams behind it are
    read; files that are read as a whole stop the job there.
    """
    pairs = pair_files(dump_files(spark, without_glob(folder)))
    paths = sorted(without_glob(row.index_path) for row in pairs.select("index_path").collect())
    if not paths:
        raise ValueError(f"{folder} has no data file with an index file")
    ranges = stream_ranges(stream_offsets(read_index(spark, paths)), pairs)
    return parse_records(extract_tables(read_streams(ranges, with_tables_only=True), dialect), dialect)


def parse_dump(spark: SparkSession, path: str | list[str], dialect: str = OBSERVED) -> ParsedTables:
    """Dump files or a folder to their two result tables, lazily.

    Each of the two reads and parses the dump; to have both from one pass, use
    ``dump_records`` or ``load_dump``.
    """
    records = dump_records(spark, path, dialect).where("corrupt IS NULL")
    return ParsedTables(info_of(records.where(F.col("row") < 0)), data_of(records.where(F.col("row") >= 0)))


def load_dump(
    spark: SparkSession,
    path: str,
    out: str,
    mode: str = "errorifexists",
    dialect: str = OBSERVED,
    paired: bool = True,
    target_bytes: int | None = None,
    once: bool = False,
    by_stream: bool = False,
) -> None:
    """Load a dump into result tables at ``out``.

    Of the folder ``path``, the data files that have an index file are loaded,
    under the dump's name. With ``paired=False``, all of ``path`` is: a file, or
    every file of a folder that is named like XML.

    ``mode`` is ``errorifexists`` for a new database and ``append`` to add to an
    existing one, however it was made, which keeps what is there and does not
    look for duplicates. Pages with tables that cannot be read are kept aside,
    see ``read_rejected``. ``target_bytes``: see ``write_records``.

    With ``once``, files that such a load has brought into ``out`` before, by
    dump, name and length, are left out, and the others are noted by the commit
    that makes their rows visible. So a load that failed, or a folder that has
    grown, is loaded by the same call again, and every file once.

    With ``by_stream``, streams are read one by one through the index, so that
    a damaged one does not stop the load; see ``read_rejected`` for its place.
    """
    if by_stream:
        if once or not paired:
            raise ValueError("by_stream loads all data files that have an index file")
        write_records(records_by_stream(spark, path, dialect), out, mode, target_bytes=target_bytes)
        return
    if once:
        listed = new_files(spark, path, out, paired)
        if listed:
            noted = spark.createDataFrame([row[1:] for row in listed], "dump_id STRING, file STRING, length BIGINT")
            records = dump_records(spark, [without_glob(row.path) for row in listed], dialect)
            write_records(records, out, "append", target_bytes=target_bytes, files=noted)
        return
    files = paired_files(spark, path) if paired else path
    write_records(dump_records(spark, files, dialect), out, mode, target_bytes=target_bytes)
