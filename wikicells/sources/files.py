"""The files of a dump folder."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The name convention of multistream dumps,
# ``<dump>-…<kind>-<range>.bz2`` with kind ending in ``.xml`` or ``.txt``.
_RANGE_KEY = r"-([^-/]+)$"
_KIND = r"\.([^.\-/]+)-[^-/]+$"
_DUMP_ID = r"([^/]+?-\d{8}-pages-articles-multistream)"


def plain_path(encoded: Column) -> Column:
    """A file path as ``_metadata.file_path`` has it, percent-encoded, in plain form.

    All paths of this package's tables are plain ones, so they can be joined.
    """
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def dump_id_of(path: Column) -> Column:
    """The dump a file belongs to, by its name; ``unknown`` for other names."""
    found = F.regexp_extract(path, _DUMP_ID, 1)
    return F.when(found == "", F.lit("unknown")).otherwise(found)


def without_glob(path: str) -> str:
    """A plain path for Spark's readers, which would take some characters as patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def dump_files(spark: SparkSession, folder: str, pattern: str = "*.bz2") -> DataFrame:
    """The files of a folder, as ``describe_files`` gives them.

    Folders below are listed as well. Only the listing is read, not the content.
    """
    return describe_files(
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(plain_path(F.col("_metadata.file_path")).alias("path"), "length")
    )


def describe_files(listed: DataFrame) -> DataFrame:
    """``(path, name, kind, range_key, dump_id, length)`` for ``(path, length)``."""
    path = F.col("path")
    return listed.select(
        "path",
        F.substring_index(path, "/", -1).alias("name"),
        F.regexp_extract(path, _KIND, 1).alias("kind"),
        F.regexp_extract(path, _RANGE_KEY, 1).alias("range_key"),
        F.regexp_extract(path, _DUMP_ID, 1).alias("dump_id"),
        "length",
    )


def pair_files(files: DataFrame) -> DataFrame:
    """Data files with the index files of the same dump and page range."""
    data = files.where("kind = 'xml'").select(
        "dump_id", "range_key", F.col("path").alias("data_path"), F.col("length").alias("data_length")
    )
    index = files.where("kind = 'txt'").select(
        "dump_id", "range_key", F.col("path").alias("index_path")
    )
    return data.join(index, ["dump_id", "range_key"])


def common_name(files: DataFrame) -> DataFrame:
    """One row with the longest common prefix of all file names (``database``).

    The first and the last name in order share it, so it takes two aggregates.
    """
    ends = files.agg(F.min("name").alias("first"), F.max("name").alias("last"))
    lengths = F.sequence(F.lit(0), F.least(F.length("first"), F.length("last")))
    shared = F.filter(lengths, lambda n: F.left("first", n) == F.left("last", n))
    return ends.select(F.left("first", F.array_max(shared)).alias("database"))
