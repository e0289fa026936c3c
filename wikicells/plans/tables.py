"""The result tables on disk and in SQL."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INFORMATION, DATA, REJECTED, LOADED = "wikitable_information", "wikitable_data", "rejected_pages", "loaded_files"

INFORMATION_SCHEMA = (
    "page_name STRING, table_name STRING, table_attributes STRING, "
    "caption STRING, caption_attributes STRING"
)
DATA_SCHEMA = (
    "table_name STRING, row INT, col INT, cell_data STRING, cell_attributes STRING, "
    "is_header INT, row_span BIGINT, col_span BIGINT"
)
# One folder for the rows of a dump, of a load (a batch load, or a batch of an
# incremental one), of a table.
_DUMP, _LOAD, _KIND = "dump_id", "load", "result"
_STORED = f"{_DUMP} STRING, {_LOAD} STRING, {_KIND} STRING, {INFORMATION_SCHEMA}, {DATA_SCHEMA.split(',', 1)[1]}, page STRING, file STRING, length BIGINT"


def as_stored(records: DataFrame, load: str) -> DataFrame:
    """Records of ``parse_records`` with the columns of all result tables.

    The columns of the other tables are null, which takes no space in Parquet.
    """
    dump_id = F.col(_DUMP) if _DUMP in records.columns else F.lit("unknown")
    corrupt = F.col("corrupt") if "corrupt" in records.columns else F.lit(None).cast("string")
    is_info = F.col("row") < 0
    is_data = F.col("row") >= 0
    info_only = lambda col: F.when(is_info, F.col(col))
    data_only = lambda col: F.when(is_data, F.col(col))
    return records.select(
        dump_id.alias(_DUMP),
        F.lit(load).alias(_LOAD),
        F.when(corrupt.isNotNull(), F.lit(REJECTED)).when(is_info, F.lit(INFORMATION)).otherwise(F.lit(DATA)).alias(_KIND),
        F.when(corrupt.isNull(), F.col("table_name")).alias("table_name"),
        info_only("page_name").alias("page_name"),
        info_only("table_attributes").alias("table_attributes"),
        info_only("cell_data").alias("caption"),
        info_only("cell_attributes").alias("caption_attributes"),
        *(
            data_only(col).alias(col)
            for col in ("row", "col", "cell_data", "cell_attributes", "is_header", "row_span", "col_span")
        ),
        corrupt.alias("page"),
    )


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    """Session settings for as long as the block lasts."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def check_layout(spark: SparkSession, path: str) -> None:
    """Fails if a file sink wrote to ``path``: readers would see nothing but the files in its log."""
    try:
        spark.read.text(f"{path.rstrip('/')}/_spark_metadata")
    except AnalysisException:
        return
    raise ValueError(f"{path} holds the log of a file sink, next to which other loads would not be seen")


def write_records(
    records: DataFrame, path: str, mode: str = "errorifexists", load: str | None = None, target_bytes: int | None = None,
    files: DataFrame | None = None,
) -> None:
    """Write all result tables in one job.

    The dump is read and parsed once, and one commit makes the tables visible.
    A load gets a folder of its own, so loads of any kind add up in one
    database; with ``load``, rows that a load of this name has written before
    are replaced, which makes it safe to repeat.

    Without ``target_bytes`` a task writes its rows where they are, a file per
    table: many files when splits are small. With it, rows are shuffled into
    files of about that size (of rows before compression).

    ``files(dump_id, file, length)`` are noted as loaded by the same commit, see
    ``read_loaded``.
    """
    spark = records.sparkSession
    check_layout(spark, path)
    replaces, load = load is not None, load or f"batch-{uuid.uuid4().hex}"
    stored = as_stored(records, load)
    if files is not None:
        noted = files.select(_DUMP, "file", "length").withColumn(_LOAD, F.lit(load)).withColumn(_KIND, F.lit(LOADED))
        stored = stored.unionByName(noted, allowMissingColumns=True)
    # A task keeps a file per table open, so it need not sort its rows.
    values: dict[str, object] = {"spark.sql.maxConcurrentOutputFileWriters": 8}
    if target_bytes:
        stored = stored.hint("rebalance", _DUMP, _KIND)
        values["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = target_bytes
    with settings(spark, values):
        writer = stored.write.mode("overwrite" if replaces else mode).partitionBy(_DUMP, _LOAD, _KIND)
        if replaces:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(path)


def create_tables(spark: SparkSession, path: str) -> None:
    """Create the result tables, empty; fails if there is something at ``path``."""
    spark.createDataFrame([], _STORED).write.mode("errorifexists").partitionBy(_DUMP, _LOAD, _KIND).parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    check_layout(spark, path)
    return spark.read.schema(_STORED).parquet(path)


def read_tables(spark: SparkSession, path: str, with_dump_id: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(information, data)`` as written by all loads, batch and incremental.

    Table names are unique within a dump; ``with_dump_id`` adds ``dump_id``, by
    which dumps are told apart, and a filter on it reads only their files.
    Joins with the information are merges, unless they ask for another kind.
    """
    rows = _stored(spark, path)

    def columns(schema: str) -> list[str]:
        return [_DUMP] * with_dump_id + [field.split()[0] for field in schema.split(", ")]

    # Files are far smaller than their rows, by which Spark would send the information of very many tables
    # through the driver to join it; a merge takes any number.
    information = rows.where(F.col(_KIND) == INFORMATION).select(columns(INFORMATION_SCHEMA)).hint("merge")
    data = rows.where(F.col(_KIND) == DATA).select(columns(DATA_SCHEMA))
    return information, data


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """``(dump_id, page)``: the XML of pages with tables that loads could not read."""
    return _stored(spark, path).where(F.col(_KIND) == REJECTED).select(_DUMP, "page")


def read_loaded(spark: SparkSession, path: str) -> DataFrame:
    """``(dump_id, file, length)``: the files that loads of the kind ``once`` have brought in; none if there is no database."""
    try:
        stored = _stored(spark, path)
    except AnalysisException:
        stored = spark.createDataFrame([], _STORED)
    return stored.where(F.col(_KIND) == LOADED).select(_DUMP, "file", "length").distinct()


def register_views(spark: SparkSession, path: str) -> None:
    """Make the result tables queryable by name in Spark SQL, with ``dump_id``."""
    information, data = read_tables(spark, path, with_dump_id=True)
    information.createOrReplaceTempView(INFORMATION)
    data.createOrReplaceTempView(DATA)
    read_rejected(spark, path).createOrReplaceTempView(REJECTED)
