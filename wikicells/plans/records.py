"""Recorded tables with their expected rows, and the check against them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wikicells.operators.parse import parse_records
from wikicells.options import OBSERVED
from wikicells.plans.tables import DATA_SCHEMA

# Fixed value: the record format, ``{raw: {…}, parsed: [info_row, [data_row, …]]}``
# with rows as JSON arrays.
RECORD_SCHEMA = (
    "raw STRUCT<PageName: STRING, PageId: STRING, TableId: INT, WikitableData: STRING>, "
    "parsed ARRAY<STRING>"
)


def read_records(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Records of a JSON file that holds an array of them; with ``lines``, one to a line, in any number of files.

    An array is read in one task. It suits a file of test cases, lines suit more.
    """
    return spark.read.schema(RECORD_SCHEMA).option("multiLine", not lines).json(path)


def raw_of_records(records: DataFrame) -> DataFrame:
    """The raw tables of records, as ``parse_tables`` takes them."""
    return records.select(
        F.col("raw.PageId").cast("bigint").alias("page_id"),
        F.col("raw.PageName").alias("page_name"),
        F.col("raw.TableId").alias("table_idx"),
        F.col("raw.WikitableData").alias("raw"),
    )


_OWN = [field.split()[0] for field in DATA_SCHEMA.split(", ")]
_INFORMATION = ("page_name", "table_name", "table_attributes", "cell_data", "cell_attributes")


def _expected_rows(parsed: Column) -> Column:
    """The rows that a record expects as arrays of strings, the information first."""
    info = F.from_json(F.get(parsed, F.lit(0)), "array<string>")
    data = F.from_json(F.get(parsed, F.lit(1)), "array<array<string>>")
    return F.concat(F.array(info), F.coalesce(data, F.array().cast("array<array<string>>")))


def _counted(spark: SparkSession, path: str, dialect: str, lines: bool) -> DataFrame:
    """``record_diff`` with the number of copies that are information."""
    is_table = F.col("part") == 0
    parts = read_records(spark, path, lines).select("raw", "parsed", F.explode(F.array(F.lit(0), F.lit(1))).alias("part"))
    rows = parse_records(parts.select(
        F.when(is_table, F.col("raw.PageName")).alias("page_name"), F.when(is_table, F.col("raw.TableId")).alias("table_idx"),
        F.when(is_table, F.col("raw.WikitableData")).alias("raw"), F.when(~is_table, F.col("parsed")).alias("corrupt"),
    ), dialect)
    # A parsed row stays one row, a record's expected ones become a row each.
    is_expected = F.col("corrupt").isNotNull()
    rows = rows.withColumn("expected", F.when(is_expected, _expected_rows(F.col("corrupt"))))
    rows = rows.select("*", is_expected.alias("is_expected"), F.posexplode_outer("expected").alias("number", "values"))
    is_info = F.when(F.col("is_expected"), F.col("number") == 0).otherwise(F.col("row") < 0)

    def column(name: str, kind: str) -> Column:
        """Of either kind; columns that it lacks are null."""
        none = F.lit(None).cast(kind)
        place = {True: _INFORMATION.index(name) if name in _INFORMATION else None, False: _OWN.index(name) if name in _OWN else None}
        value = lambda info: none if place[info] is None else F.get("values", F.lit(place[info])).cast(kind)
        own = lambda info: none if place[info] is None else F.col(name)
        return (
            F.when(F.col("is_expected") & is_info, value(True)).when(F.col("is_expected"), value(False))
            .when(is_info, own(True)).otherwise(own(False)).alias(name)
        )

    columns = [field.split() for field in f"page_name STRING, table_attributes STRING, {DATA_SCHEMA}".split(", ")]
    compared = rows.select(
        "is_expected", F.when(is_info, F.lit("information")).otherwise(F.lit("data")).alias("kind"),
        *(column(name, kind) for name, kind in columns),
    )
    return compared.groupBy("kind", *(name for name, _ in columns)).agg(
        F.count_if(~F.col("is_expected")).alias("actual_copies"), F.count_if("is_expected").alias("expected_copies"),
        F.count_if(F.col("kind") == "information").alias("information_copies"),
    ).where("actual_copies != expected_copies")


def record_diff(spark: SparkSession, path: str, dialect: str = OBSERVED, lines: bool = False) -> DataFrame:
    """Rows of records of which there are not as many parsed as expected, by one scan of the file.

    A record gives its raw table, which is parsed, and its expected rows, which pass the parser by
    untouched; one aggregate counts both. ``kind`` is ``information``, with the caption as
    ``cell_data``, or ``data``; columns that a kind lacks are null.
    """
    return _counted(spark, path, dialect, lines).drop("information_copies")


def check_records(spark: SparkSession, path: str, dialect: str = OBSERVED, lines: bool = False) -> bool:
    """Whether parsing the raw tables of a record file gives its expected rows; the file is read once."""
    return record_diff(spark, path, dialect, lines).isEmpty()


def record_differences(
    spark: SparkSession, path: str, dialect: str = OBSERVED, lines: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Information and data rows that differ, as ``diff_rows`` gives them; used together, both take one scan and one shuffle."""
    diff = _counted(spark, path, dialect, lines)
    copies = ("actual_copies", "expected_copies")
    # By a count and not by ``kind``: a filter on the key would go below the shuffle, which both could not share then.
    information = diff.where("information_copies > 0").select(
        "page_name", "table_name", "table_attributes", F.col("cell_data").alias("caption"),
        F.col("cell_attributes").alias("caption_attributes"), *copies,
    )
    return information, diff.where("information_copies = 0").select(*_OWN, *copies)
