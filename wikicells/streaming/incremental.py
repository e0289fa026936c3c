"""Loading dump files as they arrive."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wikicells.operators.extract import extract_tables
from wikicells.operators.parse import parse_records
from wikicells.options import OBSERVED
from wikicells.plans.tables import check_layout, write_records
from wikicells.sources.pages import DATA_FILES, PAGE_END, pages_of_chunks, with_dump_id


def stream_records(
    spark: SparkSession,
    folder: str,
    dialect: str = OBSERVED,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Result rows of a growing folder of dump files, as a stream.

    Parsing needs no state: every step works on one page.
    """
    reader = (
        spark.readStream.option("lineSep", PAGE_END).option("pathGlobFilter", DATA_FILES)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = pages_of_chunks(with_dump_id(reader.text(folder)), with_tables_only=True)
    return parse_records(extract_tables(pages, dialect), dialect)


def write_batch(records: DataFrame, batch: int, out: str, checkpoint: str) -> None:
    """Write a batch of a stream as a load of its own; a repeated batch replaces its first attempt."""
    metadata = records.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value
    write_records(records, out, load=f"stream-{json.loads(metadata)['id']}-{batch}")


def load_new_files(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    dialect: str = OBSERVED,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Load the files that are not loaded yet, then stop.

    The checkpoint remembers the files, and a batch is a load named after the
    stream and its number, so every file is loaded exactly once, also after a
    failure. Batch loads may go to the same ``out``, but not while this runs.
    """
    check_layout(spark, out)
    return (
        stream_records(spark, folder, dialect, max_files_per_trigger)
        .writeStream.foreachBatch(lambda records, batch: write_batch(records, batch, out, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
