"""Wiki dumps to queryable tables of wikitables and their cells, on Spark."""

from wikicells.operators.compare import diff_rows, same_rows
from wikicells.operators.extract import extract_tables
from wikicells.operators.parse import ParsedTables, parse_data, parse_info, parse_records, parse_tables
from wikicells.options import INTENDED, OBSERVED
from wikicells.plans.load import dump_records, load_dump, parse_dump
from wikicells.plans.records import check_records, read_records, record_diff, record_differences
from wikicells.plans.tables import create_tables, read_loaded, read_rejected, read_tables, register_views, write_records
from wikicells.sources.files import common_name, dump_files, pair_files
from wikicells.sources.index import read_index, stream_offsets, stream_ranges, streams_with_pages
from wikicells.sources.lookup import find_streams, streams_with_ids, write_stream_index
from wikicells.sources.pages import read_pages, rejected_pages
from wikicells.sources.streams import read_streams
from wikicells.streaming.incremental import load_new_files, stream_records

__all__ = [
    "INTENDED", "OBSERVED", "ParsedTables", "check_records", "common_name", "create_tables",
    "diff_rows", "dump_files", "dump_records", "extract_tables", "find_streams", "load_dump", "load_new_files",
    "pair_files", "parse_data", "parse_dump", "parse_info", "parse_records", "parse_tables",
    "read_index", "read_loaded", "read_pages", "read_records", "read_rejected", "record_diff", "record_differences", "read_streams", "read_tables", "register_views",
    "rejected_pages", "same_rows", "stream_offsets", "stream_ranges", "stream_records", "streams_with_ids", "streams_with_pages",
    "write_records", "write_stream_index",
]
