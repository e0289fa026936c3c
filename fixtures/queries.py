"""The registered queries: render pages from the given tables, run the operators."""

from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import wikicells as wc
from fixtures import render as r
from fixtures.dump import shared_folder, write_dump, write_xml
from wikicells.plans.tables import write_records
from wikicells.streaming.incremental import write_batch
from wikicells.sources.files import common_name, describe_files, pair_files
from wikicells.sources.index import read_index, stream_offsets, stream_ranges, streams_with_pages


def _data(render, spark: SparkSession, sf_dir: str, dialect: str = wc.OBSERVED) -> DataFrame:
    return wc.parse_data(wc.extract_tables(render(spark, sf_dir), dialect), dialect)


def _info(render, spark: SparkSession, sf_dir: str) -> DataFrame:
    return wc.parse_info(wc.extract_tables(render(spark, sf_dir)))


def _raw(render, spark: SparkSession, sf_dir: str) -> DataFrame:
    return wc.extract_tables(render(spark, sf_dir))


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page with a table per customer, with characters that XML escapes."""
    body = r.text(
        "\nA & <b>\n{|\n| ", r.col("c_mktsegment"), " & <i> || é ", r.col("c_nationkey"), "\n|}"
    )
    return r.pages(r.table(spark, sf_dir, "customer"), "c_custkey", r.col("c_name"), body)


def dump_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_xml(customer_pages(spark, sf_dir), shared_folder(spark))
    return wc.read_pages(spark, folder).select("page_id", "page_name", "text")


# A folder name with characters that paths of Spark encode.
_ODD = "/my dump 100% é+1"


def dump_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with the dumps of two wikis, a data file without index and a file of another kind."""
    pages, folder = customer_pages(spark, sf_dir), shared_folder(spark) + _ODD
    for odd, wiki in enumerate(("enwiki", "dewiki")):
        write_dump(pages.where(r.col("page_id") % 2 == odd), folder, dump=f"{wiki}-20201220-pages-articles-multistream")
    write_dump(pages, folder, per_file=10**9, dump="frwiki-20201220-pages-articles-multistream", with_index=False)
    write_dump(pages, folder, per_file=10**9, dump="notes", with_index=False)
    out = shared_folder(spark)
    wc.load_dump(spark, folder, out)
    return wc.read_tables(spark, out, with_dump_id=True)[1]


def dump_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the tables, append a dump twice; copies stay."""
    folder = write_xml(customer_pages(spark, sf_dir), shared_folder(spark))
    out = shared_folder(spark)
    wc.create_tables(spark, out)
    for _ in range(2):
        wc.load_dump(spark, folder, out, mode="append", paired=False)
    information, _ = wc.read_tables(spark, out)
    return information.groupBy("table_name").agg(F.count(F.lit(1)).alias("copies"))


def load_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder that grows between loads, each of which takes the files that are not loaded yet."""
    pages, folder, out = customer_pages(spark, sf_dir), shared_folder(spark) + _ODD, shared_folder(spark)
    for third in range(3):
        write_dump(pages.where(F.floor(r.col("page_id") / 50) % 3 == third), folder, per_file=50)
        for _ in range(2):
            wc.load_dump(spark, folder, out, once=True)
    cells = wc.read_tables(spark, out)[1].select("table_name", "col", "cell_data")
    noted = wc.read_loaded(spark, out).select("file", F.lit(-1).alias("col"), F.lit("loaded").alias("cell_data"))
    return cells.union(noted)


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of files, each loaded once."""
    pages = customer_pages(spark, sf_dir)
    folder, out, log = (shared_folder(spark) for _ in range(3))
    for arrived in ("page_id % 2 = 0", "page_id % 2 = 1"):
        write_xml(pages.where(arrived), folder, mode="append")
        wc.load_new_files(spark, folder, out, log).awaitTermination()
    return wc.read_tables(spark, out)[1]


def mixed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One database from a batch load, an incremental one whose batch is written twice, and an appended one."""
    pages = customer_pages(spark, sf_dir)
    out, log = shared_folder(spark), shared_folder(spark)
    first, second, third = (write_xml(pages.where(r.col("page_id") % 3 == k), shared_folder(spark)) for k in range(3))
    wc.load_dump(spark, first, out, paired=False)
    wc.load_new_files(spark, second, out, log).awaitTermination()
    wc.load_dump(spark, third, out, mode="append", paired=False)
    write_batch(wc.dump_records(spark, second), 0, out, log)
    return wc.read_tables(spark, out)[1]


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth page is not well-formed, every seventh has no title; the others are complete."""
    pages = customer_pages(spark, sf_dir)
    pages = pages.withColumn("broken", r.col("page_id") % 5 == 0).withColumn(
        "page_name", F.when((r.col("page_id") % 7 != 0) | r.col("broken"), r.col("page_name"))
    )
    folder, out = write_dump(pages, shared_folder(spark)), shared_folder(spark)
    wc.load_dump(spark, folder, out)
    rejected = wc.read_rejected(spark, out).select(
        F.lit("rejected").alias("kind"), F.regexp_extract("page", "<id>([0-9]+)</id>", 1).alias("name")
    )
    return rejected.union(wc.read_tables(spark, out)[1].select(F.lit("cell"), "table_name"))


def damaged_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream in the midst of a file does not unpack; all others are loaded."""
    folder, out = write_dump(customer_pages(spark, sf_dir), shared_folder(spark) + _ODD, per_stream=20, damaged=30), shared_folder(spark)
    wc.load_dump(spark, folder, out, by_stream=True)
    place = F.regexp_extract("page", r"^damaged stream in .*/([^/]+\.bz2), bytes \d+ to \d+: ", 1)
    rejected = wc.read_rejected(spark, out).select(F.lit("damaged").alias("kind"), place.alias("name"))
    return rejected.union(wc.read_tables(spark, out)[1].select(F.lit("cell"), "table_name"))


def table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without tables, or with an unclosed one, leave nothing."""
    folder = write_xml(r.order_mixed_pages(spark, sf_dir), shared_folder(spark))
    return wc.extract_tables(wc.read_pages(spark, folder, with_tables_only=True)).select("page_id", "page_name", "table_idx", "raw")


def check_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per line item, every seventh with a wrong caption, every eleventh without its last cell."""
    key = r.col("l_orderkey")
    tables = r.item_tables(spark, sf_dir)
    number = F.element_at(F.split("page_name", r"\."), 2)
    name = r.text(r.col("page_name"), "_3")
    info = F.array(r.col("page_name"), name, F.lit(" item"), F.when(r.col("page_id") % 7 == 0, F.lit("?")).otherwise(F.lit("")), F.lit(""))

    def row(at: int, to: int, data, attributes=F.lit(""), header: int = 0, rows=F.lit("1")):
        return F.array(name, F.lit(str(at)), F.lit(str(to)), data, attributes, F.lit(str(header)), rows, F.lit("1"))

    flag = F.regexp_extract("raw", r"\| ([A-Z])\n\|\}", 1)
    cells = F.array(
        row(0, 0, F.lit(" order "), header=1), row(0, 1, F.lit(" line")), row(1, 0, r.text(r.col("page_id"), " ")),
        row(1, 1, r.text(" ", number)), row(1, 2, r.text(" ", flag), r.text("rowspan=", number, " "), 0, number),
    )
    cells = F.when(r.col("page_id") % 11 == 0, F.slice(cells, 1, 4)).otherwise(cells)
    raw = F.to_json(F.struct(
        r.col("page_name").alias("PageName"), r.col("page_id").cast("string").alias("PageId"), F.lit(3).alias("TableId"), r.col("raw").alias("WikitableData"),
    ))
    path = shared_folder(spark)
    tables.select(r.text('{"raw": ', raw, ', "parsed": [', F.to_json(info), ", ", F.to_json(cells), "]}").alias("value")).write.text(path)
    information, data = wc.record_differences(spark, path, lines=True)
    both = [
        diff.select(F.lit(kind).alias("kind"), "table_name", value.alias("value"), "actual_copies", "expected_copies")
        for kind, diff, value in (("information", information, F.col("caption")), ("data", data, F.col("cell_data")))
    ]
    return both[0].union(both[1])


def selected_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of the streams that hold a customer with a high balance."""
    folder = write_dump(customer_pages(spark, sf_dir), shared_folder(spark) + _ODD, per_stream=20)
    pairs = wc.pair_files(wc.dump_files(spark, folder))
    index = read_index(spark, f"{folder}/*index*")
    ranges = stream_ranges(stream_offsets(index), pairs)
    wanted = r.table(spark, sf_dir, "customer").where("c_acctbal > 9900").select(
        F.col("c_custkey").alias("page_id")
    )
    chosen = streams_with_pages(ranges, index, wanted)
    return wc.read_streams(chosen).select("page_id", "page_name", "text")


def indexed_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a stored index of two dumps: all pages of the streams that hold a customer deep in debt."""
    folder, stored, pages = shared_folder(spark), shared_folder(spark), customer_pages(spark, sf_dir)
    for wiki, at in (("enwiki", r.col("page_id")), ("dewiki", r.col("page_id") * 7)):
        dump = f"{wiki}-20201220-pages-articles-multistream"
        write_dump(pages.withColumn("page_id", at), folder, per_stream=20, per_file=7000, dump=dump)
    streams = wc.streams_with_ids(read_index(spark, f"{folder}/*index*"), wc.pair_files(wc.dump_files(spark, folder)))
    wc.write_stream_index(streams, stored, group_rows=8)
    key = r.col("c_custkey")
    wanted = r.table(spark, sf_dir, "customer").where("c_acctbal < -950").select(
        F.explode(F.array(
            F.struct(F.lit("enwiki-20201220-pages-articles-multistream").alias("dump_id"), key.alias("page_id")),
            F.struct(F.lit("dewiki-20201220-pages-articles-multistream").alias("dump_id"), (key * 7).alias("page_id")),
            F.struct(F.lit("dewiki-20201220-pages-articles-multistream").alias("dump_id"), (key * 7 + 1).alias("page_id")),
        )).alias("w")
    ).select("w.*")
    found = wc.read_streams(wc.find_streams(spark, stored, wanted))
    return found.select("dump_id", "page_id", "page_name", "text")


def multistream_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A multistream dump, read in full without its index."""
    folder = write_dump(customer_pages(spark, sf_dir), shared_folder(spark))
    return wc.parse_dump(spark, folder).data


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A made-up name pair per customer, some without an index; names hold the number of the customer."""
    key = r.col("c_custkey")
    base = r.text("hdfs:/dumps/enwiki-", 20_000_000 + key, "-pages-articles-multistream")
    ends = r.text(key, "-p", key * 100, "p", key * 100 + 99, ".bz2")
    kinds = F.when(key % 7 == 0, F.array(F.lit(".xml"))).otherwise(F.array(F.lit(".xml"), F.lit("-index.txt")))
    listed = r.table(spark, sf_dir, "customer").select(
        F.explode(F.transform(kinds, lambda kind: F.concat(base, kind, ends))).alias("path"),
        (key * 1000).alias("length"),
    )
    return describe_files(listed.withColumn("path", F.regexp_replace("path", r"(xml|txt)\d+-", "$1-")))


def file_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_files(_listing(spark, sf_dir))


def database_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common_name(_listing(spark, sf_dir))


def dump_index_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streams of a dump's real files in an odd folder: their pages, and how far they are from one another."""
    folder = write_dump(customer_pages(spark, sf_dir), shared_folder(spark) + _ODD, per_stream=40, per_file=500)
    pairs = pair_files(wc.dump_files(spark, folder))
    ranges = stream_ranges(stream_offsets(read_index(spark, f"{folder}/*index*")), pairs)
    following = Window.partitionBy("data_path").orderBy("start")
    return ranges.join(pairs.select("data_path", "data_length"), "data_path").select(
        "dump_id", F.substring_index("data_path", ".xml-", -1).alias("file"),
        F.row_number().over(following).cast("bigint").alias("stream"), "pages", "first_page_id", "last_page_id",
        (F.coalesce(F.lead("start").over(following), r.col("data_length")) - r.col("end")).alias("gap"),
    )


def compare_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed cells against the orders with every fifth status changed, every seventh customer missing, every eleventh cell doubled."""
    key, name = r.col("o_orderkey"), r.text("Order ", r.col("o_orderkey"), "_0")

    def cell(row: int, col: int, data):
        number = lambda n, kind: F.lit(n).cast(kind)
        return F.struct(
            number(row, "int").alias("row"), number(col, "int").alias("col"), data.alias("cell_data"), F.lit("").alias("cell_attributes"),
            number(0, "int").alias("is_header"), number(1, "bigint").alias("row_span"), number(1, "bigint").alias("col_span"),
        )

    status = r.text(" ", F.when(key % 5 == 0, F.lit("?")).otherwise(r.col("o_orderstatus")))
    doubled = F.when(key % 11 == 0, F.lit(2)).otherwise(1)
    cells = F.array(
        cell(0, 0, F.lit("status ")), cell(0, 1, status), cell(1, 0, F.lit("priority ")), cell(1, 1, r.text(" ", r.col("o_orderpriority"))),
        cell(2, 0, F.lit("customer")), cell(2, 1, r.col("o_custkey").cast("string")),
    )
    cells = F.when(key % 7 == 0, F.slice(cells, 1, 5)).otherwise(cells)
    expected = r.table(spark, sf_dir, "orders").select(name.alias("table_name"), F.explode(F.flatten(F.array_repeat(cells, doubled))).alias("c"))
    return wc.diff_rows(_data(r.order_pages, spark, sf_dir), expected.select("table_name", "c.*"))


def info_data_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stored tables in SQL: cells and headers per table of a page."""
    out = shared_folder(spark)
    raw = wc.extract_tables(r.part_header_pages(spark, sf_dir))
    write_records(wc.parse_records(raw), out)
    wc.register_views(spark, out)
    return spark.sql("""
        SELECT i.page_name, i.table_name, count(*) AS cells, sum(d.is_header) AS headers
        FROM wikitable_information i JOIN wikitable_data d ON i.dump_id = d.dump_id AND i.table_name = d.table_name
        GROUP BY i.page_name, i.table_name
    """)


def cut_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wc.parse_data(r.item_tables(spark, sf_dir))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _data(r.document_pages, spark, sf_dir, wc.INTENDED)


QUERIES = {
    "cells_basic": partial(_data, r.order_pages),
    "cells_headers": partial(_data, r.part_header_pages),
    "cells_attributes": partial(_data, r.part_attribute_pages),
    "spans": partial(_data, r.part_span_pages),
    "captions_info": partial(_info, r.customer_caption_pages),
    "captions_cells": partial(_data, r.customer_caption_pages),
    "protected_links": partial(_data, r.customer_link_pages),
    "unbalanced_links": partial(_data, r.customer_unbalanced_pages),
    "raw_tables": partial(_raw, r.order_multi_pages),
    "multi_table_pages": partial(_data, r.order_multi_pages),
    "nested_tables": partial(_data, r.order_nested_pages),
    "continuation_lines": partial(_data, r.conversation_pages),
    "phantom_rows": partial(_data, r.customer_edge_pages),
    "lost_breaks": partial(_data, r.customer_break_pages),
    "cut_tables": cut_tables,
    "document_lines": document_lines,
    "xml_escaped_cells": partial(_data, r.document_pages),
    "html_cells": partial(_data, r.html_pages),
    "literal_text": partial(_data, r.event_pages, dialect=wc.INTENDED),
    "dump_pages": dump_pages,
    "dump_cells": dump_cells,
    "dump_appended": dump_appended,
    "load_once": load_once,
    "multistream_cells": multistream_cells,
    "dump_index_streams": dump_index_streams,
    "file_pairs": file_pairs,
    "database_name": database_name,
    "selected_streams": selected_streams,
    "indexed_streams": indexed_streams,
    "incremental_load": incremental_load,
    "compare_tables": compare_tables,
    "info_data_join": info_data_join,
    "mixed_load": mixed_load,
    "rejected_rows": rejected_rows,
    "table_pages": table_pages,
    "damaged_streams": damaged_streams,
    "check_records": check_records,
    "lines_before_entry": partial(_data, r.head_pages),
    "hidden_rows": partial(_data, r.hidden_row_pages),
}
