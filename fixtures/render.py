"""Wikitext pages rendered from the given tables, one page per row.

Rendering is a projection: no grouping, so no page depends on how many rows
share a key.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Rows of a given table that go to one task: each becomes a page, of which a task makes many cells.
ROWS_A_TASK = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, spread over all cores and so that no task gets many rows, if its files give too few splits.

    Columns in Parquet are far smaller than pages and cells, so splits by bytes would hold more and more of them
    as a table grows.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows.count() // ROWS_A_TASK))
    return rows if rows.rdd.getNumPartitions() >= tasks else rows.repartition(tasks)


def text(*parts) -> Column:
    """Concatenate; Python strings are literals, other values are columns."""
    return F.concat(
        *(F.lit(part) if isinstance(part, str) else part.cast("string") for part in parts)
    )


def col(name: str) -> Column:
    return F.col(name)


def pages(source: DataFrame, key: str, title: Column, body: Column) -> DataFrame:
    return source.select(
        col(key).cast("bigint").alias("page_id"), title.alias("page_name"), body.alias("text")
    )


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rows of two cells: the cell text keeps the spaces before a double pipe."""
    body = text(
        'Intro\n{| class="order"\n|-\n| status || ', col("o_orderstatus"),
        "\n|-\n| priority || ", col("o_orderpriority"),
        "\n|-\n|customer||", col("o_custkey"), "\n|}\nafter",
    )
    return pages(table(spark, sf_dir, "orders"), "o_orderkey", text("Order ", col("o_orderkey")), body)


def part_header_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header line with both separators, a mixed header line and a data line."""
    body = text(
        "\n{|\n! key !! ", col("p_type"), "!!brand || plain !! more\n|-\n! ", col("p_partkey"),
        "\n| ", col("p_name"), " !! ", col("p_brand"), "\n|}",
    )
    return pages(table(spark, sf_dir, "part"), "p_partkey", text("Part ", col("p_partkey")), body)


def part_attribute_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row attributes, cell attributes, and attributes after the first one."""
    body = text(
        "\n{|\n|- class=", col("p_brand"), "\n| plain\n| w=", col("p_size"), " | ", col("p_name"),
        " || v=1 | ", col("p_type"), "\n|-\n| w=", col("p_size"), "|x||y|z\n! h=1 | [[", col("p_name"),
        "]] !! t=2 | ", col("p_type"), "\n|}",
    )
    return pages(table(spark, sf_dir, "part"), "p_partkey", text("Part ", col("p_partkey")), body)


def part_span_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans in several notations."""
    body = text(
        '\n{|\n| rowspan="', col("p_size"), '" | ', col("p_name"),
        "\n| colspan = ", col("p_size"), " rowspan=2 | ", col("p_brand"),
        '\n| rowspan="" colspan=', col("p_size"), " | crossing\n| norowspan=9 Rowspan=8 | none\n|}",
    )
    return pages(table(spark, sf_dir, "part"), "p_partkey", text("Part ", col("p_partkey")), body)


def customer_caption_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replaced caption, a caption with attributes, and one in the last place."""
    body = text(
        "\n{| class=c", col("c_nationkey"), "\n|+ first\n|- r=1\n|+ k=", col("c_nationkey"),
        " | Segment ", col("c_mktsegment"), " || of ", col("c_name"), "\n|-\n| a\n|}\n{|\n| b\n|+ last ",
        col("c_custkey"), "\n|}",
    )
    return pages(table(spark, sf_dir, "customer"), "c_custkey", col("c_name"), body)


def customer_link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, templates and arguments, nested, unbalanced and over line breaks."""
    name, segment, key = col("c_name"), col("c_mktsegment"), col("c_custkey")
    body = text(
        "\n{|\n|- r=", key, "\n| [[", name, "|", segment, "]] || {{t|", segment, "||", name, "}}\n| {{a|[[",
        name, "|x]]|{{b|\n|c}}}} || d\n| {{{1|", segment, "}}} | after argument\n| [http://e ", name,
        "] | lone\n| [[ {{ ]]|", segment, "\n| {{{{{1|p}}}|", name, "}}\n|}",
    )
    return pages(table(spark, sf_dir, "customer"), "c_custkey", name, body)


def customer_unbalanced_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table each for an unclosed template in a link, stray closers in a template, closers that are left
    over, a run of brackets over a line break, and closers of nothing."""
    name, segment, key = col("c_name"), col("c_mktsegment"), col("c_custkey")
    body = text(
        "\n{|\n| [[ {{ ", key, " ]] | ", segment, "\n|}\n{|\n| {{t ]] | ", segment, " }} | x\n|}\n{|\n| {{ [[ ", name,
        " | b ]]]] | c }} | d\n|}\n{|\n| [[", name, "|b]\n] | c\n|}\n{|\n| ]] }} [[", key, "|a]] || }}} {{{1|", segment, "}}} | z\n|}",
    )
    return pages(table(spark, sf_dir, "customer"), "c_custkey", name, body)


def order_multi_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables, one on a single line, stray closers and an unclosed tail."""
    key = col("o_orderkey")
    body = text(
        "\n|} stray {|\n| ", key, "\n|}\ntext |} {| one line ", col("o_orderstatus"),
        " |}\n{|\n| lost ", key, "\n",
    )
    return pages(table(spark, sf_dir, "orders"), "o_orderkey", text("Order ", key), body)


def order_nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in a cell of a table."""
    key = col("o_orderkey")
    body = text(
        "\n{|\n| a\n{| inner\n|-\n| ", col("o_orderstatus"), "\n|}\n| ", key, "\n|}\n{|\n| next ", key, "\n|}",
    )
    return pages(table(spark, sf_dir, "orders"), "o_orderkey", text("Order ", key), body)


def customer_edge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that end in a row mark, have no body, or hold text between entries."""
    key, segment = col("c_custkey"), col("c_mktsegment")
    body = text(
        "\n{|\n| a\n|- s=", key, "\n|}\n{|\n|}\n{|\n|-\nlead ", segment, "\n|- t=", key,
        "\nmore\n! k=1 | [[", segment, "]]\n|}\n{|\n|| ", key, "\n|\n|\n", segment, "\n|}",
    )
    return pages(table(spark, sf_dir, "customer"), "c_custkey", col("c_name"), body)


def customer_break_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line breaks after a pipe, with a span or plain text behind it."""
    key, segment = col("c_custkey"), col("c_mktsegment")
    body = text(
        "\n{|\n| k=", key, " |\n[[", segment, "]]\n| k=", key, " |\n", segment, "\n| a |\n{{{", key,
        "}}} |\n{{", segment, "}}\n|}",
    )
    return pages(table(spark, sf_dir, "customer"), "c_custkey", col("c_name"), body)


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as the continued text of one cell."""
    body = text("\n{|\n| ", col("role"), "\n", col("text"), "\n|}")
    source = table(spark, sf_dir, "conversations")
    title = text("Talk ", col("conv_id"), ".", col("turn"))
    return pages(source, "conv_id", title, body)


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, one table row per line. A pipe in a line ends an attribute."""
    lines = F.regexp_replace("text", "\n", "\n|-\n| ")
    source = table(spark, sf_dir, "documents")
    return pages(source, "doc_id", text("Doc ", col("doc_id")), text("\n{|\n| ", lines, "\n|}"))


def head_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as a template before the first entry, all on lines of their own."""
    body = text("\n{|\n{{lead\n", col("text"), "\n}}\n| ", col("doc_id"), "\n|}")
    return pages(table(spark, sf_dir, "documents"), "doc_id", text("Doc ", col("doc_id")), body)


def hidden_row_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as a template before the first entry, every line a row mark; only cells hide such marks."""
    rows = F.regexp_replace("text", "\n", "\n|-")
    body = text("\n{|\n{{rows\n|-", rows, "\n}}\n| [[", col("doc_id"), "]]\n|}")
    return pages(table(spark, sf_dir, "documents"), "doc_id", text("Doc ", col("doc_id")), body)


def order_mixed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the pages has a table, a third only an unclosed one, a third none."""
    key = col("o_orderkey")
    body = (
        F.when(key % 3 == 0, text("\n{|\n| ", key, "\n|}"))
        .when(key % 3 == 1, text("\n{|\n| unclosed ", key))
        .otherwise(text("\n| no table ", key, " |}"))
    )
    return pages(table(spark, sf_dir, "orders"), "o_orderkey", text("Order ", key), body)


def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole HTML pages as a template argument in one cell."""
    body = text("\n{|\n| {{html|", col("html"), "}}\n| ", col("url"), "\n|}")
    return pages(table(spark, sf_dir, "pages"), "page_id", text("Html ", col("page_id")), body)


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal text and comments with markup in them."""
    props = col("props")
    body = text(
        "\n{|\n| <nowiki>", props, " || [[</nowiki>\n| k | <!-- a\n| b || ", col("event_type"), " --> c || <pre>d|",
        col("user_id"), "</pre>\n|}\ninline {| is no table |}",
    )
    return pages(table(spark, sf_dir, "events"), "event_id", text("Event ", col("event_id")), body)


def item_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that are cut out already, with other line breaks."""
    raw = text(
        "{| item\r\n! order || line\r|-\n| ", col("l_orderkey"), " || ", col("l_linenumber"),
        "\r\n\r\n| rowspan=", col("l_linenumber"), " | ", col("l_returnflag"), "\n|}\r\n",
    )
    name = text("Item ", col("l_orderkey"), ".", col("l_linenumber"), ".", col("l_partkey"), ".", col("l_suppkey"))
    return table(spark, sf_dir, "lineitem").select(
        col("l_orderkey").alias("page_id"), name.alias("page_name"), F.lit(3).alias("table_idx"), raw.alias("raw")
    )
