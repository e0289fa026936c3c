"""Raw tables to table information and cells.

A table is cut by splitting its text, level by level: row marks, then entries
(lines that begin with ``|`` or ``!``), then cells. Each level is one string
function or one generator on the row that holds the table, so no step needs a
shuffle, a window or a key.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikicells.functions import marks as m
from wikicells.functions.spans import col_span, row_span
from wikicells.operators.masked import SPAN_START, STOP, settle_bangs, show_hidden_entries
from wikicells.operators.protect import protect, protect_literal_text
from wikicells.options import INTENDED, OBSERVED, check_dialect

# The line boundaries of the observed dialect (those that text in
# XML text form can hold are CR, LF and CR LF), and of the intended one.
_LINE_BREAK = {
    OBSERVED: r"\r\n?|[\x0B\x0C\x1C-\x1E\x85\u2028\u2029]",
    INTENDED: r"\r\n?",
}

_ENTRY_START = r"\n(?=[|!])"
_INFO_ROW = -1

_ATTRIBUTE_STOP = "|" + "".join(STOP)
_SEPARATORS = m.CELL_SEP + m.HEADER_SEP

# Lines between a row mark, or the table's first line, and the first entry behind it.
_LEADS = r"^[^\n]|(?:^|\n\|-[^\n]*+)\n(?![|!])"
# Entries of data cells as one string, each behind a header separator: a lone pipe behind the first cell with
# a lone pipe, a link or a template.
_LOCKED_PIPE = (
    rf"((?:{m.HEADER_SEP}[^{_ATTRIBUTE_STOP}{m.HEADER_SEP}]*+[{_ATTRIBUTE_STOP}][^{_SEPARATORS}]*+{m.CELL_SEP}|\G(?!^))"
    rf"[^|{m.HEADER_SEP}]*+)\|"
)


@dataclass(frozen=True)
class ParsedTables:
    """The two result tables, lazily."""

    info: DataFrame
    data: DataFrame


def _has_other_break(text: Column) -> Column:
    """Whether a text can hold a line boundary other than LF."""
    found = F.octet_length(text) != F.length(text)
    for char in "\r\x0b\x0c\x1c\x1d\x1e":
        found = found | text.contains(char)
    return found


def _drop_last_break(text: Column) -> Column:
    return F.when(text.endswith("\n"), F.left(text, F.length(text) - 1)).otherwise(text)


def _body(text: Column) -> Column:
    """All lines but the first and the last, each behind one line break, no blank ones."""
    first = F.length(F.substring_index(text, "\n", 1))
    last = F.length(F.substring_index(text, "\n", -1))
    middle = F.substring(text, first + 1, F.length(text) - first - last - 1)
    return F.when(middle == "", middle).otherwise(
        F.regexp_replace(middle, r"\n+(?=\n|\z)", "")
    )


def _is_caption(entry: Column) -> Column:
    return entry.startswith("|+")


def _row_groups(masked: Column) -> Column:
    """Split at row marks, then each group at its entries: array of arrays.

    The first element of a group is its head: the text of the row mark and the
    lines up to the first entry.
    """
    return F.transform(
        F.split(masked, r"\n\|-", -1), lambda group: F.split(group, _ENTRY_START, -1)
    )


def _is_plain(body: Column) -> Column:
    """Whether a table has neither captions nor text in front of the first entry of a row."""
    return ~body.contains("\n|+") & ~body.rlike(_LEADS)


def _plain_rows(groups: Column) -> Column:
    """``_rows`` of a plain table."""
    return F.transform(groups, lambda group, i: F.struct(
        group[0].alias("attribute"), F.lit("").alias("lead"), F.lit(0).alias("place"),
        F.slice(group, 2, F.size(group)).alias("entries"), (i == F.size(groups) - 1).alias("last"),
    ))


def _rows(groups: Column) -> Column:
    """Groups as structs ``(attribute, lead, place, entries, last)``.

    ``lead`` is the text between the row mark and the first entry. It goes in
    front of the first entry that is more than a lone pipe (at ``place``), or of
    the next row mark if there is none.
    """

    def mark_text(head: Column, i: Column) -> Column:
        return F.when(i == 0, F.lit("")).otherwise(F.substring_index(head, "\n", 1))

    def lead_text(head: Column, i: Column) -> Column:
        return F.substring(head, F.length(mark_text(head, i)) + 1, F.length(head))

    def idle(group: Column) -> Column:
        # The last entry tells for nearly all groups.
        return (F.size(group) == 1) | (
            (F.try_element_at(group, F.lit(-1)) == "|")
            & F.forall(F.slice(group, 2, F.size(group)), lambda entry: entry == "|")
        )

    def lead_place(group: Column) -> Column:
        filled = F.transform(F.slice(group, 2, F.size(group)), lambda entry: entry != "|")
        first = F.array_position(filled, True).cast("int")
        return F.when(first == 0, F.size(filled)).otherwise(first) - 1

    def row(group: Column, i: Column) -> Column:
        head = group[0]
        before = F.get(groups, i - 1)
        carried = F.when((i > 0) & idle(before), lead_text(before[0], i - 1))
        last = i == F.size(groups) - 1
        lead = F.when(last | ~idle(group), lead_text(head, i)).otherwise(F.lit(""))
        return F.struct(
            F.concat(F.coalesce(carried, F.lit("")), mark_text(head, i)).alias("attribute"),
            lead.alias("lead"),
            F.when(lead != "", lead_place(group)).otherwise(F.lit(0)).alias("place"),
            F.slice(group, 2, F.size(group)).alias("entries"),
            last.alias("last"),
        )

    return F.transform(groups, row)


def _line(attribute: Column, lead: Column, entries: Column) -> Column:
    return F.struct(
        attribute.alias("attribute"), lead.alias("lead"), entries.alias("entries")
    )


def _caption_line(rows: Column, plain: Column, dialect: str) -> Column:
    """The last caption of a table as a line of one entry, an empty line if none.

    Observed: a caption in the very last place is a cell, not a caption.
    """

    def counts(row: Column, entry: Column, i: Column) -> Column:
        if dialect == INTENDED:
            return _is_caption(entry)
        return _is_caption(entry) & ~(row["last"] & (i == F.size(row["entries"]) - 1))

    def last_caption(row: Column) -> Column:
        captions = F.filter(
            F.transform(
                row["entries"],
                lambda entry, i: F.when(
                    counts(row, entry, i),
                    _line(
                        row["attribute"],
                        F.when(i == row["place"], row["lead"]).otherwise(F.lit("")),
                        F.array(entry),
                    ),
                ),
            ),
            lambda line: line.isNotNull(),
        )
        return F.try_element_at(captions, F.lit(-1))

    with_caption = F.filter(rows, lambda row: F.exists(row["entries"], _is_caption))
    found = F.filter(F.transform(with_caption, last_caption), lambda line: line.isNotNull())
    none = _line(F.lit(""), F.lit(""), F.array(F.lit("| ")))
    return F.when(plain, none).otherwise(F.coalesce(F.try_element_at(found, F.lit(-1)), none))


def _cell_lines(rows: Column, plain: Column, dialect: str) -> Column:
    """The rows that have cells, in order.

    Observed: text still open at the end becomes a cell, so the last row always
    has one, and a caption in the very last place is a cell as well.
    """

    def has_cell(row: Column) -> Column:
        return F.exists(row["entries"], lambda entry: ~_is_caption(entry))

    def is_cell(row: Column, entry: Column, i: Column) -> Column:
        if dialect == INTENDED:
            return ~_is_caption(entry)
        return ~_is_caption(entry) | (row["last"] & (i == F.size(row["entries"]) - 1))

    def with_cells(row: Column) -> Column:
        # The lead may belong to a caption.
        leading = is_cell(row, F.get(row["entries"], row["place"]), row["place"])
        return _line(
            row["attribute"],
            F.when(leading, row["lead"]).otherwise(F.lit("")),
            F.filter(row["entries"], lambda entry, i: is_cell(row, entry, i)),
        )

    def open_text(row: Column) -> Column:
        text = F.when(
            (F.size(rows) > 1) & (row["lead"] == ""), row["attribute"]
        ).otherwise(row["lead"])
        entry = F.concat(F.lit("| "), m.as_literal(text))
        return _line(F.lit(""), F.lit(""), F.array(entry))

    def as_it_is(row: Column) -> Column:
        return _line(row["attribute"], F.lit(""), row["entries"])

    filled = lambda row: F.size(row["entries"]) > 0
    if dialect == INTENDED:
        return F.when(plain, F.transform(F.filter(rows, filled), as_it_is)).otherwise(
            F.transform(F.filter(rows, has_cell), with_cells)
        )

    def lines(kept, line) -> Column:
        return F.transform(
            F.filter(rows, lambda row: row["last"] | kept(row)),
            lambda row: F.when(F.size(row["entries"]) == 0, open_text(row)).otherwise(line(row)),
        )

    return F.when(plain, lines(filled, as_it_is)).otherwise(lines(has_cell, with_cells))


def _bang(text: Column) -> Column:
    """Make exclamation marks literal."""
    return m.swap(text, "!", m.BANG)


def _separate(entry: Column, dialect: str) -> Column:
    """Put separators between the cells of an entry and drop its leading mark.

    Data and caption entries keep their ``!``; a header entry is cut at ``!!``
    on its first line. A caption is never cut, its double pipes vanish.
    """
    rest = F.substring(entry, 2, F.length(entry))
    header_line = F.substring_index(F.substring_index(rest, "\n", 1), m.NEWLINE, 1)
    header_tail = F.substring(rest, F.length(header_line) + 1, F.length(rest))
    header = F.concat(
        F.lit(m.HEADER_CELL),
        _bang(F.replace(header_line, F.lit("!!"), F.lit(m.HEADER_SEP))),
        _bang(header_tail),
    )
    # One space after the pipe is dropped. Observed: any other first character
    # is literal.
    first = F.substring(entry, 2, 1)
    if dialect == OBSERVED:
        first = m.swap(first, "|", m.FIRST_PIPE)
    content = F.substring(entry, 3, F.length(entry))
    data = _bang(F.concat(F.when(first == " ", F.lit("")).otherwise(first), content))
    caption = _bang(F.replace(content, F.lit("||"), F.lit("")))
    double_pipe, separator = F.lit("||"), F.lit(m.CELL_SEP)
    return (
        F.when(entry.startswith("!"), F.replace(header, double_pipe, separator))
        .when(_is_caption(entry), caption)
        .otherwise(F.replace(data, double_pipe, separator))
    )


def _lock(entries: Column) -> Column:
    """Observed: an entry takes one attribute at most.

    After the first cell with a lone pipe, a link or a template, lone pipes in
    the later cells of the entry are literal.
    """
    free = rf"^[^{_ATTRIBUTE_STOP}]*+(?:[{_ATTRIBUTE_STOP}][^{_SEPARATORS}]*+)?"

    def measured(entry: Column) -> Column:
        has_more = entry.contains(m.CELL_SEP) | entry.contains(m.HEADER_SEP)
        return F.struct(
            entry.alias("text"),
            F.when(has_more, F.length(F.regexp_extract(entry, free, 0))).alias("free"),
        )

    def locked(entry: Column) -> Column:
        text, free = entry["text"], entry["free"]
        rest = m.swap(F.substring(text, free + 1, F.length(text)), "|", m.PIPE)
        return F.when(free.isNull(), text).otherwise(F.concat(F.left(text, free), rest))

    return F.transform(F.transform(entries, measured), locked)


def _flag_headers(entry: Column, dialect: str) -> Column:
    """Flag every header cell. Observed: a double pipe ends the header cells."""
    next_header = F.lit(m.CELL_SEP + m.HEADER_CELL)
    if dialect == INTENDED:
        flagged = F.replace(
            m.swap(entry, m.HEADER_SEP, m.CELL_SEP), F.lit(m.CELL_SEP), next_header
        )
    else:
        headers = F.substring_index(entry, m.CELL_SEP, 1)
        others = F.substring(entry, F.length(headers) + 1, F.length(entry))
        flagged = F.concat(
            F.replace(headers, F.lit(m.HEADER_SEP), next_header),
            m.swap(others, m.HEADER_SEP, m.CELL_SEP),
        )
    return F.when(entry.startswith(m.HEADER_CELL), flagged).otherwise(entry)


def _lead_in(entry: Column, lead: Column) -> Column:
    """Put the literal lead in front of the first cell."""
    return F.when(
        entry.startswith(m.HEADER_CELL),
        F.concat(F.lit(m.HEADER_CELL), lead, F.substring(entry, 2, F.length(entry))),
    ).otherwise(F.concat(lead, entry))


def _data_entries(line: Column, joined: Column, dialect: str) -> Column:
    """``_separate`` for a row of data cells only, all its entries at once; null for other rows.

    ``joined`` has the entries, each behind a header mark; the result has them behind a header separator.
    """
    start = m.HEADER_CELL
    data = joined
    if dialect == OBSERVED:
        data = F.replace(data, F.lit(start + "||"), F.lit(m.HEADER_SEP + m.FIRST_PIPE))
    for mark in (start + "| ", start + "|"):
        data = F.replace(data, F.lit(mark), F.lit(m.HEADER_SEP))
    others = joined.contains(start + "!") | joined.contains(start + "|+")
    return F.when((line["lead"] == "") & ~others, F.replace(_bang(data), F.lit("||"), F.lit(m.CELL_SEP)))


def _data_text(data: Column, dialect: str) -> Column:
    """``_row_text`` of ``_data_entries``."""
    if dialect == OBSERVED:
        locked = F.regexp_replace(data, _LOCKED_PIPE, "$1" + m.PIPE)
        data = F.when(data.contains(m.CELL_SEP) & data.contains("|"), locked).otherwise(data)
    return F.substring(m.swap(data, m.HEADER_SEP, m.CELL_SEP), 2, F.length(data))


def _row_text(line: Column, dialect: str) -> Column:
    """All cells of a row as one string, with a separator between them."""
    entries = F.transform(line["entries"], lambda entry: _separate(entry, dialect))
    if dialect == OBSERVED:
        entries = _lock(entries)
    entries = F.transform(entries, lambda entry: _flag_headers(entry, dialect))
    # The lead goes to the first entry that is more than a lone pipe.
    filled = F.transform(line["entries"], lambda entry: entry != "|")
    place = F.array_position(filled, True)
    place = F.when(place == 0, F.size(filled)).otherwise(place) - 1
    with_lead = F.transform(
        entries,
        lambda entry, i: F.when(i == place, _lead_in(entry, m.as_literal(line["lead"]))).otherwise(entry),
    )
    return F.array_join(F.when(line["lead"] == "", entries).otherwise(with_lead), m.CELL_SEP)


def _lines(raw_tables: DataFrame, dialect: str, lines_of_rows) -> DataFrame:
    """Tables cut into lines: a row per element of ``lines_of_rows(rows, plain)``."""
    check_dialect(dialect)
    raw = F.col("raw")
    kept = [name for name in ("dump_id", "corrupt") if name in raw_tables.columns]
    page = ("page_name", "table_name", "table_attributes", *kept)
    # One select per stage, see ``extract_tables``.
    staged = (
        raw_tables.select(
            "page_name",
            *kept,
            F.concat_ws("_", "page_name", F.col("table_idx").cast("string")).alias("table_name"),
            F.when(_has_other_break(raw), F.regexp_replace(raw, _LINE_BREAK[dialect], "\n"))
            .otherwise(m.checked(raw))
            .alias("raw"),
        )
        .withColumn("raw", _drop_last_break(raw))
        .select(
            "page_name",
            *kept,
            "table_name",
            F.substring(F.substring_index(raw, "\n", 1), 3, F.length(raw)).alias("table_attributes"),
            _body(raw).alias("body"),
        )
    )
    if dialect == INTENDED:
        staged = staged.withColumn("body", protect_literal_text(F.col("body")))
    staged = staged.withColumn("body", protect(F.col("body")))
    staged = staged.withColumn("body", show_hidden_entries(F.col("body")))
    if dialect == OBSERVED:
        staged = staged.withColumn("body", settle_bangs(F.col("body")))
    return (
        staged.select(*page, _is_plain(F.col("body")).alias("plain"), _row_groups(F.col("body")).alias("groups"))
        .select(*page, "plain", F.when(F.col("plain"), _plain_rows(F.col("groups"))).otherwise(_rows(F.col("groups"))).alias("rows"))
        .select(*page, F.posexplode_outer(lines_of_rows(F.col("rows"), F.col("plain"))).alias("line_no", "line"))
        .where(F.col("line").isNotNull() | (F.col("corrupt").isNotNull() if "corrupt" in kept else F.lit(False)))
    )


def _cells(lines: DataFrame, dialect: str) -> DataFrame:
    """Lines cut into cells, with their data, attributes and header flag."""
    cell, attribute = F.col("cell"), F.col("attribute")
    kept = [name for name in ("dump_id", "corrupt") if name in lines.columns]
    page = ("page_name", "table_name", "table_attributes", *kept, "line_no")
    explode = F.posexplode_outer if "corrupt" in kept else F.posexplode
    before_pipe = F.substring_index(cell, "|", 1)
    has_own, has_span = cell.contains("|"), F.lit(False)
    for char in STOP:
        has_own, has_span = has_own & ~before_pipe.contains(char), has_span | cell.contains(char)
    with_own = F.when(attribute == "", before_pipe).otherwise(
        F.concat_ws(" ", attribute, before_pipe)
    )
    if dialect == INTENDED:
        full = F.when(has_own, with_own).otherwise(attribute)
    else:
        full = F.when(has_own, with_own).when(has_span, attribute).otherwise(F.lit(""))
        # A line break between a lone pipe and a span gets lost.
        break_lost = rf"([|{m.PIPE}])\n(?=[{SPAN_START}])"
    separated = (
        lines.select(*page, "line", F.concat(F.lit(m.HEADER_CELL), F.array_join("line.entries", m.HEADER_CELL)).alias("joined"))
        .select(*page, "line", _data_entries(F.col("line"), F.col("joined"), dialect).alias("data"))
        .select(
            *page,
            F.col("line.attribute").alias("attribute"),
            F.when(F.col("data").isNotNull(), _data_text(F.col("data"), dialect)).otherwise(_row_text(F.col("line"), dialect)).alias("text"),
        )
        .select(*page, "attribute", explode(F.split("text", m.CELL_SEP, -1)).alias("col", "cell"))
        .select(
            *page,
            "attribute",
            "col",
            cell.startswith(m.HEADER_CELL).cast("int").alias("is_header"),
            F.replace(cell, F.lit(m.HEADER_CELL), F.lit("")).alias("cell"),
        )
    )
    if dialect == OBSERVED:
        separated = separated.withColumn(
            "cell",
            F.when(cell.contains("\n"), F.regexp_replace(cell, break_lost, "$1")).otherwise(cell),
        )
    return separated.select(
        *page,
        "col",
        m.unmask_cell(
            F.when(has_own, F.substring(cell, F.length(before_pipe) + 2, F.length(cell))).otherwise(cell)
        ).alias("cell_data"),
        full.alias("cell_attributes"),
        "is_header",
    ).withColumn(
        "cell_attributes",
        F.when(F.col("cell_attributes") == "", F.lit("")).otherwise(m.unmask(F.col("cell_attributes"))),
    )


def parse_records(raw_tables: DataFrame, dialect: str = OBSERVED) -> DataFrame:
    """Both result tables in one pass, told apart by ``row``.

    Per table, row -1 is its information (the caption as the only cell), the
    rows from 0 on are its cells. Corrupt pages of ``extract_tables`` are rows
    with only ``corrupt``.
    """
    lines = _lines(
        raw_tables,
        dialect,
        lambda rows, plain: F.concat(F.array(_caption_line(rows, plain, dialect)), _cell_lines(rows, plain, dialect)),
    )
    return _with_spans(_cells(lines, dialect).withColumn("row", F.col("line_no") + _INFO_ROW))


def _with_spans(cells: DataFrame) -> DataFrame:
    attributes = F.col("cell_attributes")
    kept = [name for name in ("dump_id", "corrupt") if name in cells.columns]
    return cells.select(
        *kept,
        "page_name", "table_name", "table_attributes", "row", "col", "cell_data",
        "cell_attributes", "is_header",
        row_span(attributes).alias("row_span"), col_span(attributes).alias("col_span"),
    )


def info_of(records: DataFrame) -> DataFrame:
    """``wikitable_information`` out of the rows that describe a table."""
    return records.select(
        "page_name", "table_name", "table_attributes",
        F.col("cell_data").alias("caption"), F.col("cell_attributes").alias("caption_attributes"),
    )


def data_of(records: DataFrame) -> DataFrame:
    """``wikitable_data`` out of the rows that are cells."""
    return records.select(
        "table_name", "row", "col", "cell_data", "cell_attributes",
        "is_header", "row_span", "col_span",
    )


def _without_corrupt(raw_tables: DataFrame) -> DataFrame:
    whole = raw_tables.where("corrupt IS NULL") if "corrupt" in raw_tables.columns else raw_tables
    return whole.drop("corrupt", "dump_id")


def parse_info(raw_tables: DataFrame, dialect: str = OBSERVED) -> DataFrame:
    """Raw tables to ``wikitable_information``, one row per table."""
    lines = _lines(_without_corrupt(raw_tables), dialect, lambda rows, plain: F.array(_caption_line(rows, plain, dialect)))
    return info_of(_cells(lines, dialect))


def parse_data(raw_tables: DataFrame, dialect: str = OBSERVED) -> DataFrame:
    """Raw tables to ``wikitable_data``, one row per cell."""
    lines = _lines(_without_corrupt(raw_tables), dialect, lambda rows, plain: _cell_lines(rows, plain, dialect))
    cells = _cells(lines, dialect).withColumnRenamed("line_no", "row")
    return data_of(_with_spans(cells))


def parse_tables(raw_tables: DataFrame, dialect: str = OBSERVED) -> ParsedTables:
    """``(page_name, table_idx, raw)`` to the two result tables."""
    return ParsedTables(parse_info(raw_tables, dialect), parse_data(raw_tables, dialect))
