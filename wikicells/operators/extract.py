"""Pages to raw tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikicells.functions import marks as m
from wikicells.functions.fold import rewrite_pieces, rewrite_until_absent
from wikicells.functions.xmltext import escape_markup, escape_non_ascii
from wikicells.options import INTENDED, OBSERVED, check_dialect

_INNERMOST = f"{m.TABLE_OPEN}[^{m.TABLE_OPEN}{m.TABLE_CLOSE}]*+{m.TABLE_CLOSE}"
_PIECE = f"{_INNERMOST}|{m.TABLE_OPEN}|[^{m.TABLE_OPEN}]++"
_OUTERMOST = f"{m.DONE_OPEN}[^{m.DONE_OPEN}{m.DONE_CLOSE}]*+{m.DONE_CLOSE}|{m.TABLE_EMPTY}"


def _mark_anywhere(text: Column) -> Column:
    """Table markers count anywhere after the first line that starts with ``{`` or ``|``."""
    first = F.least(
        F.nullif(F.instr(text, "\n{"), F.lit(0)),
        F.nullif(F.instr(text, "\n|"), F.lit(0)),
    )
    armed = F.coalesce(F.substring(text, first + 1, F.length(text)), F.lit(""))
    for marker, stand_in in (
        ("{|}", m.TABLE_EMPTY),
        ("{|", m.TABLE_OPEN),
        ("|}", m.TABLE_CLOSE),
    ):
        armed = F.replace(armed, F.lit(marker), F.lit(stand_in))
    return armed


def _mark_line_starts(text: Column) -> Column:
    """Table markers count only at the start of a line, as wikitext has it."""
    opened = F.regexp_replace(
        text, r"(^|\n)([ \t:]*+)\{\|(?!\})", "$1$2" + m.TABLE_OPEN
    )
    return F.regexp_replace(
        opened, r"(\n[ \t]*+)\|\}(?!\})", "$1" + m.TABLE_CLOSE
    )


def _close_innermost(piece: Column) -> Column:
    """Mark one matched table; the tables inside it are inner ones from now on."""
    closed = m.swap(
        piece,
        m.DONE_OPEN + m.DONE_CLOSE + m.TABLE_EMPTY + m.TABLE_OPEN + m.TABLE_CLOSE,
        m.INNER_OPEN + m.INNER_CLOSE + m.INNER_EMPTY + m.DONE_OPEN + m.DONE_CLOSE,
    )
    return F.when(piece.endswith(m.TABLE_CLOSE) & piece.startswith(m.TABLE_OPEN), closed).otherwise(piece)


def _restore(table: Column) -> Column:
    for stand_in, marker in (
        (m.DONE_OPEN, "{|"),
        (m.INNER_OPEN, "{|"),
        (m.DONE_CLOSE, "|}"),
        (m.INNER_CLOSE, "|}"),
        (m.TABLE_EMPTY, "{|}"),
        (m.INNER_EMPTY, "{|}"),
    ):
        table = F.replace(table, F.lit(stand_in), F.lit(marker))
    return table


def _matched(marked: Column) -> Column:
    """Close matched pairs from the inside out until none is left."""
    return rewrite_until_absent(
        marked, _INNERMOST, lambda t: rewrite_pieces(t, _PIECE, _close_innermost)
    )


def _outermost(matched: Column) -> Column:
    """The outermost tables of a matched text, in order.

    A marker still there has no partner: a closer is ignored, an opener
    swallows the rest of the page.
    """
    before_unclosed = F.substring_index(matched, m.TABLE_OPEN, 1)
    found = F.regexp_extract_all(before_unclosed, F.lit(_OUTERMOST), F.lit(0))
    return F.transform(found, _restore)


def extract_tables(pages: DataFrame, dialect: str = OBSERVED) -> DataFrame:
    """``(page_id, page_name, text)`` to ``(page_id, page_name, table_idx, raw)``.

    A narrow transformation: pages without tables vanish, the others give one
    row per outermost table, numbered from 0 in the page. In the ``observed``
    dialect the table text is in XML text form, as in the dump file.
    ``dump_id`` goes along if there is one; with ``corrupt``, a corrupt page
    gives one row that has only that. Control characters that XML forbids stop
    the job, as they stand in for markup here.
    """
    check_dialect(dialect)
    kept = [name for name in ("dump_id", "corrupt") if name in pages.columns]
    mark = _mark_line_starts if dialect == INTENDED else _mark_anywhere
    text = F.col("text")
    tables = (
        # One select per stage: a column used twice by the next stage is not
        # inlined there, so each stage is evaluated once per page.
        pages.select(
            "page_id", "page_name", *kept, F.when(text.contains("{|"), mark(m.checked(text))).alias("marked")
        )
        .select("page_id", "page_name", *kept, _outermost(_matched(F.col("marked"))).alias("tables"))
        # The outer form keeps the optimizer from inferring a "not empty"
        # filter below the generator, which would evaluate the array again.
        .select("page_id", "page_name", *kept, F.posexplode_outer("tables").alias("table_idx", "raw"))
        .where(F.col("raw").isNotNull() | (F.col("corrupt").isNotNull() if "corrupt" in kept else F.lit(False)))
    )
    if dialect == OBSERVED:
        tables = tables.withColumn("raw", escape_markup(F.col("raw"))).withColumn(
            "raw", escape_non_ascii(F.col("raw"))
        )
    return tables
