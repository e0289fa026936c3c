"""Stand-in characters used while a text is being cut into pieces.

A stand-in takes the place of a markup character that must not act as markup.
All of them are control characters that XML 1.0 forbids, so no page of a dump
can contain them, and each is one byte in UTF-8.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markup characters inside a protected span, or literal for another reason.
PIPE = "\x01"
BANG = "\x02"
NEWLINE = "\x03"
FIRST_PIPE = "\x04"  # literal because it is the first character of an entry

# Brackets of matched spans. A link or template opener stops the attribute
# search of its cell, the "quiet" ones do not.
LINK_OPEN = "\x05"
TEMPLATE_OPEN = "\x06"
QUIET_SQUARE_OPEN = "\x07"
QUIET_SQUARE_CLOSE = "\x08"
QUIET_CURLY_OPEN = "\x0e"
QUIET_CURLY_CLOSE = "\x0f"

# End of literal text; has no character of its own.
LITERAL_END = "\x12"

# Stops the attribute search like an opener; has no character of its own.
SPAN_GOES_ON = "\x13"

# Discarded closing brackets.
STRAY_SQUARE_CLOSE = "\x10"
STRAY_CURLY_CLOSE = "\x11"
STRAY = STRAY_SQUARE_CLOSE + STRAY_CURLY_CLOSE

# Cell boundaries and flags of a row while it is one string.
CELL_SEP = "\x14"  # from a double pipe, and between entries
HEADER_SEP = "\x15"  # from a double exclamation mark
HEADER_CELL = "\x16"  # first character of a header cell

# Table markers.
TABLE_OPEN = "\x17"
TABLE_CLOSE = "\x18"
TABLE_EMPTY = "\x19"  # an opening and a closing marker sharing one pipe
DONE_OPEN = "\x1a"
DONE_CLOSE = "\x1b"
INNER_OPEN = "\x01"
INNER_CLOSE = "\x02"
INNER_EMPTY = "\x03"

# Stand-ins that also occur outside spans, and those of spans.
_ANYWHERE, _ANYWHERE_PLAIN = PIPE + BANG + FIRST_PIPE, "|!|"
_IN_SPANS = (
    NEWLINE + LINK_OPEN + TEMPLATE_OPEN + QUIET_SQUARE_OPEN + QUIET_SQUARE_CLOSE
    + QUIET_CURLY_OPEN + QUIET_CURLY_CLOSE
)
_IN_SPANS_PLAIN = "\n[{[]{}"


def swap(col: Column, old: str, new: str) -> Column:
    """Replace each character of ``old`` by the one of ``new`` at its place, in turn.

    A chain of literal replacements: a byte search each, while ``translate``
    looks up every character of the text.
    """
    for a, b in zip(old, new, strict=True):
        col = F.replace(col, F.lit(a), F.lit(b))
    return col


def unmask(col: Column) -> Column:
    """Give every stand-in of a parsed text its character back."""
    text = swap(col, _ANYWHERE + _IN_SPANS, _ANYWHERE_PLAIN + _IN_SPANS_PLAIN)
    for char in (LITERAL_END, SPAN_GOES_ON):
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def unmask_cell(col: Column) -> Column:
    """``unmask`` for cell texts: a cell with a part of a span has the span's end."""
    with_span = (
        col.contains(QUIET_SQUARE_CLOSE) | col.contains(QUIET_CURLY_CLOSE) | col.contains(LITERAL_END)
    )
    return F.when(with_span, unmask(col)).otherwise(swap(col, _ANYWHERE, _ANYWHERE_PLAIN))


def as_literal(col: Column) -> Column:
    """Make a text inert: none of its characters acts as markup any more."""
    literal = swap(
        col,
        "|!" + LINK_OPEN + TEMPLATE_OPEN,
        FIRST_PIPE + BANG + QUIET_SQUARE_OPEN + QUIET_CURLY_OPEN,
    )
    return F.replace(literal, F.lit(SPAN_GOES_ON), F.lit(""))


def checked(text: Column) -> Column:
    """The text; stops the job if it holds a stand-in, which no XML text does."""
    broken = F.raise_error(F.concat(F.lit("control characters in a table text: "), F.left(text, F.lit(80))))
    return F.when(text.rlike("[\\x01-\\x08\\x0e-\\x1b]"), broken).otherwise(text)
