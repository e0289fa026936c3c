"""Keep the markup inside links, templates, arguments and literal text inert."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikicells.functions import marks as m
from wikicells.functions.fold import rewrite_pieces, rewrite_until_absent

# Bracket runs go on across a line break. A single bracket is plain text.
_SINGLE = (
    r"\[(?<!\[\[)(?<!\[\n\[)(?!\n?\[)|\](?<!\]\])(?<!\]\n\])(?!\n?\])"
    r"|\{(?<!\{\{)(?<!\{\n\{)(?!\n?\{)|\}(?<!\}\})(?<!\}\n\})(?!\n?\})"
)
_PLAIN = rf"[^\[\]{{}}]*+(?:(?:{_SINGLE})[^\[\]{{}}]*+)*+"
_LINK = rf"\[\n?\[{_PLAIN}\]\n?\]"
_TEMPLATE = rf"\{{\n?\{{{_PLAIN}\}}\n?\}}"
_ARGUMENT = rf"\{{\n?\{{\n?\{{{_PLAIN}\}}\n?\}}\n?\}}"
# Closing runs that meet an opening run of the other kind are discarded.
_STRAY_SQUARE = rf"\{{(?<=\{{\{{|\{{\n\{{)(?:{_PLAIN}\](?:\n?\])++)++"
_STRAY_CURLY = rf"\[(?<=\[\[|\[\n\[)(?:{_PLAIN}\}}(?:\n?\}})++)++"

_REDUCIBLE = "|".join((_ARGUMENT, _TEMPLATE, _LINK, _STRAY_SQUARE, _STRAY_CURLY))
_PIECE = rf"{_REDUCIBLE}|[^\[\]{{}}]++|[\[\]{{}}]"
_RUN = r"([\[\]{}])\n?\1"


def _reduce(piece: Column) -> Column:
    markup, inert = "|!\n", m.PIPE + m.BANG + m.NEWLINE
    argument = m.swap(
        piece,
        "{}" + markup + m.LINK_OPEN + m.TEMPLATE_OPEN,
        m.QUIET_CURLY_OPEN + m.QUIET_CURLY_CLOSE + inert
        + m.QUIET_SQUARE_OPEN + m.QUIET_CURLY_OPEN,
    )
    template = m.swap(piece, "{}" + markup, m.TEMPLATE_OPEN + m.QUIET_CURLY_CLOSE + inert)
    link = m.swap(piece, "[]" + markup, m.LINK_OPEN + m.QUIET_SQUARE_CLOSE + inert)
    curly, square = piece.startswith("{"), piece.startswith("[")
    return (
        F.when(square & piece.endswith("]"), link)
        .when(curly & piece.endswith("}"), F.when(piece.rlike(r"^\{\n?\{\n?\{"), argument).otherwise(template))
        .when(curly & piece.endswith("]"), m.swap(piece, "]", m.STRAY_SQUARE_CLOSE))
        .when(square & piece.endswith("}"), m.swap(piece, "}", m.STRAY_CURLY_CLOSE))
        .otherwise(piece)
    )


def protect(text: Column) -> Column:
    """Mask ``| !``, line breaks and brackets inside matched bracket spans.

    Innermost pairs first, three braces before two. Brackets without a partner
    keep their character and protect nothing.
    """
    matched = rewrite_until_absent(
        text, _REDUCIBLE, lambda current: rewrite_pieces(current, _PIECE, _reduce)
    )
    restored = m.swap(matched, m.STRAY, "]}")
    return F.when(text.rlike(_RUN), restored).otherwise(text)


_LITERAL_TEXT = (
    r"<!--[\s\S]*?-->|<nowiki>[\s\S]*?</nowiki>|<pre>[\s\S]*?</pre>"
)


def protect_literal_text(text: Column) -> Column:
    """Mask all markup inside comments, ``nowiki`` and ``pre`` elements."""

    def mask(piece: Column) -> Column:
        inert = m.swap(
            piece,
            "|!\n[]{}",
            m.PIPE + m.BANG + m.NEWLINE
            + m.QUIET_SQUARE_OPEN + m.QUIET_SQUARE_CLOSE
            + m.QUIET_CURLY_OPEN + m.QUIET_CURLY_CLOSE,
        )
        literal = piece.startswith("<") & (F.length(piece) > 1)
        return F.when(literal, F.concat(inert, F.lit(m.LITERAL_END))).otherwise(piece)

    masked = rewrite_pieces(text, rf"{_LITERAL_TEXT}|[^<]++|<", mask)
    return F.when(text.rlike(_LITERAL_TEXT), masked).otherwise(text)
