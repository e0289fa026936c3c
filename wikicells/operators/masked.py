"""Effects outside the rules of wikitext that a table text shows once its spans are masked."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikicells.functions import marks as m
from wikicells.functions.fold import rewrite_until_absent

# What keeps a later pipe of a cell from ending an attribute.
STOP = (m.LINK_OPEN, m.TEMPLATE_OPEN, m.SPAN_GOES_ON)

# A table head, a row mark with lines behind it that are no entries, or a lone
# pipe, up to a line break that a span hides. Spans count only inside cells.
_HEAD_LINES = rf"[^\n{m.NEWLINE}]*+(?:\n(?![|!])[^\n{m.NEWLINE}]*+)*+"
_HIDDEN_BREAK = rf"((?:^|\n\|-){_HEAD_LINES}|\n\|{m.SPAN_GOES_ON}?){m.NEWLINE}"
# The same with an entry behind it, in which a link or template goes on.
# (The first condition is cheap and holds for such heads only.)
_CUT_SPAN = (
    rf"((?:^|\n\|-)(?={_HEAD_LINES}{m.NEWLINE})(?=[^{m.NEWLINE}]*[{''.join(STOP)}]){_HEAD_LINES}"
    rf"|\n\|{m.SPAN_GOES_ON}){m.NEWLINE}"
)


# Hidden breaks of one head one after the other, with no entry behind them: each match goes on where the
# last one ended, so a head takes one pass however many lines it has.
_HEAD_BREAKS = rf"((?:^|\n\|-|\G(?!^)){_HEAD_LINES}){m.NEWLINE}(?![|!{m.PIPE}{m.BANG}])"

# Hidden row marks of one head, the lines between them hidden or not, in one pass as well: a match ends with
# a row mark, and the next goes on there. From the first link or template of a head on, it goes on in the
# rows behind it, so marks before it and marks behind it are two chains.
def _chain(stop: str) -> str:
    line = rf"[^\n{m.NEWLINE}{stop}]*+"
    return rf"{line}(?:(?:\n(?![|!])|{m.NEWLINE}(?![|!{m.PIPE}{m.BANG}])){line})*+"


_HIDDEN_MARK = rf"{m.NEWLINE}{m.PIPE}-"
_MARKS_BEFORE = rf"((?:^|\n\|-|\G(?!^)){_chain(''.join(STOP))}){_HIDDEN_MARK}"
_MARKS_BEHIND = rf"((?:(?:^|\n\|-){_chain(''.join(STOP))}[{''.join(STOP)}]|\G(?!^)){_chain('')}){_HIDDEN_MARK}"


def show_hidden_entries(masked: Column) -> Column:
    """Undo protection outside cells: a line there is a line, an entry an entry.

    Row marks and lines that are no entries take one pass over the text, however many there are. What is
    left for the rounds is one entry a head, as an entry ends the head, and lone pipes.
    """

    def show_cut(text: Column) -> Column:
        text = F.regexp_replace(text, rf"{_CUT_SPAN}{m.PIPE}-", f"$1\n|-{m.SPAN_GOES_ON}")
        text = F.regexp_replace(text, rf"{_CUT_SPAN}{m.PIPE}(?={m.NEWLINE})", f"$1\n|{m.SPAN_GOES_ON}")
        text = F.regexp_replace(text, rf"{_CUT_SPAN}{m.PIPE}([^-{m.NEWLINE}])", f"$1\n|$2{m.SPAN_GOES_ON}")
        text = F.regexp_replace(text, f"{_CUT_SPAN}{m.BANG}", f"$1\n!{m.SPAN_GOES_ON}")
        lone = rf"\n\|{m.SPAN_GOES_ON}{m.NEWLINE}([^{m.PIPE}{m.BANG}])"
        text = F.regexp_replace(text, lone, f"\n|\n$1{m.SPAN_GOES_ON}")
        return F.regexp_replace(text, f"{_CUT_SPAN}(?![{m.PIPE}{m.BANG}])", "$1\n")

    def show(text: Column) -> Column:
        shown = F.regexp_replace(text, _HIDDEN_BREAK, "$1\n")
        shown = F.replace(shown, F.lit("\n" + m.PIPE), F.lit("\n|"))
        shown = F.replace(shown, F.lit("\n" + m.BANG), F.lit("\n!"))
        return show_heads(F.when(text.rlike(_CUT_SPAN), show_cut(text)).otherwise(shown))

    def show_heads(text: Column) -> Column:
        return F.regexp_replace(text, _HEAD_BREAKS, "$1\n")

    # A search for a literal is far cheaper than a pattern's pass over a long text.
    marked = F.regexp_replace(masked, _MARKS_BEFORE, "$1\n|-")
    marked = F.regexp_replace(marked, _MARKS_BEHIND, f"$1\n|-{m.SPAN_GOES_ON}")
    marked = F.when(masked.contains(_HIDDEN_MARK), marked).otherwise(masked)
    shown = rewrite_until_absent(show_heads(marked), _HIDDEN_BREAK, show, needs=m.NEWLINE)
    shown = F.replace(shown, F.lit(f"\n|{m.SPAN_GOES_ON}\n"), F.lit("\n|\n"))
    return F.when(masked.contains(m.NEWLINE), shown).otherwise(masked)


# A header line up to an exclamation mark that no other character has settled.
SPAN_START = m.LINK_OPEN + m.TEMPLATE_OPEN + m.QUIET_CURLY_OPEN
_OPEN_BANG = rf"(\n!(?:[^!\n{m.NEWLINE}]++|!!|!(?=[^!|\n{m.NEWLINE}]))*+)!"
# It is passed on over double pipes, row marks and entries of at most one
# character to the next cell that has text, behind its first character ...
_SPLITS = r"(?:\|\|)*+"
_WITHOUT_TEXT = (
    rf"(?:\|-[^\n]*+\n(?:[^|!\n][^\n]*+\n)*+|\|[^\n]?+{_SPLITS}\n(?=[|!])|!{_SPLITS}\n(?=[|!]))*+"
)
_NEXT_TEXT = (
    rf"{_SPLITS}\n{_WITHOUT_TEXT}"
    rf"(?:(?:\|[^\n-]|!){_SPLITS}\|[{SPAN_START}]|\|\n[^|!]|\|[^\n-]{_SPLITS}(?=[^|\n])|!{_SPLITS}(?=[^|!\n]))"
)
_PASSED_ON = (
    rf"{_OPEN_BANG}({_NEXT_TEXT}|{_SPLITS}[\n|][{SPAN_START}]|(?:\|\|)++(?=[^|!\n]|\n[^|!]))"
)
# ... and changes places with a lone pipe.
_SWAPPED = rf"{_OPEN_BANG}\|([^|!\n{SPAN_START}])"
_LOST = rf"{_OPEN_BANG}(?=(?:\|\|)*+\|?(?:\n[|!]|\z))"


def settle_bangs(masked: Column) -> Column:
    """Observed: a single ``!`` at the end of a header cell goes elsewhere.

    It turns up in the next cell, or is lost at the end of the table.
    """

    def settle(text: Column) -> Column:
        text = F.regexp_replace(text, _PASSED_ON, "$1$2" + m.BANG)
        return F.regexp_replace(text, _SWAPPED, f"$1{m.BANG}$2|")

    settled = rewrite_until_absent(masked, f"{_PASSED_ON}|{_SWAPPED}", settle)
    at_end = masked.contains("!\n") | masked.contains("!|") | masked.endswith("!")
    return F.when(at_end, F.regexp_replace(settled, _LOST, "$1")).otherwise(masked)
