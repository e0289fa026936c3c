"""Rewriting a text until a pattern no longer occurs in it, within one row."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def rewrite_until_absent(
    text: Column, pattern: str, rewrite: Callable[[Column], Column], needs: str = ""
) -> Column:
    """Apply ``rewrite`` while ``pattern`` is found; ``needs`` is a text that every match of it holds.

    Each rewrite has to use up at least one character that the pattern needs,
    so there are at least as many rounds as can be wanted: the text length.
    Rounds come in groups of 1, 2, 4, … and a group is skipped when nothing is
    left to do: the cost follows the rewrites that happen, and the length of
    the text adds only its logarithm.
    """

    def state(value: Column, done: bool) -> Column:
        return F.struct(value.alias("text"), F.lit(done).alias("done"))

    def one_round(acc: Column, _: Column) -> Column:
        current = acc["text"]
        return (
            F.when(acc["done"], acc)
            .when(current.contains(needs) & current.rlike(pattern), state(rewrite(current), False))
            .otherwise(state(current, True))
        )

    def one_group(acc: Column, exponent: Column) -> Column:
        rounds = F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), exponent))
        return F.when(acc["done"], acc).otherwise(F.aggregate(rounds, acc, one_round))

    groups = F.sequence(F.lit(0), F.ceil(F.log2(F.length(text) + 1)).cast("int"))
    return F.aggregate(groups, state(text, False), one_group, lambda acc: acc["text"])


def rewrite_pieces(
    text: Column, token: str, rewrite: Callable[[Column], Column]
) -> Column:
    """Cut a text into the matches of ``token``, rewrite each, join them again.

    ``token`` must match everywhere, so that nothing gets lost between pieces.
    """
    pieces = F.regexp_extract_all(text, F.lit(token), F.lit(0))
    return F.array_join(F.transform(pieces, rewrite), "")
