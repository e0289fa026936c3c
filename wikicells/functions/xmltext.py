"""XML text form of a decoded string."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_NON_ASCII = r"[^\x00-\x7F]"


def escape_markup(text: Column) -> Column:
    """Write ``& < >`` as entities."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def escape_non_ascii(text: Column) -> Column:
    """Write every non-ASCII character as ``&#code;``."""
    pieces = F.regexp_extract_all(
        text, F.lit(rf"[\x00-\x7F]++|{_NON_ASCII}"), F.lit(0)
    )
    as_ascii = F.array_join(
        F.transform(
            pieces,
            lambda piece: F.when(
                F.ascii(piece) > 127, F.concat(F.lit("&#"), F.ascii(piece), F.lit(";"))
            ).otherwise(piece),
        ),
        "",
    )
    return F.when(F.octet_length(text) != F.length(text), as_ascii).otherwise(text)


def xml_escape(text: Column) -> Column:
    """The XML text form of a string, in ASCII."""
    return escape_non_ascii(escape_markup(text))
