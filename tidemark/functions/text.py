"""Text clean-up, names and quoting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the ASCII characters that count as blank when config text is stripped.
BLANKS = " \t\n\r\x0b\x0c"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Strip blanks at both ends; nothing left means NULL."""
    return F.nullif(F.btrim(as_column(c), F.lit(BLANKS)), F.lit(""))


def normalise_name(c: Column | str) -> Column:
    """Case-free form of a database, schema or table name."""
    return F.upper(as_column(c))


def flag(c: Column | str) -> Column:
    """TRUE text, in any case and padding, is true; anything else, NULL too, is false."""
    return F.coalesce(F.upper(clean_text(c)) == "TRUE", F.lit(False))


def split_list(c: Column | str) -> Column:
    """Items of a comma list, stripped."""
    return F.transform(F.split(as_column(c), ","), lambda item: F.btrim(item, F.lit(BLANKS)))


def quote_name(c: Column | str) -> Column:
    """A quoted identifier; quotes inside are doubled."""
    return F.concat(F.lit('"'), F.replace(as_column(c), F.lit('"'), F.lit('""')), F.lit('"'))
