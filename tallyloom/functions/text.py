"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word ends at a space, tab, newline, carriage return or form feed.
WORD_BREAK = "[ \\t\\n\\r\\f]+"


def words(text: Column | str) -> Column:
    """Array of whitespace-separated pieces, case kept.

    Leading or trailing blanks leave an empty piece; whoever explodes the array
    drops it with a plain filter, which stays inside generated code.
    """
    return F.split(F.col(text) if isinstance(text, str) else text, WORD_BREAK)


def first_char(text: Column) -> Column:
    """First character of a string."""
    return F.substring(text, 1, 1)
