"""Words and lines as all operators here count them.

White space is the six ASCII characters space, tab, line feed, vertical tab, form feed and
carriage return; a word is a longest run of anything else. NULL counts as an empty text.
"""

from pyspark.sql import Column, functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text_or_empty(text), SPACE), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")
