"""Month buckets of a sales date."""

from pyspark.sql import Column, functions as F


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def month_start_from_text(date: Column) -> Column:
    """The same month start by way of text: the first seven characters plus a day."""
    return F.to_date(F.concat(F.substring(date, 1, 7), F.lit("-01")))


def month_label(date: Column) -> Column:
    """``yyyy-MM``, the form used for partition folders."""
    return F.substring(date.cast("string"), 1, 7)
