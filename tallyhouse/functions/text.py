"""Names, paths and overflow text."""

from pyspark.sql import Column, functions as F


def full_name(first: Column, last: Column) -> Column:
    """NULL as soon as one part is NULL."""
    return F.concat(first, F.lit(" "), last)


def overflow(columns: list[str]) -> Column:
    """Values of the extra columns in header order; NULLs are skipped.

    Without extra columns the overflow is NULL, with only NULL values it is ''.
    """
    if not columns:
        return F.lit(None).cast("string")
    quoted = ["`" + name.replace("`", "``") + "`" for name in columns]
    return F.concat_ws(", ", *[F.col(name) for name in quoted])


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def decoded_path(path: Column) -> Column:
    """Undoes the percent-encoding of ``_metadata.file_path``; a plus sign stands for itself."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def without_prefix(path: Column, prefix: Column) -> Column:
    """The rest of ``path`` after ``prefix``; a path that lacks it stays whole."""
    return F.when(
        path.startswith(prefix), F.substring(path, F.length(prefix) + 1, F.length(path))
    ).otherwise(path)


def url_key(url: Column) -> Column:
    """What follows scheme and host, without the leading slash."""
    return F.regexp_replace(url, r"^[A-Za-z0-9+.-]+://[^/]*/?", "")
