"""URL parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _without(url: Column, *schemes: str) -> Column:
    return reduce(lambda text, scheme: F.replace(text, F.lit(scheme), F.lit("")), schemes, url)


def _part(text: Column, separator: str, number: int) -> Column:
    return F.split_part(text, F.lit(separator), F.lit(number))


def url_host(url: str | Column) -> Column:
    """Host: the text before the first '/' and '?', without the scheme."""
    bare = _without(_column(url), "android-app://", "http://", "https://")
    return _part(_part(bare, "/", 1), "?", 1)


def url_path(url: str | Column) -> Column:
    """Path after the first '/', without the query string.

    A URL with no '/' starts its "path" just before the '?'; with neither, the
    whole host is returned (kept on purpose).
    """
    bare = _without(_column(url), "http://", "https://")
    slash = F.nullif(F.locate("/", bare), F.lit(0))
    start = F.coalesce(slash, F.locate("?", bare) - 1)
    return _part(F.right(bare, F.length(bare) - start), "?", 1)


def url_parameter(url: str | Column, name: str) -> Column:
    """Value of a query parameter, NULL when absent or empty.

    The name is matched as a substring, so 'source' also finds 'utm_source='.
    """
    value = _part(_part(_column(url), f"{name}=", 2), "&", 1)
    return F.nullif(value, F.lit(""))
