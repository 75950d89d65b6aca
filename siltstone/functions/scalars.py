"""Column expressions shared by the operators. All are Spark built-ins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(part: str, whole: str, scale: int = 1) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is 0."""
    return F.round(F.try_divide(F.col(part), F.col(whole)) * 100, scale)


def growth_pct(current: str, previous: str, scale: int = 1) -> Column:
    """Percentage change from ``previous``; NULL when that is NULL or 0."""
    now, before = F.col(current), F.col(previous)
    return F.round(F.try_divide(now - before, before) * 100, scale)


def label_codes(code: str, labels: Mapping[int, str], default: str) -> Column:
    """Readable label of a code; unknown and NULL codes get ``default``."""
    if not labels:
        return F.lit(default)
    (first, text), *rest = labels.items()
    chain = F.when(F.col(code) == first, F.lit(text))
    for value, text in rest:
        chain = chain.when(F.col(code) == value, F.lit(text))
    return chain.otherwise(F.lit(default))


def base_name(path: str | Column) -> Column:
    """Last segment of a path."""
    return F.element_at(F.split(F.col(path) if isinstance(path, str) else path, "/"), -1)


def decode_path(path: str | Column) -> Column:
    """Undo the percent-encoding of a file URI, leaving ``+`` alone."""
    path = F.col(path) if isinstance(path, str) else path
    # url_decode would read "+" as a blank, which a URI path does not mean.
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
