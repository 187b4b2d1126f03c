"""Text helpers: slugs, labels, truncation and HTTP reason phrases."""

from __future__ import annotations

from http import HTTPStatus

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.columns import ColumnLike, _col

MAX_ERROR_MESSAGE = 500


def slugify(value: ColumnLike, default: str = "benchmark") -> Column:
    dashed = F.regexp_replace(F.lower(F.trim(_col(value))), "[^a-z0-9]+", "_")
    return F.coalesce(F.nullif(F.trim(dashed, F.lit("_")), F.lit("")), F.lit(default))


def capitalize_label(value: ColumnLike) -> Column:
    words = F.lower(F.replace(_col(value), F.lit("_"), F.lit(" ")))
    return F.concat(F.upper(F.substring(words, 1, 1)), F.substr(words, F.lit(2)))


def truncate(value: ColumnLike, limit: int = MAX_ERROR_MESSAGE) -> Column:
    return F.substring(_col(value), 1, limit)


def reason_phrase(status_code: ColumnLike) -> Column:
    entries = []
    for status in HTTPStatus:
        entries += [F.lit(int(status)), F.lit(status.phrase)]
    return F.try_element_at(F.create_map(*entries), _col(status_code).cast("int"))
