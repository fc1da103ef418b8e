"""Run stamps: one for all tables of a run, a parameter wherever results must repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _now(form: str) -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), form)


def _given(given: str | Column | None, otherwise: Column) -> Column:
    if isinstance(given, Column):
        return F.coalesce(F.nullif(given, F.lit("")), otherwise)
    return F.lit(given) if given else otherwise


def version(given: str | Column | None = None) -> Column:
    """The given version, or today's date in UTC; an empty or null one counts as not given."""
    return _given(given, _now("yyyy-MM-dd"))


def instant(given: str | Column | None = None) -> Column:
    """The given instant, or now, as ISO 8601 in UTC with milliseconds."""
    return _given(given, _now("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
