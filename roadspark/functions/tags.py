"""Column functions on tag values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocabulary import CALMING_CLASSES, KEPT_TAGS, SURFACE_CLASSES, UNKNOWN_SURFACE


def present(value: Column) -> Column:
    """Neither null nor empty; never null itself."""
    return F.coalesce(value != "", F.lit(False))


def is_value(value: Column, *wanted: str) -> Column:
    """One of the wanted values; false, not null, for a missing one."""
    return F.coalesce(value.isin(*wanted), F.lit(False))


def _class_of(value: Column, classes: dict[str, str], otherwise: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in classes.items() for x in pair])
    return F.coalesce(table[value], otherwise)


def calming_type(value: Column) -> Column:
    return _class_of(value, CALMING_CLASSES, value)


def surface_type(value: Column) -> Column:
    """The surface class; ``unknown`` for other values. Exact match: no trimming, no folding."""
    return _class_of(value, SURFACE_CLASSES, F.lit(UNKNOWN_SURFACE))


def way_surface(value: Column) -> Column:
    """The surface of a road way: null when missing, empty or unknown."""
    return F.when(present(value), F.nullif(surface_type(value), F.lit(UNKNOWN_SURFACE)))


def kept_tags(tags: str = "tags") -> Column:
    """The tags worth keeping, as a map; null when there are none."""
    pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in KEPT_TAGS]), F.array(*[F.col(f"{tags}.{k}") for k in KEPT_TAGS]))
    found = F.map_filter(pairs, lambda _, v: present(v))
    return F.when(F.size(found) > 0, found)


def way_id_of(feature_id: Column) -> Column:
    """The number in ids like ``w12``; null for any other id."""
    return F.nullif(F.regexp_extract(feature_id, "^w([0-9]+)", 1), F.lit("")).try_cast("bigint")


#: What counts as white space at the ends of a value: that of Unicode's separators and of
#: ASCII's controls, and the byte order mark.
_BLANK = "\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def trimmed(value: Column) -> Column:
    """The value without white space at its ends."""
    return F.btrim(value, F.lit(_BLANK))


def split_values(value: Column) -> Column:
    """The values of a tag that lists several, trimmed."""
    return F.transform(F.split(value, ";"), trimmed)
