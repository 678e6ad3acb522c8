"""Scalar Column expressions. All are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java int range, used for saturating double -> int conversion.
INT_MAX = 2147483647
INT_MIN = -2147483648

# Fixed value: the default title marker of the catalog filter (a substring test, not a year parse).
DEFAULT_TITLE_MARKER = "(20"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_int(x: Column | str) -> Column:
    """``(int) x`` for a double, as Java does it: truncate toward zero, NaN -> 0,
    saturate at the int range. A plain cast raises under ANSI mode for NaN/inf."""
    x = _col(x)
    return (
        F.when(F.isnan(x), F.lit(0))
        .when(x >= F.lit(float(INT_MAX)), F.lit(INT_MAX))
        .when(x <= F.lit(float(INT_MIN)), F.lit(INT_MIN))
        .otherwise(x.cast("int"))
    )


def half_star_weight(rating: Column | str) -> Column:
    """Integer weight of a rating: ``(int)(float(rating) * 2)``; half stars become 1..10."""
    r = _col(rating).cast("float")
    return java_int((r * F.lit(2.0).cast("float")).cast("double"))


def similarity_scale(similarity: Column | str) -> Column:
    """Integer similarity: ``(int)(100 * similarity)`` with Java's NaN/infinity rules."""
    return java_int(F.lit(100.0) * _col(similarity))


def cosine(num: Column | str, d1: Column | str, d2: Column | str, *, parity: bool = True) -> Column:
    """``num / (sqrt(d1) * sqrt(d2))`` with the association kept, so doubles match bit for bit.

    A zero denominator is guarded explicitly (ANSI mode raises on ``x / 0``):
    ``parity=True`` gives NaN when ``num`` is 0 and +infinity otherwise, as IEEE division does;
    ``parity=False`` gives NULL.
    """
    num, d1, d2 = _col(num).cast("double"), _col(d1).cast("double"), _col(d2).cast("double")
    den = F.sqrt(d1) * F.sqrt(d2)
    if parity:
        on_zero = F.when(num == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    else:
        on_zero = F.lit(None).cast("double")
    return F.when(den == 0, on_zero).otherwise(num / den)


def title_has_marker(title: Column | str, marker: str = DEFAULT_TITLE_MARKER) -> Column:
    """True when ``marker`` occurs anywhere in the title (first-match substring test)."""
    return F.instr(_col(title), marker) > 0


def title_year(title: Column | str) -> Column:
    """First four-digit year in parentheses, e.g. ``'Heat (1995)' -> 1995``; NULL when absent."""
    return F.regexp_extract(_col(title), r"\((\d{4})\)", 1).try_cast("int")


def pack_entries(entries: Column | str, key_field: str, value_field: str) -> Column:
    """``array<struct>`` -> ``'\\t(k\\tv)\\t(k\\tv)...'`` in array order."""
    return F.array_join(
        F.transform(
            _col(entries),
            lambda e: F.concat(
                F.lit("\t("), e[key_field].cast("string"), F.lit("\t"),
                e[value_field].cast("string"), F.lit(")"),
            ),
        ),
        "",
    )


# Fixed value: the packed sparse-row text format is a sequence of "<TAB>(<col><TAB><val>)" entries.
_ENTRY_PATTERN = r"\((-?\d+)\t(-?\d+)\)"


def unpack_entries(packed: Column | str) -> Column:
    """``'\\t(k\\tv)...'`` -> ``array<struct<key:bigint, value:bigint>>`` in text order."""
    p = F.coalesce(_col(packed), F.lit(""))
    keys = F.regexp_extract_all(p, F.lit(_ENTRY_PATTERN), 1)
    vals = F.regexp_extract_all(p, F.lit(_ENTRY_PATTERN), 2)
    return F.transform(
        F.arrays_zip(keys.alias("key"), vals.alias("value")),
        lambda e: F.struct(e["key"].cast("bigint").alias("key"),
                           e["value"].cast("bigint").alias("value")),
    )
