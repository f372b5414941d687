"""Scalar column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: report levels
ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_greatest(*cols) -> Column:
    """GREATEST that is NULL when any argument is NULL (SQL-engine semantics).

    Spark's ``greatest`` skips NULLs; a NULL safety stock must not turn into a
    demand of 0, so the NULL is propagated explicitly.
    """
    cs = [col(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


def free_stock(available, reserved) -> Column:
    return F.coalesce(col(available), F.lit(0)) - F.coalesce(col(reserved), F.lit(0))


def raw_demand(total_demand, safety_stock, available, reserved) -> Column:
    """max(0, demand + safety - (available - reserved)); NULL when safety is NULL."""
    need = col(total_demand) + col(safety_stock) - free_stock(available, reserved)
    return strict_greatest(F.lit(0), need).cast("long")


def round_up_to_pack(qty, pack_size) -> Column:
    """ceil(qty / pack) * pack as BIGINT; a pack of 0 gives NULL (no division error)."""
    pack = F.nullif(col(pack_size), F.lit(0))
    return (F.ceil(col(qty).cast("double") / pack) * pack).cast("long")


def money(c, precision: int = 18) -> Column:
    """Exact 2-decimal amount, for sums that must not depend on row order."""
    return col(c).cast(f"decimal({precision},2)")


def plus_days_text(date_text, days: int = 1) -> Column:
    """'yyyy-MM-dd' text shifted by ``days``."""
    return F.date_format(F.date_add(F.to_date(col(date_text)), days), "yyyy-MM-dd")


def parse_iso_ts(text) -> Column:
    """Tolerant ISO-8601 parse, NULL when unparsable: 'T' or a blank before the time, seconds
    and a fraction of 3 or 6 digits optional, a zone as 'Z' or offset optional."""
    t = F.regexp_replace(F.regexp_replace(col(text), "Z$", "+00:00"), r"^(\d{4}-\d{2}-\d{2}) ", "$1T")
    zone = "[XXX]"
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(p)) for p in (
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" + zone, "yyyy-MM-dd'T'HH:mm:ss.SSS" + zone, "yyyy-MM-dd'T'HH:mm:ss" + zone,
        "yyyy-MM-dd'T'HH:mm" + zone, "yyyy-MM-dd'T'HH" + zone, "yyyy-MM-dd")])


def file_stem(path) -> Column:
    """Base name of a path without its extension ('…/STORE_01.json' -> 'STORE_01').

    Cut by its separators: a pattern looked for in the whole path is tried from every one of its characters."""
    name = F.substring_index(col(path), "/", -1)
    stem = F.length(name) - F.length(F.substring_index(name, ".", -1)) - 1   # below 1: no dot, or nothing before it
    return F.when(stem > 0, F.left(name, stem)).otherwise(name)


def parent_folder(path) -> Column:
    """Name of the folder holding a file ('…/2026-01-14/SUP_001.json' -> '2026-01-14')."""
    return F.regexp_extract(F.substring_index(col(path), "/", -2), r"^([^/]+)/[^/]+$", 1)


def missing_keys(json_text, required: list[str]) -> Column:
    """Required keys absent from a JSON object, sorted and joined by ','.

    A key whose value is null counts as present (as in a dict lookup).
    """
    keys = F.json_object_keys(col(json_text))
    req = F.array(*[F.lit(k) for k in sorted(required)])
    return F.array_join(F.array_sort(F.array_except(req, F.coalesce(keys, F.array()))), ",")


def round_half_even(x, digits: int = 2) -> Column:
    """A DOUBLE rounded to ``digits`` (0 to 3) as its exact binary value asks, ties to the even digit; the result is the
    double nearest to the rounded decimal.

    The fraction is a whole number of 2^-63 parts, except in values too small to round to anything but zero; it is
    multiplied in two halves, so every comparison is one of whole numbers below 2^63.
    """
    x, scale, half = col(x).cast("double"), 10 ** digits, 1 << 31
    size = F.abs(x)
    whole = F.floor(size)
    n = F.floor((size - whole) * F.lit(2.0 ** 63))
    low = n.bitwiseAND(F.lit(half - 1)) * F.lit(scale)
    high = F.shiftright(n, 31) * F.lit(scale) + F.shiftright(low, 31)
    digit = F.shiftright(high, 32)
    rest = F.shiftleft(high.bitwiseAND(F.lit(2 * half - 1)), 31) + low.bitwiseAND(F.lit(half - 1))
    tie = F.lit(1 << 62)
    up = (rest > tie) | ((rest == tie) & (digit % 2 == 1))
    if digits == 0:
        up = (rest > tie) | ((rest == tie) & (whole % 2 == 1))
    total = (whole * F.lit(scale) + digit + up.cast("long")).cast("decimal(20,0)")
    value = F.when(size < F.lit(0.4 / scale), F.lit(0.0)).otherwise((total / F.lit(scale).cast("decimal(5,0)")).cast("double"))
    signed = F.when(x < 0, -value).otherwise(value)
    # from 2^52 on a double has no fraction
    return F.when(x.isNull() | F.isnan(x) | (size >= F.lit(2.0 ** 52)) | (x == 0), x).otherwise(signed)
