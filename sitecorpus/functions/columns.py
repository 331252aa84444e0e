"""Small column expressions shared by the jobs. All are native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WS = r"[\s ]+"


def site_of(url: Column) -> Column:
    """Host of a URL, lower-cased, without user, port or a leading ``www.``; empty when the URL has none, so that such pages
    form a group of their own in joins and counts."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def trim_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def leading_number(c: Column) -> Column:
    """Number at the start of the text (`12px` -> 12.0), NULL otherwise."""
    return F.regexp_extract(c, r"^\s*(-?(?:\d+\.?\d*|\.\d+))", 1).try_cast("double")


def size_number(c: Column) -> Column:
    return F.regexp_extract(c, r"^(-?[\d.]+)(?:px|%|em|rem|vw|vh)?$", 1).try_cast("double")


def size_unit(c: Column) -> Column:
    unit = F.regexp_extract(c, r"^-?[\d.]+(px|%|em|rem|vw|vh)?$", 1)
    return F.when(size_number(c).isNotNull(), F.when(unit == "", "px").otherwise(unit))


def millis(c: Column) -> Column:
    """CSS time to whole milliseconds; a bare number means seconds."""
    n = leading_number(c)
    return F.floor(F.when(c.rlike(r"^\s*-?[\d.]+\s*ms"), n).otherwise(n * 1000) + 0.5)


def _hex2(c: Column) -> Column:
    return F.lpad(F.lower(F.conv(c, 10, 16)), 2, "0")


def bind(c: Column, body) -> Column:
    """`body` of `c` with `c` evaluated once; keeps deep expressions from multiplying in generated code."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def _hex_of(v: Column) -> Column:
    rgb = r"^rgba?\(\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)"
    return F.when(v.rlike("^[0-9a-f]{6}$"), F.concat(F.lit("#"), v)).when(
        v.rlike(rgb), F.concat(F.lit("#"), *[_hex2(F.regexp_extract(v, rgb, i)) for i in (1, 2, 3)])
    )


def hex_norm(c: Column) -> Column:
    """`#rgb`, `rrggbb`, `rgb()` and `rgba()` to `#rrggbb`; NULL for anything else."""
    low = F.regexp_replace(F.lower(trim_ws(c)), "^#", "")
    six = F.regexp_replace(low, "^([0-9a-f])([0-9a-f])([0-9a-f])$", "$1$1$2$2$3$3")
    return bind(six, _hex_of)


def channel(hex_col: Column, i: int) -> Column:
    """Channel i (0 red, 1 green, 2 blue) of a `#rrggbb` text as an integer."""
    return F.conv(F.substring(hex_col, 2 + 2 * i, 2), 16, 10).cast("int")


def var_fallback(c: Column) -> Column:
    """The fallback of `var(--x, fallback)`; other values unchanged; NULL for `var()` without one."""
    fb = F.regexp_extract(c, r"var\([^,]+,\s*([^)]*[^)\s])\s*\)", 1)
    return F.when(c.startswith("var("), F.nullif(fb, F.lit(""))).otherwise(c)


def luminance(hex_col: Column) -> Column:
    def lin(i: int) -> Column:
        s = channel(hex_col, i) / F.lit(255.0)
        return F.when(s <= 0.03928, s / 12.92).otherwise(F.pow((s + 0.055) / 1.055, F.lit(2.4)))

    return F.lit(0.2126) * lin(0) + F.lit(0.7152) * lin(1) + F.lit(0.0722) * lin(2)


def js_round(c: Column) -> Column:
    """Half-up rounding to a whole number."""
    return F.floor(c + F.lit(0.5))


# The part that a side takes of a shorthand of one, two, three and four parts.
SIDE_PARTS = {"top": (1, 1, 1, 1), "right": (1, 2, 2, 2), "bottom": (1, 1, 3, 3), "left": (1, 2, 2, 4)}


def shorthand_side(c: Column, side: str) -> Column:
    """One side of a 1-to-4-part shorthand (top, right, bottom, left)."""
    parts = F.split(trim_ws(c), r"\s+")
    pick = SIDE_PARTS[side]
    n = F.size(parts)
    return F.when(n == 1, F.try_element_at(parts, F.lit(pick[0]))).when(
        n == 2, F.try_element_at(parts, F.lit(pick[1]))
    ).when(n == 3, F.try_element_at(parts, F.lit(pick[2]))).when(n == 4, F.try_element_at(parts, F.lit(pick[3])))
