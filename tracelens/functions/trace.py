"""Trace-line scalar functions (parse, hex conversion, access filter).

All are native Spark expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The trace line pattern and the access codes of the tracer output.
# Anchored at the start only; the size field is exactly one digit followed by
# spaces, so 16/32-byte accesses do not match and their lines are dropped.
TRACE_LINE_PATTERN = r"^(\w+): (W|R) (\w+) +(\d) +(\w+)"
ACCESS_TYPES = ("R", "W", "RW")

_HEX = r"^(0[xX])?[0-9a-fA-F]{1,16}$"
_TWO_64 = 18446744073709551616
_TWO_63 = 9223372036854775808


def _strip_0x(c: Column) -> Column:
    return F.regexp_replace(c, r"^0[xX]", "")


def is_hex(c: Column) -> Column:
    """True when ``c`` is a hex number of at most 64 bits (optional 0x prefix)."""
    return c.rlike(_HEX)


def hex_to_int(c: Column, on_error: str = "null") -> Column:
    """Exact unsigned value of a hex string as DECIMAL(20,0).

    ``on_error='raise'`` fails the query on a non-hex value (as ``int(x, 16)``
    does); ``'null'`` returns NULL instead.
    """
    value = F.conv(_strip_0x(c), 16, 10).cast("decimal(20,0)")
    bad = ~is_hex(c)
    if on_error == "raise":
        return F.when(c.isNull(), F.lit(None)).when(
            bad, F.raise_error(F.concat(F.lit("not a hex number: "), c))
        ).otherwise(value)
    return F.when(bad, F.lit(None)).otherwise(value)


def hex_to_word(c: Column, on_error: str = "null") -> Column:
    """The 64-bit word of a hex address as a signed LONG (two's complement).

    Addresses below 2^63 read as their plain value; kernel-half addresses wrap
    to negative longs.  Operators that need unsigned arithmetic (chunk sums,
    min/max) undo the wrap exactly, see ``operators.chunks``.
    """
    word = F.conv(_strip_0x(c), 16, -10).cast("long")
    bad = ~is_hex(c)
    if on_error == "raise":
        return F.when(c.isNull(), F.lit(None)).when(
            bad, F.raise_error(F.concat(F.lit("not a hex number: "), c))
        ).otherwise(word)
    return F.when(bad, F.lit(None)).otherwise(word)


def word_to_unsigned(c: Column) -> Column:
    """Inverse of :func:`hex_to_word`: LONG word -> exact DECIMAL(20,0)."""
    d = c.cast("decimal(20,0)")
    return F.when(c < 0, d + F.lit(str(_TWO_64)).cast("decimal(20,0)")).otherwise(d).cast("decimal(20,0)")


def parse_trace_line(line: Column) -> dict[str, Column]:
    """Columns of one trace line: ``ins`` (hex string), ``rw``, ``tgt`` (hex string).

    Empty strings mean the line does not match and must be dropped.
    """
    return {
        "ins_hex": F.regexp_extract(line, TRACE_LINE_PATTERN, 1),
        "rw": F.regexp_extract(line, TRACE_LINE_PATTERN, 2),
        "tgt_hex": F.regexp_extract(line, TRACE_LINE_PATTERN, 3),
    }


def access_filter(rw: Column, access: str) -> Column:
    """Keep rows whose access code is part of ``access`` ('r', 'w' or 'rw')."""
    codes = [ch for ch in access.upper() if ch in ("R", "W")]
    if not codes:
        raise ValueError(f"unknown access type {access!r}")
    return rw.isin(codes)
