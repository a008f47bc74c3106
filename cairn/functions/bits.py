"""32-day activity bit masks held in a LongType (low 32 bits used).

Bit 31 is the anchor day, bit 31-d is d days before it (d = 0..31). The
written reference formula shifts by one day and loses the anchor day;
this module keeps the intended meaning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW_DAYS = 32


def day_bit(days_since: Column) -> Column:
    """``1 << (31 - days_since)`` for 0 <= days_since < 32, else 0."""
    in_window = (days_since >= 0) & (days_since < WINDOW_DAYS)
    shifted = F.call_function("shiftleft", F.lit(1).cast("long"), (F.lit(31) - days_since).cast("int"))
    return F.when(in_window, shifted).otherwise(
        F.lit(0).cast("long")
    )


def mask(first_day: int, n_days: int) -> int:
    """Bits for days ``first_day .. first_day+n_days-1`` before the anchor."""
    value = 0
    for d in range(first_day, first_day + n_days):
        value |= 1 << (31 - d)
    return value


def count_in(bits: Column, day_mask: int | None = None) -> Column:
    """Active days in the mask (``BIT_COUNT(bits & mask)``)."""
    v = bits if day_mask is None else bits.bitwiseAND(F.lit(day_mask).cast("long"))
    return F.bit_count(v).cast("int")


def bit_string(bits: Column) -> Column:
    """Render as a 32-character ``BIT(32)`` string."""
    return F.lpad(F.bin(bits), WINDOW_DAYS, "0")
