"""Sums of doubles that do not depend on the order of the rows."""

from __future__ import annotations

#: Bits of each of the two limbs behind the point.
LIMB = 30


def exact_sum(value: str, where: str = "true") -> str:
    """The sum of a double column, as SQL text; null if there is no value.

    Every value is cut into a whole part and two limbs of 30 bits, which are added as whole
    numbers; the total is rounded to a double once. Bits below 2^-60 are left out. A sum of
    over 2^33 rows, or beyond 2^63, is an error.
    """
    return _total(value, f"FILTER (WHERE {where})")


def exact_sum_over(value: str, window: str) -> str:
    """The running or whole sum of a double column over a window, as SQL text."""
    return _total(value, f"OVER {window}")


def _total(value: str, of_rows: str) -> str:
    size = f"{1 << LIMB}"
    whole = f"floor({value})"
    first = f"floor(({value} - {whole}) * {size}D)"
    second = f"floor((({value} - {whole}) * {size}D - {first}) * {size}D)"

    def total(part: str) -> str:
        return f"cast(sum(cast({part} AS bigint)) {of_rows} AS decimal(19, 0))"

    limbs = f"cast({total(first)} * {size}BD + {total(second)} AS decimal(38, 0))"
    all_limbs = f"cast({total(whole)} * {1 << 2 * LIMB}BD + {limbs} AS decimal(38, 0))"
    return f"(cast({all_limbs} AS double) / {1 << 2 * LIMB}D)"
