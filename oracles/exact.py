"""Integer arithmetic for rounding, so that no floating-point tie can differ between engines."""

from __future__ import annotations


def half_up(num: str, den: str, digits: int) -> str:
    """``num / den`` rounded half away from zero, as an integer count of ``10**-digits``."""
    n, d = f"({num})::hugeint", f"({den})::hugeint"
    size = f"((2 * abs({n}) * {10**digits} + abs({d})) // (2 * abs({d})))"
    return f"(case when {d} <> 0 then sign({n}) * sign({d}) * {size} end)"


def quotient(num: str, den: str, digits: int) -> str:
    return scaled(half_up(num, den, digits), digits)


def scaled(integer: str, digits: int) -> str:
    """A value held as an integer count of ``10**-digits``, as a double."""
    return f"(({integer})::double / 1e{digits})"


def money(cents: str) -> str:
    return scaled(cents, 2)


def percent(num: str, den: str) -> str:
    return quotient(f"({num}) * 100", den, 2)


def mean(value: str, digits: int, unit: int = 1) -> str:
    """Average of a column that counts ``1/unit``."""
    return quotient(f"sum({value})", f"count({value}) * {unit}", digits)
