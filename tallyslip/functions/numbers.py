"""Rounding as the JSON documents have it, as SQL expressions over named columns or lambda variables.

Kernels with many steps are SQL text: one parsed expression instead of thousands of calls from Python."""

from __future__ import annotations


def let(value: str, name: str, body: str) -> str:
    """SQL text of `body`, in which `name` stands for `value`, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def round_exact(x: str, digits: int) -> str:
    """SQL text: a double rounded to `digits` (1 to 8) decimals as its exact binary value demands, ties to even; null, NaN and
    infinities stay.

    The fraction f times the power of ten is a double p and an exact rest (Dekker's product). Only where p lies in the middle between
    two integers does the rest, or without a rest the even one, decide; the quotient of the two integers is rounded once."""
    power, low = f"{float(10**digits)}D", "CAST(floor(p) AS DOUBLE)"
    split = f"{2**27 + 1}D"
    by_rest = let(f"(h * {power} - p) + (f - h) * {power}", "e", f"CASE WHEN e > 0 THEN {low} + 1 WHEN e < 0 THEN {low} ELSE rint(p) END")
    rest = let(f"f * {split} - (f * {split} - f)", "h", by_rest)
    near = f"CASE WHEN p - {low} = 0.5D THEN {rest} ELSE rint(p) END"
    joined = f"CASE WHEN w * {power} + n < {2**53}D THEN (w * {power} + n) / {power} ELSE w + n / {power} END"
    rounded = let("CAST(floor(abs(v)) AS DOUBLE)", "w", let("abs(v) - w", "f", let(f"f * {power}", "p", let(near, "n", joined))))
    return let(f"CAST({x} AS DOUBLE)", "v", f"CASE WHEN isnan(v) OR abs(v) >= {2**52}D OR v = 0 THEN v ELSE signum(v) * {rounded} END")


def round_scaled(x: str, digits: int) -> str:
    """SQL text: a double scaled, rounded to the even integer and scaled back, as arrays are rounded; never a negative zero."""
    power = f"{float(10**digits)}D"
    return f"(rint({x} * {power}) / {power} + 0D)"
