"""Tails and quantiles of the usual distributions."""

from __future__ import annotations

import math

# Coefficients of a rational approximation of the normal quantile
# (relative error below 1.2e-9), highest power first.
_CENTRE_TOP = [-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239]
_CENTRE_BOTTOM = [-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0]
_TAIL_TOP = [-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783]
_TAIL_BOTTOM = [0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0]
_TAIL = 0.02425


def _polynomial(x: str, coefficients: list[float]) -> str:
    out = f"{coefficients[0]:.16e}"
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c:.16e})"
    return out


def normal_quantile(p: str) -> str:
    """SQL expression of the standard normal quantile of the expression ``p``, 0 < p < 1."""
    low, r = f"least({p}, 1.0e0 - {p})", f"({p} - 5.0e-1)"
    u, rr = f"sqrt(-2.0e0 * ln({low}))", f"({r} * {r})"
    tail = f"{_polynomial(u, _TAIL_TOP)} / {_polynomial(u, _TAIL_BOTTOM)}"
    centre = f"{r} * {_polynomial(rr, _CENTRE_TOP)} / {_polynomial(rr, _CENTRE_BOTTOM)}"
    return f"CASE WHEN {p} < {_TAIL:e} THEN {tail} WHEN {p} > {1 - _TAIL:e} THEN -({tail}) ELSE {centre} END"


def normal_tail(z: float) -> float:
    """Probability of a standard normal value above ``z``."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def chi_square_tail(x: float, freedom: float) -> float:
    """Probability of a chi-square value above ``x``.

    The series of the lower incomplete gamma function near zero, the continued
    fraction of the upper one beyond.
    """
    if x <= 0.0:
        return 1.0
    a, h = freedom / 2.0, x / 2.0
    front = math.exp(a * math.log(h) - h - math.lgamma(a))
    if h < a + 1.0:
        k, term, total = a, 1.0 / a, 1.0 / a
        while term > 1e-17 * total:
            k += 1.0
            term *= h / k
            total += term
        return max(0.0, 1.0 - front * total)
    b, c = h + 1.0 - a, 1e300
    d = out = 1.0 / b
    for i in range(1, 100_000):
        top = -i * (i - a)
        b += 2.0
        d, c = 1.0 / (top * d + b), b + top / c
        out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * out
