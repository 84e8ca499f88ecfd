"""Distribution tails in SQL, by Simpson's rule on smooth substitutions.

Independent of the code under test, which evaluates continued fractions and
series: here the densities are integrated over a fixed grid (error far below
the six decimals that are compared).
"""

from __future__ import annotations

STEPS = 4000


def _simpson(integrand: str, upper: str) -> str:
    """Integral of ``integrand`` (a function of x) from 0 to ``upper``."""
    x = f"(({upper}) * i / {STEPS}.0)"
    weight = f"CASE WHEN i = 0 OR i = {STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return (f"(SELECT sum(({weight}) * {integrand.replace('$x', x)}) FROM range({STEPS + 1}) g(i))"
            f" * ({upper}) / {3 * STEPS}.0")


def t_two_sided(t: str, df: str) -> str:
    """x = sqrt(df) tan(angle) turns the density into a power of the cosine."""
    c = f"exp(lgamma((({df}) + 1) / 2.0) - lgamma(({df}) / 2.0)) / sqrt(pi())"
    return f"(1 - 2 * {c} * {_simpson(f'pow(cos($x), ({df}) - 1)', f'atan(abs({t}) / sqrt({df}))')})"


def f_upper(f: str, d1: str, d2: str) -> str:
    """The beta integral with x = sin(angle) squared."""
    a, b = f"(({d1}) / 2.0)", f"(({d2}) / 2.0)"
    c = f"2 * exp(lgamma({a} + {b}) - lgamma({a}) - lgamma({b}))"
    body = f"pow(sin($x), ({d1}) - 1) * pow(cos($x), ({d2}) - 1)"
    return f"(1 - {c} * {_simpson(body, f'atan(sqrt(({d1}) * ({f}) / ({d2})))')})"


def chi2_upper(x: str, k: str) -> str:
    """The density in the square root of its argument."""
    c = f"2 / (pow(2, ({k}) / 2.0) * exp(lgamma(({k}) / 2.0)))"
    return f"(1 - {c} * {_simpson(f'pow($x, ({k}) - 1) * exp(-$x * $x / 2)', f'sqrt({x})')})"


def p_label(p: str) -> str:
    return (f"CASE WHEN {p} IS NULL THEN NULL WHEN {p} < 0.001 THEN 'highly significant (p < 0.001)' "
            f"WHEN {p} < 0.01 THEN 'very significant (p < 0.01)' WHEN {p} < 0.05 THEN 'significant (p < 0.05)' "
            f"WHEN {p} < 0.10 THEN 'marginally significant (p < 0.10)' "
            f"ELSE 'NOT significant (p = ' || printf('%.3f', {p}) || ')' END")
