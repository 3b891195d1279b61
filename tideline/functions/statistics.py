"""Tail probabilities as SQL expressions. They see one row per compared column, never the data.

Arguments are SQL expressions over the row; results are SQL expressions again, for F.expr.
"""

import math


def ks_p_value(distance: str, n: str, m: str) -> str:
    """Asymptotic two-sample Kolmogorov-Smirnov tail, as the alternating series."""
    scaled = f"({distance} * sqrt({n} * {m} / ({n} + {m})))"
    series = f"""aggregate(sequence(1, 100), 0D,
        (total, k) -> total + if(k % 2 = 1, 2D, -2D) * exp(-2D * k * k * {scaled} * {scaled}))"""
    # Below 0.2 the tail is 1 to more than 10 decimals, and 100 terms no longer reach it.
    return f"if({scaled} < 0.2D, 1D, least(1D, greatest(0D, {series})))"


def erfc(y: str) -> str:
    """Complementary error function for y >= 0, by the series of erf with positive terms; 0 beyond 6."""
    summed = f"""aggregate(sequence(0, 150), struct({y} AS term, 0D AS total),
        (state, k) -> struct(state.term * 2D * {y} * {y} / (2 * k + 3) AS term, state.total + state.term AS total),
        state -> state.total)"""
    return f"if({y} >= 6D, 0D, greatest(0D, 1D - {2 / math.sqrt(math.pi)}D * exp(-{y} * {y}) * {summed}))"


def normal_tail(z: str) -> str:
    """P(Z > z) for a standard normal Z."""
    upper = f"({erfc(f'(abs({z}) / {math.sqrt(2)}D)')} / 2D)"
    return f"if({z} >= 0D, {upper}, 1D - {upper})"


def chi2_p_value(x: str, dof: str, approximate: bool = False) -> str:
    """P(chi-square with dof degrees > x): finite sums over whole or half orders, logarithmic so none underflows.

    The sum has a term for every two degrees. `approximate` asks for the cube-root normal approximation instead
    (Wilson and Hilferty 1931), at every number of degrees.
    """
    odd = f"({dof} % 2 = 1)"
    half = f"({x} / 2D)"
    terms = f"cast({dof} div 2 AS int)"  # (dof - 1) / 2 for odd dof
    log_first = f"if({odd}, 0.5D * ln({half}) + {math.log(2 / math.sqrt(math.pi))}D, 0D) - {half}"
    summed = f"""aggregate(sequence(0, greatest({terms}, 1) - 1),
        struct({log_first} AS log_term, 0D AS total),
        (state, k) -> struct(
          state.log_term + ln({half}) - ln(if({odd}, 1.5D, 1D) + k) AS log_term,
          state.total + exp(state.log_term) AS total),
        state -> state.total)"""
    exact = f"if({odd}, {erfc(f'sqrt({half})')}, 0D) + if({terms} >= 1, {summed}, 0D)"
    spread = f"try_divide(2D, 9D * {dof})"
    normal = normal_tail(f"((cbrt(try_divide({x}, {dof})) - 1D + {spread}) / sqrt({spread}))")
    return f"""CASE WHEN {x} IS NULL OR {dof} IS NULL THEN cast(NULL AS double)
        WHEN {dof} < 1 OR {x} <= 0D THEN 1D
        ELSE {normal if approximate else f"least(1D, {exact})"} END"""
