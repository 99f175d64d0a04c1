"""Relativistic kinematics as Column expressions (natural units, c = 1).

Everything here is a pure projection: Catalyst collapses the chain into one
Project, constant-folds the mass literal and keeps it inside whole-stage
codegen. Squares are written ``x * x``; that is bit-identical to
``pow(x, 2.0)`` and avoids a math-library call per value.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: charged kaon mass in MeV.
KAON_MASS_MEV = 493.677

AXES = ("PX", "PY", "PZ")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum_cols(cols: Iterable) -> Column:
    """Left-to-right sum ``c1 + c2 + ...``."""
    cols = [_col(c) for c in cols]
    if not cols:
        raise ValueError("sum_cols needs at least one column")
    return reduce(lambda acc, c: acc + c, cols)


def sum_squares(cols: Iterable) -> Column:
    """Left-to-right sum of squares."""
    return sum_cols([c * c for c in (_col(c) for c in cols)])


def momentum_columns(prefix: str) -> list[Column]:
    return [F.col(prefix + axis) for axis in AXES]


def with_momentum(df: DataFrame, prefix: str) -> DataFrame:
    """Add ``{prefix}P2`` = |p|² and ``{prefix}P`` = |p|."""
    p2 = sum_squares(momentum_columns(prefix))
    return df.withColumns({prefix + "P2": p2, prefix + "P": F.sqrt(p2)})


def with_energy(df: DataFrame, prefix: str, mass=KAON_MASS_MEV) -> DataFrame:
    """Add ``{prefix}E2`` = m² + |p|² (mass term first) and ``{prefix}E``."""
    m = mass if isinstance(mass, Column) else F.lit(float(mass))
    e2 = sum_squares([m] + momentum_columns(prefix))
    return df.withColumns({prefix + "E2": e2, prefix + "E": F.sqrt(e2)})


def four_momentum_sum(prefixes: Sequence[str], quantity: str) -> Column:
    """Component-wise sum over daughters, e.g. ``H1_PX + H2_PX + H3_PX``."""
    return sum_cols([F.col(p + quantity) for p in prefixes])


def invariant_mass(e: Column, p2: Column) -> Column:
    """sqrt(E² − |p|²). Rounding can make the radicand slightly negative for a
    particle at rest; then the result is NaN, as in the reference."""
    return F.sqrt(e * e - p2)


def with_four_momentum(df: DataFrame, parent: str = "B_", daughters: Sequence[str] = ("H1_", "H2_", "H3_"),
                       mass=KAON_MASS_MEV) -> DataFrame:
    """Daughter momenta and energies, then the parent's summed PX, PY, PZ, E."""
    for h in daughters:
        df = with_momentum(df, h)
    for h in daughters:
        df = with_energy(df, h, mass)
    return df.withColumns({parent + q: four_momentum_sum(daughters, q) for q in ("PX", "PY", "PZ", "E")})


def with_b_mass(df: DataFrame, parent: str = "B_", daughters: Sequence[str] = ("H1_", "H2_", "H3_"),
                mass=KAON_MASS_MEV) -> DataFrame:
    """Reconstruct the parent's mass from three daughter hadrons.

    Adds 20 columns in the reference's order: per-hadron P2, P; per-hadron E2,
    E; parent PX, PY, PZ; parent P2, P; parent E, E2, M. Built as three
    projections (each ``withColumns`` is analysed once), values identical to
    applying ``with_momentum`` / ``with_energy`` one by one.
    """
    m = mass if isinstance(mass, Column) else F.lit(float(mass))
    first = {}
    for h in daughters:
        p2 = sum_squares(momentum_columns(h))
        first[h + "P2"], first[h + "P"] = p2, F.sqrt(p2)
    for h in daughters:
        e2 = sum_squares([m] + momentum_columns(h))
        first[h + "E2"], first[h + "E"] = e2, F.sqrt(e2)
    for axis in AXES:
        first[parent + axis] = four_momentum_sum(daughters, axis)
    df = df.withColumns(first)
    p2 = sum_squares(momentum_columns(parent))
    df = df.withColumns({parent + "P2": p2, parent + "P": F.sqrt(p2),
                         parent + "E": four_momentum_sum(daughters, "E")})
    e = F.col(parent + "E")
    return df.withColumns({parent + "E2": e * e, parent + "M": F.sqrt(e * e - p2)})


B_MASS_COLUMNS = (["H1_P2", "H1_P", "H2_P2", "H2_P", "H3_P2", "H3_P",
                   "H1_E2", "H1_E", "H2_E2", "H2_E", "H3_E2", "H3_E",
                   "B_PX", "B_PY", "B_PZ", "B_P2", "B_P", "B_E", "B_E2", "B_M"])
