from mesonlab.functions.kinematics import (
    KAON_MASS_MEV, sum_cols, sum_squares, momentum_columns, with_momentum, with_energy,
    four_momentum_sum, invariant_mass, with_four_momentum, with_b_mass, B_MASS_COLUMNS,
)
from mesonlab.functions.selection import b_candidate_selection, strict_kaon_selection

__all__ = [
    "KAON_MASS_MEV", "sum_cols", "sum_squares", "momentum_columns", "with_momentum",
    "with_energy", "four_momentum_sum", "invariant_mass", "with_four_momentum", "with_b_mass",
    "B_MASS_COLUMNS", "b_candidate_selection", "strict_kaon_selection",
]
