"""Candidate selections as boolean Columns (they push down to the scan when the
referenced columns are stored ones)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The selection thresholds.
PROBK_MIN = 0.7
VERTEX_CHI2_MIN = 0.7


def b_candidate_selection(hadrons=("H1", "H2", "H3"), probk_min: float = PROBK_MIN,
                          vertex_chi2_min: float = VERTEX_CHI2_MIN) -> Column:
    """``B_VertexChi2 >= 0.7`` and every hadron's ``ProbK >= 0.7``."""
    kaons = reduce(lambda a, b: a & b, [F.col(f"{h}_ProbK") >= probk_min for h in hadrons])
    return (F.col("B_VertexChi2") >= vertex_chi2_min) & kaons


def strict_kaon_selection(hadrons=("H1", "H2", "H3")) -> Column:
    """Every hadron identified as a kaon with certainty: ``ProbK == 1``."""
    return reduce(lambda a, b: a & b, [F.col(f"{h}_ProbK") == 1.0 for h in hadrons])
