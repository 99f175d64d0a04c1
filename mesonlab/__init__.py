"""mesonlab: particle-decay candidate analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers, the candidate-table loader and dataset catalog, writers
functions  column expressions: kinematics, selections, user functions
operators  frame verbs, statistics, quantiles and histograms
streaming  Structured Streaming variants of the row-wise operators
plans      the registered queries and their SQL oracles
"""

from mesonlab.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
