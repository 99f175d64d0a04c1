"""The end-to-end analysis: candidates -> B mass -> optional selection ->
Freedman-Diaconis histogram -> histogram sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mesonlab.functions.kinematics import with_b_mass
from mesonlab.functions.selection import b_candidate_selection
from mesonlab.operators.histogram import REFERENCE_RELATIVE_ERROR, histogram_fd
from mesonlab.sources.catalog import load_dataset
from mesonlab.sources.writers import write_histogram


def mass_spectrum(candidates: DataFrame, selection: bool = False, quantiles: str = "exact",
                  relative_error: float = REFERENCE_RELATIVE_ERROR) -> DataFrame:
    """Histogram of the reconstructed B mass (``bin, bin_lo, bin_hi, n``)."""
    mass = with_b_mass(candidates)
    if selection:
        mass = mass.where(b_candidate_selection())
    return histogram_fd(mass.select("B_M"), "B_M", quantiles=quantiles, relative_error=relative_error)


def run_spectrum(spark: SparkSession, workspace: str, dataset: str, selection: bool = False,
                 out: str | None = None, quantiles: str = "exact") -> DataFrame:
    """Load a named dataset from ``workspace``, build its mass histogram and
    write it as JSON to ``out`` (default ``<workspace>/b-mass-histogram.json``)."""
    hist = mass_spectrum(load_dataset(spark, workspace, dataset), selection, quantiles)
    write_histogram(hist, out or f"{workspace.rstrip('/')}/b-mass-histogram.json", mode="overwrite")
    return hist
