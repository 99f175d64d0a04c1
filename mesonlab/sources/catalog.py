"""Named datasets under a workspace folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mesonlab.sources.candidates import read_candidates

# Dataset names and their stored file names (the detector files
# converted to Parquet, hence the extension).
DATASETS = {
    "simulation": "PhaseSpaceSimulation.parquet",
    "magnet-down": "B2HHH_MagnetDown.parquet",
    "magnet-up": "B2HHH_MagnetUp.parquet",
}


def load_dataset(spark: SparkSession, workspace: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Load one named candidate dataset; an unknown name raises."""
    if name not in DATASETS:
        raise ValueError(f"unknown dataset {name!r}; expected one of {sorted(DATASETS)}")
    path = f"{workspace.rstrip('/')}/{DATASETS[name]}"
    if fmt != "parquet":
        path = path.rsplit(".", 1)[0] + "." + fmt
    return read_candidates(spark, path, fmt=fmt)
