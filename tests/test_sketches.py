"""Stored sketches: appended files, rank bounds, binnings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mesonlab.operators import histogram as H
from mesonlab.operators import sketches as K


def test_store_grows_by_new_files_only(spark, tmp_path):
    files, store = str(tmp_path / "files"), str(tmp_path / "store")
    rng = np.random.default_rng(1)
    values = rng.lognormal(size=30_000)
    df = spark.createDataFrame([(int(i % 3), float(v)) for i, v in enumerate(values)], "part int, x double")
    sources = []
    for part in range(3):
        df.where(F.col("part") == part).repartition(3).write.mode("append").parquet(files)
        K.update_store(spark.read.parquet(files), ["x"], store)
        rows = K.read_store(spark, store).collect()
        assert len({r.source for r in rows}) == len(rows) == 3 * (part + 1)
        assert sources == [r.sketch for r in sorted(rows, key=lambda r: r.source) if r.sketch in sources] or set(sources) <= {r.sketch for r in rows}
        sources = [r.sketch for r in rows]
    K.update_store(spark.read.parquet(files), ["x"], store)
    sketches = K.read_store(spark, store)
    assert sketches.count() == 9
    ordered = np.sort(values)
    for r in K.sketch_quantiles(sketches, [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]).collect():
        assert abs(np.searchsorted(ordered, r.q) - r.p * len(values)) <= 0.01 * len(values) + 1
    b = K.sketch_binning(sketches, "x")
    assert (b.n, b.n_valid, b.min, b.max) == (30_000, 30_000, ordered[0], ordered[-1])
    rows = H.histogram_edges(spark.read.parquet(files), "x", H.bin_edges(b)).collect()
    assert sum(r.n for r in rows) == 30_000


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0), (float("inf"), None)], "x double, y double")
    s = K.sketch_columns(df, ["x", "y"], F.lit("one"))
    assert {(r.variable, r.n, r.n_valid) for r in K.merged(s).collect()} == {("x", 3, 0), ("y", 3, 2)}
    assert {(r.variable, r.p): r.q for r in K.sketch_quantiles(s, [0.0, 1.0]).collect()} == {("x", 0.0): None, ("x", 1.0): None, ("y", 0.0): 1.0, ("y", 1.0): 2.0}
    assert K.sketch_binning(s, "x").width is None and K.sketch_binning(s, "other").n == 0
    assert K.sketch_columns(df.limit(0), ["x"], F.lit("one")).count() == 0
    with pytest.raises(ValueError):
        K.sketch_columns(df, [])
    with pytest.raises(ValueError):
        K.sketch_size(0)
    with pytest.raises(ValueError):
        K.sketch_quantiles(s, [1.5])
