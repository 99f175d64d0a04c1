import math
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mesonlab.functions.udfs import histogram_bin_udf
from mesonlab.operators import histogram as H
from mesonlab.operators.edges import Edges, bin_values

MAX = sys.float_info.max
EDGES = [0.0, 1.5, 3.0, 4.5]
# value -> expected bin, from the fixed-edge rules
CASES = [(None, None), (-1.0, MAX), (0.0, 0.0), (1.49, 0.0), (1.5, 1.5), (4.49, 3.0),
         (4.5, MAX), (9.0, MAX), (float("nan"), 4.5)]


def _frame(spark, values):
    return spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double")


def _same(a, b):
    return (a is None and b is None) or a == b


def test_assign_bins_table(spark):
    out = H.assign_bins(_frame(spark, [c[0] for c in CASES]), "x", EDGES).orderBy("i").collect()
    assert all(_same(r.bin, exp) for r, (_, exp) in zip(out, CASES)), out


def test_histogram_bin_udf_table(spark):
    df = _frame(spark, [c[0] for c in CASES])
    out = df.select("i", histogram_bin_udf(EDGES)(F.col("x")).alias("bin")).orderBy("i").collect()
    assert all(_same(r.bin, exp) for r, (_, exp) in zip(out, CASES)), out


def test_single_edge_and_bad_edges(spark):
    df = _frame(spark, [-1.0, 0.0, 5.0, float("nan")])
    out = [r.bin for r in H.assign_bins(df, "x", [0.0]).orderBy("i").collect()]
    assert out == [MAX, MAX, MAX, 0.0]
    with pytest.raises(ValueError):
        H.assign_bins(df, "x", [])
    with pytest.raises(ValueError):
        H.assign_bins(df, "x", [1.0, 1.0])


def test_histogram_edges_counts(spark):
    df = _frame(spark, [c[0] for c in CASES])
    got = {r.bin: r.n for r in H.histogram_edges(df, "x", EDGES).collect()}
    assert got == {None: 1, MAX: 3, 0.0: 2, 1.5: 1, 3.0: 1, 4.5: 1}
    assert len(H.histogram_edges(df, "x", EDGES).collect()) == 6


def test_edges_accumulate():
    b = H.Binning(n=10, n_valid=10, min=0.1, max=1.0, q1=0.2, q3=0.5, width=0.1)
    edges, e = [], 0.1
    while e < 1.0:
        edges.append(e)
        e += 0.1
    assert H.bin_edges(b) == edges
    assert H.bin_edges(b) != [0.1 + i * 0.1 for i in range(len(edges))]


def _added_up(first, width, end):
    out = []
    while first < end:
        out.append(first)
        first += width
    return out


@settings(max_examples=300, deadline=None)
@given(st.floats(-1e9, 1e9), st.floats(1e-3, 1e3) | st.sampled_from([0.5, 0.75, 2.0 ** -20 * 3, 1 + 2.0 ** -52]), st.integers(1, 2000), st.lists(st.floats(allow_nan=True), max_size=5))
def test_runs_are_the_accumulated_edges(first, width, many, others):
    end = first + width * many
    want = _added_up(first, width, end)
    edges = Edges.accumulated(first, width, end)
    assert list(edges) == want and len(edges) == len(want) and edges[-1] == want[-1] and edges[len(want) // 2] == want[len(want) // 2]
    values = np.array(others + want[-3:] + [math.nextafter(e, -math.inf) for e in want[:3] + want[-3:]] + [first + width / 3])
    at = np.clip(np.searchsorted(want, values, side="right") - 1, 0, len(want) - 1)
    expected = np.where((values < want[0]) | (values >= want[-1]), MAX, np.array(want)[at])
    assert np.array_equal(bin_values(edges.arrays(), values), np.where(np.isnan(values), want[-1], expected))


def test_edges_beyond_any_list(spark):
    """Cauchy values: some 7e7 edges, as numpy adds them up; the bins as columns agree."""
    rng = np.random.default_rng(2)
    values = np.concatenate((rng.standard_cauchy(3000), [-3.3e7, 3.1e7, math.nan, math.inf, -math.inf]))
    edges = Edges.accumulated(-3.3e7, 0.937, 3.1e7)
    listed = np.cumsum(np.concatenate(([-3.3e7], np.full(len(edges), 0.937))))[:-1]
    assert len(edges) > 6e7 and len(edges.runs) < 200 and listed[-1] < 3.1e7 <= listed[-1] + 0.937
    values = np.concatenate((values, listed[::3_000_001], np.nextafter(listed[::5_000_011], -math.inf), np.nextafter(listed[1::5_000_011], math.inf)))
    at = np.clip(np.searchsorted(listed, values, side="right") - 1, 0, len(listed) - 1)
    want = np.where((values < listed[0]) | (values >= listed[-1]), MAX, listed[at])
    want = np.where(np.isnan(values), listed[-1], want)
    df = _frame(spark, values.tolist())
    out = H.assign_bins(df, "x", edges)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert [r.bin for r in out.orderBy("i").collect()] == want.tolist()
    assert [r.bin for r in df.select("i", histogram_bin_udf(edges)(F.col("x")).alias("bin")).orderBy("i").collect()] == want.tolist()
    counts = {r.bin: r.n for r in H.histogram_edges(df, "x", edges).collect()}
    assert counts == dict(zip(*(c.tolist() for c in np.unique(want, return_counts=True))))
    some = edges.frame(spark).where("i % 6000001 = 5").collect()
    assert all(r.edge == listed[r.i] for r in some) and len(some) > 10


def test_edges_that_cannot_move():
    with pytest.raises(ValueError, match="resolution"):
        Edges.accumulated(1e16, 0.5, 1e16 + 64)


def test_fd_width_rule(spark):
    values = [float(v) for v in range(1, 101)] + [None, float("nan")]
    b = H.fd_binning(_frame(spark, values), "x")
    assert (b.n, b.n_valid, b.min, b.max, b.q1, b.q3) == (102, 100, 1.0, 100.0, 25.0, 75.0)
    assert b.width == pytest.approx(2 * 50 / math.cbrt(102))      # n counts every row


def test_histogram_fd_keeps_every_valid_row(spark):
    values = [float(v % 37) * 1.25 for v in range(500)] + [None, float("nan")]
    df = _frame(spark, values)
    rows = H.histogram_fd(df, "x").collect()
    assert sum(r.n for r in rows) == 500
    assert all(r.bin_lo < r.bin_hi for r in rows)
    approx = H.histogram_fd(df, "x", quantiles="approx").collect()
    assert sum(r.n for r in approx) == 500


@pytest.mark.parametrize("values,expected", [
    ([], []),
    ([3.0], [(0, 3.0, 3.0, 1)]),
    ([2.0, 2.0, 2.0], [(0, 2.0, 2.0, 3)]),
    ([1.0] * 10 + [5.0], [(0, 1.0, 5.0, 11)]),                    # IQR 0
    ([None, float("nan")], []),
])
def test_histogram_fd_degenerate(spark, values, expected):
    df = spark.createDataFrame([(x,) for x in values], "x double")
    assert [tuple(r) for r in H.histogram_fd(df, "x").collect()] == expected


def test_histogram_plan_has_no_join_and_partial_aggregate(spark):
    df = _frame(spark, [float(i) for i in range(1000)])
    lazy = H.histogram_fd(df, "x", materialize=False)
    plan = lazy._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan
    assert "partial_count" in plan
    kept = H.histogram_fd(df, "x")
    assert "Join" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, lazy.collect()))


def test_column_histograms_equal_single_histograms(spark):
    import random
    rnd = random.Random(3)
    rows = [(rnd.gauss(5, 2), rnd.random() * 100 if i % 7 else None, 4.0, float(i % 13))
            for i in range(3000)] + [(float("nan"), 1.0, 4.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    cols = ["a", "b", "c", "d"]
    multi = H.column_histograms(df, cols).collect()
    for c in cols:
        single = sorted(tuple(r) for r in H.histogram_fd(df, c).collect())
        assert sorted(tuple(r)[1:] for r in multi if r.variable == c) == single, c
    with pytest.raises(ValueError):
        H.column_histograms(df, [])


def test_histogram_bins_finite_values_only(spark):
    values = [float(v % 37) for v in range(500)]
    inf = float("inf")
    df = _frame(spark, values + [inf, -inf, None, float("nan")])
    b = H.fd_binning(df, "x")
    assert (b.n, b.n_valid, b.min, b.max) == (504, 500, 0.0, 36.0)
    rows = H.histogram_fd(df, "x").collect()
    assert sum(r.n for r in rows) == 500
    multi = H.column_histograms(df, ["x"]).collect()
    assert sorted(tuple(r)[1:] for r in multi) == sorted(map(tuple, rows))


def test_width_below_resolution_is_a_clear_error(spark):
    values = [1e-15 * i for i in range(998)] + [1e10, 2e10]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    with pytest.raises(ValueError, match="resolution"):
        H.histogram_fd(df, "x")
    with pytest.raises(ValueError, match="resolution"):
        H.column_histograms(df, ["x"])


def test_sql_function_has_no_python_in_its_plan(spark):
    from mesonlab.plans.queries import QUERIES
    from tests.conftest import SF_SMALL
    fast, user = (QUERIES[n](spark, SF_SMALL) for n in ("sql_function", "udf3_sql"))
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SQRT" in plan and "Python" in user._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, user.collect()))
    from mesonlab.functions.udfs import register_sql_function
    with pytest.raises(ValueError):
        register_sql_function(spark, "nothing", {}, "DOUBLE", "1")


def test_column_histograms_of_many_columns(spark, monkeypatch):
    """More columns than a scan takes are done in several; the result is the same."""
    df = spark.createDataFrame([(float(i % 17), float(i % 5) - 2, None if i % 3 else float(i)) for i in range(400)], "a double, b double, c double")
    whole = sorted(map(tuple, H.column_histograms(df, ["a", "b", "c"]).collect()))
    monkeypatch.setattr(H, "MOST_COLUMNS", 2)
    assert sorted(map(tuple, H.column_histograms(df, ["a", "b", "c"]).collect())) == whole
