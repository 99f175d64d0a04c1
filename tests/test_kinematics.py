import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mesonlab.functions import kinematics as K
from mesonlab.functions.selection import b_candidate_selection, strict_kaon_selection
from mesonlab.sources.candidates import CANDIDATE_COLUMNS, candidates_from_lineitem
from tests.conftest import SF_CHECK, SF_SMALL


def test_sum_cols_and_squares(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    r = df.select(K.sum_cols(["a", "b", "c"]).alias("s"), K.sum_squares(["a", "b", "c"]).alias("q")).first()
    assert (r.s, r.q) == (6.0, 14.0)
    with pytest.raises(ValueError):
        K.sum_cols([])


def test_square_equals_pow(spark):
    # x * x is bit-identical to pow(x, 2.0), the reference's formulation
    df = candidates_from_lineitem(spark, SF_SMALL)
    bad = df.where(F.col("H1_PZ") * F.col("H1_PZ") != F.pow("H1_PZ", F.lit(2.0))).count()
    assert bad == 0


def test_b_mass_column_order_and_values(spark):
    df = candidates_from_lineitem(spark, SF_SMALL, keys=False)
    out = K.with_b_mass(df)
    assert out.columns == CANDIDATE_COLUMNS + K.B_MASS_COLUMNS
    rows = out.limit(50).collect()
    m2 = K.KAON_MASS_MEV * K.KAON_MASS_MEV
    for r in rows:
        e = sum(math.sqrt(m2 + r[h + "PX"] ** 2 + r[h + "PY"] ** 2 + r[h + "PZ"] ** 2) for h in ("H1_", "H2_", "H3_"))
        px = sum(r[h + "PX"] for h in ("H1_", "H2_", "H3_"))
        py = sum(r[h + "PY"] for h in ("H1_", "H2_", "H3_"))
        pz = sum(r[h + "PZ"] for h in ("H1_", "H2_", "H3_"))
        assert r.B_M == pytest.approx(math.sqrt(e * e - (px * px + py * py + pz * pz)), rel=1e-9)
        assert r.H1_E >= r.H1_P and r.B_E >= r.B_P


def test_mass_invariant_under_hadron_swap(spark):
    df = candidates_from_lineitem(spark, SF_SMALL, keys=False)
    a = K.with_b_mass(df, daughters=("H1_", "H2_", "H3_")).select("B_M").collect()
    b = K.with_b_mass(df, daughters=("H3_", "H1_", "H2_")).select("B_M").collect()
    assert np.allclose([r[0] for r in a], [r[0] for r in b], rtol=1e-9, atol=0)


def test_nulls_propagate_and_negative_radicand_is_nan(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, 2.0)], "e double, p2 double")
    r = df.select(K.invariant_mass(F.col("e"), F.col("p2")).alias("m")).collect()
    assert r[0].m is None
    assert math.isnan(r[1].m)


def test_selection_counts_match_fixture(spark):
    df = K.with_b_mass(candidates_from_lineitem(spark, SF_CHECK))
    assert df.where(b_candidate_selection()).count() == 37180
    assert df.where(strict_kaon_selection()).count() == 27
    assert df.where(F.isnan("B_M")).count() == 0


def test_selection_pushes_to_scan(spark):
    df = K.with_b_mass(candidates_from_lineitem(spark, SF_SMALL)).where(b_candidate_selection()).select("B_M")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "IsNotNull(l_quantity)" in plan
    # only the lineitem columns the mass and the cut need are read
    assert "l_returnflag" not in plan and "l_shipdate" not in plan
