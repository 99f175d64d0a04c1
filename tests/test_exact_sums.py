"""Exact sums against math.fsum, which rounds the exact sum once."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mesonlab.operators.exactsum import exact_sums

INF, NAN = math.inf, math.nan


def check(spark, values, parts=5):
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "g int, x double").repartition(parts)
    got = {r.g: r.s for r in exact_sums(df, ["g"], {"s": "x"}).collect()}
    for g in {i % 2 for i in range(len(values))}:
        own = [v for v in values[g::2] if v is not None]
        want = None if not own else NAN if any(map(math.isnan, own)) or {INF, -INF} <= set(own) else math.fsum(own)
        assert got[g] == want or math.isnan(want) and math.isnan(got[g]), (got[g], want)


@pytest.mark.parametrize("values", [
    [1e300, 1e-300, -1e300, 5e-324, 1e-300, 1.5], [0.1] * 1000, [2.0 ** 53, 1.0, 1.0, 1.0] * 30, [0.0, -0.0, None], [None, None, 1.0],
    [INF, 1.0, 2.0, -INF], [INF, INF, -INF, 1.0], [NAN, 1.0, 2.0, 3.0], [1.7e308, 1.7e308, -1.7e308, -1.7e308, 1e-320, 1.0]])
def test_values(spark, values):
    check(spark, values)


def test_sum_out_of_range_and_empty(spark):
    df = spark.createDataFrame([(1, 1.7e308), (1, 1.7e308), (2, -1.7e308), (2, -1.7e308)], "g int, x double")
    assert {r.g: r.s for r in exact_sums(df, ["g"], {"s": "x"}).collect()} == {1: INF, 2: -INF}
    assert exact_sums(df.limit(0), ["g"], {"s": "x"}).count() == 0
    assert exact_sums(df, [], {"s": "x"}, F.count(F.lit(1)).alias("n")).collect()[0].asDict() == {"s": 0.0, "n": 4}


def test_any_order_gives_the_same_sum(spark):
    rnd = random.Random(5)
    values = [rnd.gauss(0, 1) * 10 ** rnd.uniform(-300, 300) for _ in range(400)] + [rnd.uniform(-1, 1) * 2.0 ** -1060 for _ in range(50)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    sums = {exact_sums(df.repartition(n), [], {"s": "x"}).first().s for n in (1, 3, 50)}
    assert sums == {math.fsum(values)}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e306, 1e306)), min_size=1, max_size=30))
def test_any_doubles(spark, values):
    check(spark, values, 3)


def test_several_columns_names_and_other_aggregates(spark):
    df = spark.createDataFrame([("a", 0.1, 10), ("a", 0.2, 20), ("b", None, 5)], "k string, `x.y` double, n int")
    got = {r["k"]: tuple(r) for r in exact_sums(df, ["k"], {"sx": "x.y", "sn": "n"}, F.max("n").alias("top")).collect()}
    assert got == {"a": ("a", math.fsum([0.1, 0.2]), 30.0, 20), "b": ("b", None, 5.0, 5)}
