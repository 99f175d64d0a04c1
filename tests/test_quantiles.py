import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from mesonlab.operators import stats as S


def disc(values, p):
    """percentile_disc over non-null, non-NaN values."""
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    if not v:
        return None
    return v[S.quantile_rank(len(v), p) - 1]


def frame(spark, values):
    return spark.createDataFrame([(x,) for x in values], "x double")


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def test_quantile_rank_rule():
    assert [S.quantile_rank(4, p) for p in (0.0, 0.25, 0.26, 0.5, 0.75, 1.0)] == [1, 1, 2, 2, 3, 4]
    assert S.quantile_rank(1, 0.5) == 1
    with pytest.raises(ValueError):
        S.quantile_rank(3, 1.5)


@pytest.mark.parametrize("buckets,fetch", [(None, 1 << 16), (2, 1), (4, 3), (64, 10)])
def test_exact_quantiles_multi_pass(spark, buckets, fetch):
    rnd = random.Random(5)
    values = [rnd.gauss(0, 1) * 10 ** rnd.randint(-3, 3) for _ in range(3000)]
    values += [None] * 20 + [float("nan")] * 7 + [42.0] * 1000      # nulls, NaN, a hot value
    got = S.exact_quantiles(frame(spark, values), "x", PROBS, buckets=buckets, fetch_limit=fetch)
    assert got == [disc(values, p) for p in PROBS]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.floats(allow_nan=True, allow_infinity=True, width=32), st.none()),
                min_size=0, max_size=40))
def test_exact_quantiles_property(spark, values):
    got = S.exact_quantiles(frame(spark, values), "x", PROBS, buckets=3, fetch_limit=2)
    assert got == [disc(values, p) for p in PROBS]


def test_exact_quantiles_extremes(spark):
    values = [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324, float("inf"), float("-inf"), float("inf")]
    got = S.exact_quantiles(frame(spark, values), "x", PROBS, buckets=4, fetch_limit=1)
    assert got == [disc(values, p) for p in PROBS]


def test_zero_error_is_exact_and_positive_error_bounded(spark):
    rnd = random.Random(11)
    values = [rnd.random() * 1000 for _ in range(20000)]
    df = frame(spark, values)
    assert S.approx_quantile(df, "x", PROBS, 0.0) == [disc(values, p) for p in PROBS]
    srt = np.sort(values)
    for p, q in zip(PROBS, S.approx_quantile(df, "x", PROBS, 0.01)):
        rank = np.searchsorted(srt, q, side="right")
        assert abs(rank - p * len(values)) <= 0.01 * len(values) + 1


def test_describe_and_summary(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0])
    d = {r.summary: r.x for r in S.numeric_stats_table(S.describe(df, "x"), ["x"]).collect()}
    assert d == {"count": 4.0, "mean": 2.5, "stddev": round(np.std([1, 2, 3, 4], ddof=1), 6), "min": 1.0, "max": 4.0}
    s = S.summary(df).collect()
    assert [r.summary for r in s] == list(S.DEFAULT_SUMMARY)
    with pytest.raises(ValueError):
        S.describe(df)


def test_sql_double_literals_round_trip(spark):
    values = [0.1, -0.0, 5e-324, -1.7976931348623157e308, 1 / 3, 873.856104493017, 1e22, 123456789.125]
    row = spark.range(1).select(*[F.expr(S.sql_double(v)).alias(f"c{i}") for i, v in enumerate(values)]).first()
    assert list(row) == values
    with pytest.raises(ValueError):
        S.sql_double(float("nan"))


def test_input_keeps_its_partitions_and_is_exact(spark):
    rnd = random.Random(17)
    values = [rnd.expovariate(0.01) for _ in range(5000)] + [None] * 9
    df = frame(spark, values).repartition(100)           # far more partitions than cores
    with S.KeptValues(df, "x") as kept:
        row = kept.stats()
        assert row["n"] == len(values) and row["n_valid"] == 5000
        assert kept.frame.rdd.getNumPartitions() == 100 > 4 * S.cores(spark)
        got = S.select_quantiles(kept.frame, [("v", row["n_valid"], row["lo"], row["hi"], p) for p in PROBS],
                                 buckets=16, fetch_limit=50)
    assert got == [disc(values, p) for p in PROBS]


def test_bucket_count_follows_interval_rows(spark):
    # 3000 rows with fetch_limit 10 need 300 buckets -> 512 (a power of two);
    # the result is exact whatever the count
    rnd = random.Random(23)
    values = [rnd.random() for _ in range(3000)]
    assert S.exact_quantiles(frame(spark, values), "x", PROBS, fetch_limit=10) == [disc(values, p) for p in PROBS]


def test_bucket_budget():
    many = 1 << 30
    assert S._pass_size(32, 2, many) == (4096, 32)           # small cluster: the cap
    assert S._pass_size(32_000, 2, many) == (512, 32_000)    # 1000 executors x 8 cores x 4
    assert S._pass_size(100, 1, many) == (4096, 100)
    for parts, intervals in ((1, 1), (800_000, 2), (800_000, 22), (10 ** 9, 10), (10_000_000, 200), (2000, 1)):
        buckets, tasks = S._pass_size(parts, intervals, many)
        assert 1 <= tasks <= parts and buckets >= S.LEAST_BUCKETS
        assert buckets * intervals * tasks <= S.SHUFFLE_ROW_BUDGET


@pytest.mark.parametrize("shape", ["uniform", "lognormal", "wide", "signed"])
def test_passes_do_not_follow_the_dynamic_range(spark, monkeypatch, shape):
    rng = np.random.default_rng(3)
    x = {"uniform": lambda: rng.random(200_000), "lognormal": lambda: rng.lognormal(0, 10, 200_000),
         "wide": lambda: 10.0 ** rng.uniform(-300, 300, 200_000),
         "signed": lambda: 10.0 ** rng.uniform(-300, 300, 200_000) * rng.choice([-1, 1], 200_000)}[shape]()
    passes = []
    real = S.bucket_pass
    monkeypatch.setattr(S, "bucket_pass", lambda *a: passes.append(1) or real(*a))
    df = spark.createDataFrame(pd.DataFrame({"v": x}))
    got = S.exact_quantiles(df, "v", [0.25, 0.5, 0.75], fetch_limit=4096)
    order = np.sort(x)
    assert got == [order[int(np.ceil(p * len(x))) - 1] for p in (0.25, 0.5, 0.75)]
    assert len(passes) <= 4


@pytest.mark.parametrize("parts,budget", [(2000, 300_000), (2000, 20_000), (50, 1 << 30)])
def test_a_pass_stays_within_its_shuffle_budget(spark, monkeypatch, parts, budget):
    """The rows that leave the tasks of every pass, counted as Spark's partial aggregate makes
    them: one per task, interval and bucket."""
    monkeypatch.setattr(S, "SHUFFLE_ROW_BUDGET", budget)
    sent, plain = [], S.bucket_pass

    def counted(frame, intervals, needs, buckets):
        rows = S._tag(frame, intervals, buckets).withColumn("task", F.spark_partition_id())
        sent.append((rows.groupBy("task", "g", "b").count().count(), buckets))
        return plain(frame, intervals, needs, buckets)
    monkeypatch.setattr(S, "bucket_pass", counted)
    values = np.random.default_rng(3).lognormal(sigma=3, size=60_000)
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(parts)
    got = S.exact_quantiles(df, "x", [0.25, 0.5, 0.75], fetch_limit=500)
    assert got == [disc(values.tolist(), p) for p in (0.25, 0.5, 0.75)]
    assert sent and all(n <= budget for n, _ in sent), sent

