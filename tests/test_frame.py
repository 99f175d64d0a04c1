import pytest
from pyspark.sql import functions as F

from mesonlab.operators import frame, stats
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet")


def test_empty_argument_lists_rejected(orders):
    for call in (lambda: frame.select(orders, []), lambda: frame.select_expr(orders, []),
                 lambda: frame.group_by(orders), lambda: frame.sort(orders),
                 lambda: stats.describe(orders)):
        with pytest.raises(ValueError):
            call()


def test_select_names_or_columns_and_where_forms(orders):
    assert frame.select(orders, ["o_orderkey"]).columns == ["o_orderkey"]
    assert frame.select(orders, [F.col("o_orderkey") + 1]).count() == orders.count()
    a = frame.where(orders, F.col("o_totalprice") > 1000).count()
    b = frame.where(orders, "o_totalprice > 1000").count()
    assert a == b


def test_take_frame_is_top_n(orders):
    top = frame.take_frame(orders, 5, F.col("o_totalprice").desc(), "o_orderkey")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert [r.o_totalprice for r in top.collect()] == sorted(
        [r.o_totalprice for r in orders.collect()], reverse=True)[:5]


def test_sample_keeps_seed(orders):
    a = sorted(r.o_orderkey for r in frame.sample(orders, 0.2, seed=7).collect())
    b = sorted(r.o_orderkey for r in frame.sample(orders, 0.2, seed=7).collect())
    assert a == b and 0 < len(a) < orders.count()
    with pytest.raises(ValueError):
        frame.sample(orders, 1.5)


def test_min_max_names(orders):
    assert frame.min_max(orders, "o_totalprice").columns == ["min(o_totalprice)", "max(o_totalprice)"]


def test_sample_by_keys_is_the_same_in_any_partitioning(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("n"))
    rows = {p: sorted(map(repr, frame.sample_by_keys(df.repartition(p), 0.3, ["k", "n"], 4).collect())) for p in (1, 200)}
    assert rows[1] == rows[200] and 5400 < len(rows[1]) < 6600
    assert rows[1] != sorted(map(repr, frame.sample_by_keys(df, 0.3, ["k", "n"], 5).collect()))
    whole = frame.sample_by_keys(df, 0.3, ["k"]).groupBy("k").count()
    assert whole.where("count <> 4").count() == 0  # rows with equal keys go together
    assert frame.sample_by_keys(df, 0.0, ["k"]).count() == 0 and frame.sample_by_keys(df, 1.0, ["k"]).count() == 20_000
    with pytest.raises(ValueError):
        frame.sample_by_keys(df, 0.5, [])
