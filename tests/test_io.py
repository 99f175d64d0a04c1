import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from mesonlab.sources import readers as R, writers as W
from mesonlab.sources.candidates import CANDIDATE_COLUMNS, CANDIDATE_SCHEMA, read_candidates
from mesonlab.sources.catalog import DATASETS, load_dataset
from mesonlab.session import scratch_path
from tests.conftest import SF_SMALL


def test_camel_options():
    assert R.camel_options({"infer_schema": True, "date-format": "x", "header": 1}) == {
        "inferSchema": True, "dateFormat": "x", "header": 1}


def test_save_modes(spark):
    df = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    path = scratch_path(spark, "t-modes")
    W.write_parquet(df, path)
    with pytest.raises(AnalysisException):
        W.write_parquet(df, path)                      # default: error if exists
    with pytest.raises(AnalysisException):
        W.write_parquet(df, path, mode="error")
    W.write_parquet(df, path, mode="ignore")
    assert spark.read.parquet(path).count() == df.count()
    W.write_parquet(df, path, mode="append")
    assert spark.read.parquet(path).count() == 2 * df.count()
    W.write_parquet(df, path, mode="overwrite")
    assert spark.read.parquet(path).count() == df.count()
    with pytest.raises(ValueError):
        W.write_parquet(df, path, mode="upsert")
    with pytest.raises(ValueError):
        W.write_parquet(df, "")


def test_partitioned_write_prunes_partitions(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_returnflag", "l_shipdate")
    path = scratch_path(spark, "t-part")
    W.write_parquet(li, path, partition_by=["l_returnflag"], sort_by=["l_shipdate"])
    back = spark.read.parquet(path).where(F.col("l_returnflag") == "A")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(l_returnflag" in plan
    assert back.count() == li.where(F.col("l_returnflag") == "A").count()


def test_rebalanced_partitioned_write(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_returnflag")
    path = scratch_path(spark, "t-rebal")
    W.write_parquet(li, path, partition_by=["l_returnflag"], rebalance=True)
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.select("l_orderkey", "l_returnflag").collect())) == sorted(map(tuple, li.collect()))


def test_json_permissive_reading(spark):
    path = scratch_path(spark, "t-json")
    os.makedirs(path)
    with open(os.path.join(path, "part.json"), "w") as f:
        f.write(json.dumps({"B_VertexChi2": 1.5, "H1_PX": 2.0, "H1_Charge": 1}) + "\n")
        f.write("{not json\n")
        f.write(json.dumps({"B_VertexChi2": "oops", "H1_PX": 3.0}) + "\n")
    rows = read_candidates(spark, path, fmt="json").collect()
    assert len(rows) == 3
    assert rows[0].B_VertexChi2 == 1.5 and rows[0].H2_PX is None      # missing field -> null
    assert all(v is None for v in rows[1])                             # malformed line -> null row
    assert rows[2].B_VertexChi2 is None                                # wrong type -> null


def test_csv_with_schema_and_multi_path(spark):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    a, b = scratch_path(spark, "t-csv-a"), scratch_path(spark, "t-csv-b")
    nation.where("n_nationkey < 10").write.option("header", True).csv(a)
    nation.where("n_nationkey >= 10").write.option("header", True).csv(b)
    back = R.read_csv(spark, a, b, options={"header": True,
                                            "schema": "n_nationkey int, n_name string, n_regionkey int"})
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, nation.collect()))
    with pytest.raises(ValueError):
        R.read_csv(spark)


def test_jdbc_requires_credentials(spark):
    with pytest.raises(ValueError):
        R.read_jdbc(spark, "jdbc:none:x", "t", {"user": "u"})
    with pytest.raises(ValueError):
        R.read_jdbc(spark, "jdbc:none:x", "t", {"password": "p"})
    with pytest.raises(ValueError):
        R.read_jdbc(spark, "jdbc:none:x", "t", {"user": "u", "password": "p"}, partition_column="id")


def test_catalog(spark):
    ws = scratch_path(spark, "t-ws")
    df = spark.createDataFrame([tuple([1.0, 2.0] + [None] * (len(CANDIDATE_COLUMNS) - 2))], CANDIDATE_SCHEMA)
    df.write.parquet(f"{ws}/{DATASETS['magnet-up']}")
    assert load_dataset(spark, ws, "magnet-up").columns == CANDIDATE_COLUMNS
    with pytest.raises(ValueError):
        load_dataset(spark, ws, "magnet-sideways")


def test_histogram_sink_single_file(spark):
    hist = spark.createDataFrame([(0, 1.0, 2.0, 3)], "bin bigint, bin_lo double, bin_hi double, n bigint")
    path = scratch_path(spark, "t-hist")
    W.write_histogram(hist, path)
    assert len([f for f in os.listdir(path) if f.endswith(".json")]) == 1


def test_run_spectrum_and_cli_args(spark):
    from mesonlab.__main__ import parse
    from mesonlab.plans.spectrum import run_spectrum
    from mesonlab.sources.candidates import candidates_from_lineitem
    ws = scratch_path(spark, "t-spectrum")
    candidates_from_lineitem(spark, SF_SMALL, keys=False).write.parquet(f"{ws}/{DATASETS['magnet-down']}")
    hist = run_spectrum(spark, ws, "magnet-down", selection=True)
    back = spark.read.json(f"{ws}/b-mass-histogram.json")
    assert sorted(map(tuple, back.select("bin", "bin_lo", "bin_hi", "n").collect())) == \
        sorted(map(tuple, hist.collect()))
    args = parse(["--workspace", ws, "--dataset", "simulation", "--no-selection"])
    assert args.selection is False and args.quantiles == "exact"
    with pytest.raises(SystemExit):
        parse(["--workspace", ws, "--dataset", "magnet-sideways"])


def test_bucketed_tables_join_and_group_without_exchange(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") % 700).alias("k"), F.col("id").alias("v"))
    for name in ("bucketed_a", "bucketed_b"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        W.write_bucketed(df, name, 8, ["k"], ["k", "v"], path=str(tmp_path / name))
    a, b = spark.table("bucketed_a"), spark.table("bucketed_b")
    joined = a.hint("merge").join(b.groupBy("k").agg(F.sum("v").alias("s")), "k")
    rows = joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan, plan
    assert len(rows) == 5000 and sum(r.s for r in rows) == sum(x * y for x, y in [(r.n, r.s) for r in df.groupBy("k").agg(F.count("v").alias("n"), F.sum("v").alias("s")).collect()])
    assert len(list((tmp_path / "bucketed_a").glob("*.parquet"))) <= 8
    assert W.bucketing(spark, "bucketed_a").collect() == [(8, ["k"], ["k", "v"])]
    W.write_bucketed(df, "bucketed_a", 8, ["k"], ["k", "v"], path=str(tmp_path / "bucketed_a"), mode="append")
    assert spark.table("bucketed_a").count() == 10_000
    with pytest.raises(ValueError):
        W.write_bucketed(df, "bucketed_c", 0, ["k"])
    with pytest.raises(ValueError):
        W.write_bucketed(df, "bucketed_c", 4, [])
    spark.sql("CREATE TABLE plain_t USING parquet AS SELECT 1 AS x")
    assert W.bucketing(spark, "plain_t").count() == 0
    for name in ("bucketed_a", "bucketed_b", "plain_t"):
        spark.sql(f"DROP TABLE {name}")


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    lines = ['{"a": 1, "b": "x"}', '{"a": 2}', '{"a": 3, "b": "y", "c": 4}', '{"a": "text", "b": "z"}', '{"a": 1, "b"', "no json", "", None, "[1]", '{"a": 1.5}', "{}"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good, bad = (str(tmp_path / n) for n in ("good", "bad"))
    R.split_malformed(df, "a bigint, b string", good, bad)
    kept = {tuple(r) for r in spark.read.parquet(good).collect()}
    put = [r.value for r in spark.read.parquet(bad).collect()]
    assert kept == {(1, "x"), (2, None), (3, "y"), (None, None)}
    assert spark.read.parquet(good).count() + len(put) == len(lines)
    assert {'{"a": "text", "b": "z"}', '{"a": 1, "b"', "no json", None} <= set(put)


def test_histogram_sink_keeps_ranges_of_bins_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "FILE_BINS", 100)
    hist = spark.range(1000).select(F.col("id").alias("bin"), F.lit(0.0).alias("bin_lo"), F.lit(1.0).alias("bin_hi"), F.lit(1).cast("long").alias("n"))
    W.write_histogram(hist.repartition(7), str(tmp_path / "h"))
    files = spark.read.schema(hist.schema).json(str(tmp_path / "h")).groupBy(F.input_file_name()).agg(F.min("bin").alias("lo"), F.max("bin").alias("hi"), F.count("bin").alias("n")).collect()
    assert len(files) > 5 and all(r.hi - r.lo + 1 == r.n for r in files)


def test_json_is_compressed_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "FILE_ROWS", 1000, raising=False)
    df = spark.range(7000).select("id", (F.col("id") / 7).alias("a_long_name"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("another_name")).coalesce(2)
    path = str(tmp_path / "rows")
    W.write_json(df, path)
    df.write.json(str(tmp_path / "plain"))

    def size(at):
        return sum(f.stat().st_size for f in (tmp_path / at).glob("part-*"))
    assert size("rows") < 0.4 * size("plain")
    back = R.read_json(spark, path, options={"schema": df.schema})
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    assert back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 1000
    with pytest.raises(AnalysisException):
        W.write_json(df, path)
    with pytest.raises(ValueError):
        W.write_json(df, path, mode="upsert")
    W.write_json(df, path, mode="append", options={"compression": "none", "max_records_per_file": 0})
    assert R.read_json(spark, path, options={"schema": df.schema}).count() == 14_000
    assert list((tmp_path / "rows").glob("*.json")) and list((tmp_path / "rows").glob("*.json.gz"))


def _lineitem(spark, folder, rows):
    spark.range(rows).selectExpr(
        "id AS l_orderkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber", "id % 13 AS l_partkey", "id % 5 AS l_suppkey", "CAST(id % 50 + 7 AS DOUBLE) AS l_quantity",
        "900 + id * 1.37D AS l_extendedprice", "(id % 11) * 0.01D AS l_discount", "(id % 9) * 0.01D AS l_tax").coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["stream_momentum", "json_roundtrip", "candidate_scan"])
def test_queries_keep_their_json_copy_small(spark, tmp_path, monkeypatch, name):
    from mesonlab.plans import queries as P
    from mesonlab.sources.candidates import candidates_from_lineitem
    sf_dir = _lineitem(spark, tmp_path / "in", 3000)
    monkeypatch.setattr(P, "scratch_path", lambda spark, kind: str(tmp_path / "scratch" / kind))
    assert P.QUERIES[name](spark, sf_dir).count() == 3000
    candidates_from_lineitem(spark, sf_dir).write.json(str(tmp_path / "plain"))
    (copy,) = (tmp_path / "scratch").glob("*json")
    assert sum(f.stat().st_size for f in copy.glob("part-*")) < 0.4 * sum(f.stat().st_size for f in (tmp_path / "plain").glob("part-*"))
