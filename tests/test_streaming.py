import pytest
from pyspark.sql import functions as F

from mesonlab.functions.kinematics import with_momentum
from mesonlab.operators.histogram import histogram_edges, histogram_fd
from mesonlab.plans.queries import KEYED_SCHEMA
from mesonlab.sources.candidates import candidates_from_lineitem, table
from mesonlab import streaming as S
from mesonlab.sources import writers as W
from tests.conftest import SF_SMALL
from tests.test_io import _lineitem


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_stream_equals_batch_over_two_runs(spark, tmp_path):
    """Files added between two runs are processed once, without another copy of the input."""
    cand = candidates_from_lineitem(spark, SF_SMALL)
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for part in (0, 1):
        cand.where(F.col("l_linenumber") % 2 == part).write.mode("append").json(source)
        got = S.run(S.momentum_stream(S.candidate_stream(spark, source, KEYED_SCHEMA, 1)), sink, checkpoint)
    batch = with_momentum(cand, "H1_").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "H1_P2", "H1_P")
    assert rows(got) == rows(batch)
    again = S.run(S.momentum_stream(S.candidate_stream(spark, source, KEYED_SCHEMA, 1)), sink, checkpoint)
    assert again.count() == batch.count()


def test_a_replayed_batch_leaves_no_double_rows(spark, tmp_path):
    """A crash after a batch's files were written, but before its commit: it is run again."""
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "progress"))
    spark.range(100).select(F.col("id").cast("string").alias("value")).coalesce(1).write.text(source)
    first = S.run(S.line_stream(spark, source), sink, checkpoint)
    assert first.count() == 100
    for mark in (tmp_path / "progress" / "commits").glob("*0*"):
        mark.unlink()
    assert rows(S.run(S.line_stream(spark, source), sink, checkpoint)) == rows(spark.read.text(source))


def test_failing_batch_is_surfaced_and_resumed(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "progress"))
    spark.range(30).select(F.col("id").cast("string").alias("value")).repartition(3).write.text(source)
    seen = []

    def put(batch, number):
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")
        seen.append(number)
        if len(seen) == 2:
            raise RuntimeError("lost after writing")
    with pytest.raises(Exception, match="lost after writing"):
        S.run_available(S.start(S.line_stream(spark, source, 1), sink, checkpoint, put))
    assert S.run(S.line_stream(spark, source, 1), sink, checkpoint).count() == 30


def test_histogram_of_a_stream_keeps_its_state(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "progress"))
    values = [None, float("nan"), -1.0, 0.0, 0.5, 1.0, 2.5, 3.0, 99.0]
    edges = [0.0, 1.0, 2.0, 3.0]
    df = spark.createDataFrame([(v,) for v in values * 7], "x double")
    assert S.read_histogram(spark, sink).count() == 0
    for part in range(3):
        df.where(F.coalesce(F.pmod(F.floor("x"), F.lit(3)), F.lit(0)) == part).repartition(2).write.mode("append").parquet(source)
        stream = S.candidate_stream(spark, source, "x double", 1, "parquet")
        S.run_available(S.start_histogram(stream, "x", edges, sink, checkpoint))
        present = spark.read.schema("x double").parquet(source)
        assert rows(S.read_histogram(spark, sink)) == rows(histogram_edges(present, "x", edges))


def test_line_stream_of_a_table(spark, tmp_path):
    from mesonlab.plans.queries import QUERIES
    lines = QUERIES["stream_lines"](spark, SF_SMALL)
    assert lines.columns == ["value"]
    assert lines.count() == table(spark, SF_SMALL, "documents").count()
    assert lines.where("value LIKE '%\\n%'").count() == 0


def test_background_query_lifecycle(spark, tmp_path):
    cand = candidates_from_lineitem(spark, SF_SMALL)
    source = str(tmp_path / "in")
    cand.limit(100).write.json(source)
    stream = with_momentum(S.candidate_stream(spark, source, KEYED_SCHEMA), "H1_")
    query = S.start(stream, str(tmp_path / "out"), str(tmp_path / "progress"), every="200 milliseconds", name="live_momentum")
    handle = S.watch(query)
    query.processAllAvailable()
    assert handle.running
    assert S.read_sink(spark, str(tmp_path / "out"), stream.schema).count() == 100
    handle.stop()
    assert not handle.running and not query.isActive and handle.error is None


def test_histogram_fd_refuses_a_stream(spark, tmp_path):
    candidates_from_lineitem(spark, SF_SMALL).limit(10).write.json(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        histogram_fd(S.candidate_stream(spark, str(tmp_path / "in"), KEYED_SCHEMA), "H1_PX")


def _run_on_files(spark, tmp_path, monkeypatch, name, sf_dir, most):
    """(rows, most rows of an arrived file, arrived files, micro-batches) of a query whose
    files hold ``most`` rows at most."""
    from mesonlab.plans import queries as P
    monkeypatch.setattr(W, "FILE_ROWS", most, raising=False)
    monkeypatch.setattr(P, "scratch_path", lambda spark, kind: str(tmp_path / "scratch" / kind))
    got = rows(P.QUERIES[name](spark, sf_dir))
    (source,) = (f for f in (tmp_path / "scratch").iterdir() if f.name in ("binned", "arriving", "line-stream-in"))
    per_file = spark.read.text(str(source)).groupBy(F.input_file_name()).count().agg(F.max("count"), F.count("count")).first()
    (commits,) = (tmp_path / "scratch").glob("*checkpoint/commits")
    return got, *per_file, len([f for f in commits.iterdir() if f.name.isdigit()])


def test_stream_histogram_spreads_its_files(spark, tmp_path, monkeypatch):
    """Not three files (and tasks) a part, however large the table; a small one has several
    micro-batches a run too."""
    from mesonlab.plans.queries import QUERIES
    sf_dir = _lineitem(spark, tmp_path / "in", 4000)
    want = rows(QUERIES["histogram_edges"](spark, sf_dir))
    for most in (100, 500_000):
        got, largest, files, batches = _run_on_files(spark, tmp_path / str(most), monkeypatch, "stream_histogram", sf_dir, most)
        assert got == want
        assert largest <= min(most, 501) and files >= 4000 / min(most, 1000) and 4 <= batches <= 6


def test_stream_quarantine_spreads_its_files(spark, tmp_path, monkeypatch):
    spark.range(3000).selectExpr("id AS o_orderkey", "id * 1.5D AS o_totalprice", "'O' AS o_orderstatus").coalesce(1).write.parquet(str(tmp_path / "in" / "orders.parquet"))
    got, largest, files, batches = _run_on_files(spark, tmp_path, monkeypatch, "stream_quarantine", str(tmp_path / "in"), 100)
    bad = sum(i % 7 == 0 or i % 11 == 0 for i in range(3000))
    assert [r.split(",")[:2] for r in got] == [["('good'", f" {3000 - bad}"], ["('quarantined'", f" {bad}"]]
    assert largest <= 100 and files >= 30 and 4 <= batches <= 6


def test_stream_restart_has_bounded_files_and_few_batches(spark, tmp_path, monkeypatch):
    """A run's micro-batches don't grow in number with the table, nor its files in size."""
    sf_dir = _lineitem(spark, tmp_path / "in", 4000)
    got, largest, files, batches = _run_on_files(spark, tmp_path, monkeypatch, "stream_restart", sf_dir, 100)
    batch = with_momentum(candidates_from_lineitem(spark, sf_dir), "H1_").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "H1_P2", "H1_P")
    assert got == rows(batch)
    assert largest <= 100 and files >= 40 and 3 <= batches <= 8
    names = [f.name for f in (tmp_path / "scratch" / "arriving").glob("part-*")]
    assert all(n.endswith(".gz") for n in names)
