"""Registered queries: one per operator of the blueprint inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole input
tables (the candidate table is derived from ``lineitem`` row for row). Names
of computed columns match the SQL oracles in ``mesonlab.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesonlab.functions import kinematics as K
from mesonlab.functions.selection import b_candidate_selection, strict_kaon_selection
from mesonlab.functions import udfs
from mesonlab.operators import frame, histogram as H, sketches, stats as S
from mesonlab.operators.exactsum import exact_sums
from mesonlab.sources import candidates as C, readers as R, writers as W
from mesonlab.sources.catalog import DATASETS, load_dataset
from mesonlab.plans.spectrum import mass_spectrum
from mesonlab.session import scratch_path
from mesonlab.streaming import streams

KEYS = C.KEY_COLUMNS
Q = dict[str, Callable[[SparkSession, str], DataFrame]]


def _cand(spark, sf_dir) -> DataFrame:
    return C.candidates_from_lineitem(spark, sf_dir)


def _selected_mass(spark, sf_dir) -> DataFrame:
    """keys + B_M of candidates passing the B selection."""
    return K.with_b_mass(_cand(spark, sf_dir)).where(b_candidate_selection()).select(*KEYS, "B_M")


# ---- step 1: kinematics -----------------------------------------------------

def q_sum_cols(spark, sf_dir):
    return _cand(spark, sf_dir).select(*KEYS, K.sum_cols(["H1_PX", "H2_PX", "H3_PX"]).alias("px_sum"))


def q_sum_squares(spark, sf_dir):
    return _cand(spark, sf_dir).select(*KEYS, K.sum_squares(["H1_PX", "H1_PY", "H1_PZ"]).alias("p2_sum"))


def q_momentum(spark, sf_dir):
    return K.with_momentum(_cand(spark, sf_dir), "H1_").select(*KEYS, "H1_P2", "H1_P")


def q_energy(spark, sf_dir):
    return K.with_energy(_cand(spark, sf_dir), "H2_").select(*KEYS, "H2_E2", "H2_E")


def q_four_momentum(spark, sf_dir):
    return K.with_four_momentum(_cand(spark, sf_dir)).select(*KEYS, "B_PX", "B_PY", "B_PZ", "B_E")


def q_invariant_mass(spark, sf_dir):
    df = K.with_four_momentum(_cand(spark, sf_dir))
    p2 = K.sum_squares(["B_PX", "B_PY", "B_PZ"])
    return df.select(*KEYS, K.invariant_mass(F.col("B_E"), p2).alias("mass"))


def q_b_mass(spark, sf_dir):
    return K.with_b_mass(_cand(spark, sf_dir)).select(*KEYS, *K.B_MASS_COLUMNS)


# ---- step 2: selections and projections -------------------------------------

def q_candidate_selection(spark, sf_dir):
    return _selected_mass(spark, sf_dir)


def q_strict_selection(spark, sf_dir):
    return K.with_b_mass(_cand(spark, sf_dir)).where(strict_kaon_selection()).select(*KEYS, "B_M")


NARROW = ["H1_PX", "H1_PY", "H1_PZ", "H1_ProbK", "H2_PX", "H2_PY", "H2_PZ", "H2_ProbK",
          "H3_PX", "H3_PY", "H3_PZ", "H3_ProbK"]


def q_select_cols(spark, sf_dir):
    return frame.select(_cand(spark, sf_dir), KEYS + NARROW)


def q_select_expr(spark, sf_dir):
    return frame.select_expr(_cand(spark, sf_dir), [
        *KEYS,
        "H1_PX + H2_PX + H3_PX AS px_sum",
        "sqrt(H1_PX * H1_PX + H1_PY * H1_PY) AS h1_pt",
        "CASE WHEN H1_Charge + H2_Charge + H3_Charge > 0 THEN 'plus' ELSE 'minus' END AS b_charge",
    ])


def q_where_column(spark, sf_dir):
    return frame.where(_cand(spark, sf_dir), F.col("B_VertexChi2") >= 0.7).select(*KEYS, "B_VertexChi2")


def q_where_sql(spark, sf_dir):
    return frame.where(_cand(spark, sf_dir), "H1_ProbK >= 0.7 AND H3_ProbK >= 0.7").select(*KEYS, "H1_ProbK", "H3_ProbK")


def q_with_column(spark, sf_dir):
    df = frame.with_column(_cand(spark, sf_dir), "H1_PT",
                           F.sqrt(F.col("H1_PX") * F.col("H1_PX") + F.col("H1_PY") * F.col("H1_PY")))
    return df.select(*KEYS, "H1_PT")


# ---- step 3: aggregation and statistics -------------------------------------

def q_group_by_agg(spark, sf_dir):
    """Sums of doubles without any error, whatever the order of the rows."""
    li = C.table(spark, sf_dir, "lineitem")
    return exact_sums(li, ["l_returnflag", "l_linestatus"], {"sum_qty": "l_quantity", "sum_price": "l_extendedprice"},
                      F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"),
                      F.round(F.avg("l_discount"), 6).alias("avg_disc"))


def q_group_by(spark, sf_dir):
    """Grouping by name, for any aggregates of the caller."""
    return frame.group_by(C.table(spark, sf_dir, "lineitem"), "l_shipdate", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_suppkey").alias("suppliers"), F.max("l_tax").alias("max_tax"))


def q_exact_sums(spark, sf_dir):
    """Components whose exact sum needs many bits: momenta of both signs, scaled apart by
    powers of two."""
    scaled = _cand(spark, sf_dir).select(*KEYS, F.expr("H1_PX * IF(l_linenumber % 2 = 0, 1, 1.0D / 1099511627776.0D)").alias("px"))
    return exact_sums(scaled, ["l_linenumber"], {"sum_px": "px"}, F.count(F.lit(1)).alias("n"))


def q_row_count(spark, sf_dir):
    return frame.count_frame(K.with_b_mass(_cand(spark, sf_dir)).where(b_candidate_selection()))


def q_min_max(spark, sf_dir):
    return frame.min_max(_selected_mass(spark, sf_dir), "B_M")


STAT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


def q_describe(spark, sf_dir):
    li = C.table(spark, sf_dir, "lineitem")
    return S.numeric_stats_table(S.describe(li, *STAT_COLUMNS), STAT_COLUMNS)


STRING_COLUMNS = ["l_returnflag", "l_linestatus"]


def q_describe_strings(spark, sf_dir):
    """count, min and max of string columns; their mean and deviation are null."""
    return S.describe(C.table(spark, sf_dir, "lineitem"), *STRING_COLUMNS)


def q_summary_strings(spark, sf_dir):
    li = C.table(spark, sf_dir, "lineitem").select(*STRING_COLUMNS)
    return S.summary(li, "count", "min", "max")


SUMMARY_STATS = ("count", "mean", "stddev", "min", "max")


def q_summary(spark, sf_dir):
    li = C.table(spark, sf_dir, "lineitem")
    return S.numeric_stats_table(S.summary(li.select(*STAT_COLUMNS), *SUMMARY_STATS), STAT_COLUMNS)


# Spark's summary percentiles come from a GK sketch (relative error 1e-4). For
# these two columns every quartile rank lies hundreds of rows away from a
# change of value at every test scale, so the sketch's answer is the exact one.
PERCENTILE_COLUMNS = ["l_linenumber", "l_tax"]


def q_summary_percentiles(spark, sf_dir):
    li = C.table(spark, sf_dir, "lineitem").select(*PERCENTILE_COLUMNS)
    return S.numeric_stats_table(S.summary(li), PERCENTILE_COLUMNS)


QUANTILE_PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _quantile_frame(spark, probs, values):
    return spark.createDataFrame([(float(p), v) for p, v in zip(probs, values)], "p double, q double")


def q_approx_quantile(spark, sf_dir):
    """relative error 0: exact, computed by the distributed selection."""
    values = S.approx_quantile(_selected_mass(spark, sf_dir), "B_M", QUANTILE_PROBS, 0.0)
    return _quantile_frame(spark, QUANTILE_PROBS, values)


def q_approx_quantile_001(spark, sf_dir):
    """The reference's 0.01 relative error (GK sketch): rank within 1% of n."""
    values = S.approx_quantile(_selected_mass(spark, sf_dir), "B_M", QUANTILE_PROBS, 0.01)
    return _quantile_frame(spark, QUANTILE_PROBS, values)


def q_approx_quantile_bounds(spark, sf_dir):
    """Whether each value of ``approx_quantile_001`` has a rank within 1% of n: the wanted
    rank lies between the rows below the value and those up to it, give or take."""
    mass = _selected_mass(spark, sf_dir)
    values = S.approx_quantile(mass, "B_M", QUANTILE_PROBS, 0.01)
    x = F.col("B_M")
    aggs = [F.count(x).alias("n")]
    for i, v in enumerate(values):
        aggs += [F.count(F.when(x < v, 1)).alias(f"below{i}"), F.count(F.when(x <= v, 1)).alias(f"upto{i}")]
    rows = [F.struct(F.lit(p).alias("p"), ((F.col(f"below{i}") <= (p + 0.01) * F.col("n") + 1)
                                           & (F.col(f"upto{i}") >= (p - 0.01) * F.col("n") - 1)).alias("within"))
            for i, p in enumerate(QUANTILE_PROBS)]
    return mass.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.p", "r.within")


def q_exact_quantile(spark, sf_dir):
    li = C.table(spark, sf_dir, "lineitem")
    values = S.exact_quantiles(li, "l_extendedprice", QUANTILE_PROBS)
    return _quantile_frame(spark, QUANTILE_PROBS, values)


SKETCHED = ["l_extendedprice", "l_quantity", "l_tax"]


def _sketch_store(spark, sf_dir):
    """Sketches of two lots of files, the second one added to the store of the first."""
    files, store = scratch_path(spark, "sketched"), scratch_path(spark, "sketches")
    li = C.table(spark, sf_dir, "lineitem").select("l_linenumber", *SKETCHED)
    for part in (0, 1):
        li.where(F.col("l_linenumber") % 2 == part).repartition(4).write.mode("append").parquet(files)
        sketches.update_store(spark.read.parquet(files), SKETCHED, store)
    return li, sketches.read_store(spark, store)


def q_sketch_totals(spark, sf_dir):
    """What merged sketches know exactly: files, rows, values, the least and the greatest."""
    _, store = _sketch_store(spark, sf_dir)
    ends = sketches.sketch_quantiles(store, [0.0, 1.0]).groupBy("variable").agg(F.min("q").alias("lo"), F.max("q").alias("hi"))
    return sketches.merged(store).select("variable", "n", "n_valid").join(ends, "variable")


def q_sketch_quantile_bounds(spark, sf_dir):
    """Whether each quantile from merged sketches has a rank within 1% of n."""
    li, store = _sketch_store(spark, sf_dir)
    found = F.broadcast(sketches.sketch_quantiles(store, QUANTILE_PROBS))  # a row per column and probability
    values = li.select(F.expr(f"stack({len(SKETCHED)}, " + ", ".join(f"'{c}', {c}" for c in SKETCHED) + ") AS (variable, v)"))
    ranks = values.join(found, "variable").groupBy("variable", "p").agg(
        F.count("v").alias("n"), F.count_if(F.col("v") < F.col("q")).alias("below"), F.count_if(F.col("v") <= F.col("q")).alias("upto"))
    return ranks.select("variable", "p", ((F.col("below") <= (F.col("p") + 0.01) * F.col("n") + 1) & (F.col("upto") >= (F.col("p") - 0.01) * F.col("n") - 1)).alias("within"))


# ---- step 4: binning and histograms -----------------------------------------

def _mass_binning(spark, sf_dir):
    return H.fd_binning(_selected_mass(spark, sf_dir), "B_M")


def q_fd_binning(spark, sf_dir):
    b = _mass_binning(spark, sf_dir)
    return H.binning_frame(spark, b, len(H.bin_edges(b)))


def q_bin_edges(spark, sf_dir):
    return H.bin_edges(_mass_binning(spark, sf_dir)).frame(spark).select("i", F.round("edge", 6).alias("edge"))


def _round_bin(c="bin"):
    return F.when(F.col(c) == F.lit(H.SENTINEL), F.col(c)).otherwise(F.round(c, 6)).alias(c)


def q_bin_assign(spark, sf_dir):
    mass = _selected_mass(spark, sf_dir)
    edges = H.bin_edges(H.fd_binning(mass, "B_M"))
    return H.assign_bins(mass, "B_M", edges).select(*KEYS, "B_M", _round_bin())


def q_histogram_edges(spark, sf_dir):
    _, hist = H.fd_histogram_edges(_selected_mass(spark, sf_dir), "B_M")
    return hist.select(_round_bin(), "n")


def q_histogram_fd(spark, sf_dir):
    """Flagship: mass spectrum of the selected B candidates."""
    return mass_spectrum(_cand(spark, sf_dir), selection=True)


def q_histogram_fd_all(spark, sf_dir):
    """Mass spectrum of every candidate (the analysis without the selection)."""
    return mass_spectrum(_cand(spark, sf_dir), selection=False)


def q_histogram_fd_approx(spark, sf_dir):
    """Same spectrum with the reference's approximate quartiles (GK, 0.01)."""
    return H.histogram_fd(_selected_mass(spark, sf_dir), "B_M", quantiles="approx")


def q_column_histogram(spark, sf_dir):
    return H.column_histogram(_cand(spark, sf_dir), "H1_PX")


# The columns the exploration notebook histograms, one FD histogram each.
NOTEBOOK_COLUMNS = ["H1_PX", "H1_PY", "H1_PZ", "H1_P", "H2_E", "B_E", "B_PX", "B_PY", "B_PZ", "B_P", "B_M"]


def q_column_histograms(spark, sf_dir):
    return H.column_histograms(K.with_b_mass(_cand(spark, sf_dir)), NOTEBOOK_COLUMNS)


# ---- step 5: sort, take, first, sample --------------------------------------

def q_sort_take(spark, sf_dir):
    return frame.take_frame(_selected_mass(spark, sf_dir), 20, F.col("B_M").desc(), *KEYS)


def q_sort_all(spark, sf_dir):
    """Every selected mass in order."""
    return frame.sort(_selected_mass(spark, sf_dir), F.col("B_M").desc(), *KEYS)


def q_first_row(spark, sf_dir):
    return frame.take_frame(_selected_mass(spark, sf_dir), 1, *KEYS, "B_M")


def q_sample(spark, sf_dir):
    return frame.sample(_selected_mass(spark, sf_dir), 0.1, seed=7)


def q_sample_by_keys(spark, sf_dir):
    """A sample that doesn't depend on the partitions: a hash of the keys decides."""
    return frame.sample_by_keys(_selected_mass(spark, sf_dir).repartition(17), 0.1, KEYS, seed=7)


def q_sample_properties(spark, sf_dir):
    """Whether a sample holds rows of its source only, whether the same seed gives the same
    rows, and whether its size lies within five standard deviations of the expected one."""
    mass, fraction = _selected_mass(spark, sf_dir), 0.1
    one, two = (frame.sample(mass, fraction, seed=7) for _ in range(2))
    tagged = (mass.withColumn("part", F.lit("source")).unionByName(one.withColumn("part", F.lit("one")))
              .unionByName(two.withColumn("part", F.lit("two"))))
    rows = tagged.groupBy(*KEYS, "B_M").agg(*[F.count(F.when(F.col("part") == t, 1)).alias(t) for t in ("source", "one", "two")])
    n, size = F.sum("source"), F.sum("one")
    return rows.agg(F.bool_and(F.col("one") <= F.col("source")).alias("subset"),
                    F.bool_and(F.col("one") == F.col("two")).alias("same_seed_same_rows"),
                    (F.abs(size - n * fraction) <= 5 * F.sqrt(n * fraction * (1 - fraction))).alias("size_as_expected"))


# ---- step 6: sources and sinks ----------------------------------------------

KEYED_SCHEMA = ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, "
                + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in C.CANDIDATE_SCHEMA.fields))


def q_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    _cand(spark, sf_dir).write.option("header", "true").csv(path)
    return R.read_csv(spark, path, options={"header": True, "schema": KEYED_SCHEMA})


def q_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "json")
    W.write_json(_cand(spark, sf_dir), path)
    return R.read_json(spark, path, options={"schema": KEYED_SCHEMA})


def q_parquet_multi_path(spark, sf_dir):
    li = C.table(spark, sf_dir, "lineitem").select(*KEYS, "l_returnflag", "l_extendedprice")
    a, b = scratch_path(spark, "pq-a"), scratch_path(spark, "pq-b")
    W.write_parquet(li.where(F.col("l_returnflag") == "R"), a)
    W.write_parquet(li.where((F.col("l_returnflag") != "R") | F.col("l_returnflag").isNull()), b)
    return R.read_parquet(spark, a, b)


def q_parquet_partitioned(spark, sf_dir):
    li = C.table(spark, sf_dir, "lineitem").select(*KEYS, "l_returnflag", "l_shipdate", "l_extendedprice")
    path = scratch_path(spark, "pq-part")
    W.write_parquet(li, path, mode="overwrite", partition_by=["l_returnflag"], sort_by=["l_shipdate"],
                    rebalance=True)
    back = R.read_parquet(spark, path)
    return back.where(F.col("l_returnflag") == "A").select(*KEYS, "l_extendedprice", "l_returnflag")


def _bucketed(spark, sf_dir):
    """``orders`` and ``lineitem`` as tables bucketed and sorted by the order's key."""
    names = []
    for name, columns in (("orders", ["o_orderkey", "o_totalprice"]), ("lineitem", ["l_orderkey", "l_quantity"])):
        at = scratch_path(spark, f"bucketed-{name}")
        names.append(udfs.unique_name(name))
        W.write_bucketed(C.table(spark, sf_dir, name).select(*columns), names[-1], 16, columns[:1], columns[:1], path=at)
    return names


def q_bucketed_join(spark, sf_dir):
    """A join and a grouping on the bucket key: neither needs an exchange."""
    orders, lines = map(spark.table, _bucketed(spark, sf_dir))
    per_order = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("most"))
    return orders.hint("merge").join(per_order, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_totalprice", "n", "most")


def q_bucket_metadata(spark, sf_dir):
    return W.bucketing(spark, _bucketed(spark, sf_dir)[1]).select("buckets", F.array_join("bucket_columns", ",").alias("bucket_columns"),
                                                                  F.array_join("sort_columns", ",").alias("sort_columns"))


def _orders_as_lines(spark, sf_dir):
    """Orders as JSON lines: every seventh cut off, every eleventh with text for a number."""
    row = F.to_json(F.struct("o_orderkey", "o_totalprice", "o_orderstatus"))
    key = F.col("o_orderkey")
    line = F.when(key % 7 == 0, F.expr("left(line, length(line) - 9)")).when(key % 11 == 0, F.regexp_replace("line", '"o_totalprice":', '"o_totalprice":"x",')).otherwise(F.col("line"))
    return C.table(spark, sf_dir, "orders").withColumn("line", row).select(line.alias("value"))


ORDER_LINE = "o_orderkey bigint, o_totalprice double, o_orderstatus string"


def _quarantine_counts(good, bad):
    return (good.select(F.lit("good").alias("kind"), F.col("o_totalprice").alias("price")).unionByName(bad.select(F.lit("quarantined").alias("kind"), F.lit(None).cast("double").alias("price")))
            .groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.max("price").alias("max_price")))


def q_quarantine(spark, sf_dir):
    """Malformed JSON lines go to a sink of their own: good and quarantined are all lines."""
    source, good, bad = (scratch_path(spark, f"lines-{n}") for n in ("in", "good", "bad"))
    _orders_as_lines(spark, sf_dir).write.text(source)
    R.split_malformed(spark.read.text(source), ORDER_LINE, good, bad)
    return _quarantine_counts(spark.read.parquet(good), spark.read.parquet(bad))


def q_stream_quarantine(spark, sf_dir):
    """The same on a stream, over two runs."""
    source, good, bad, checkpoint = (scratch_path(spark, f"line-stream-{n}") for n in ("in", "good", "bad", "checkpoint"))
    most = _some_files(C.table(spark, sf_dir, "orders"))
    for part in (0, 1):
        _orders_as_lines(spark, sf_dir).where(F.length("value") % 2 == part).write.mode("append").option("maxRecordsPerFile", most).text(source)
        lines = streams.line_stream(spark, source, _files_per_batch(spark.read.text(source), 2 * (part + 1)))
        streams.run_available(streams.start_quarantine(lines, ORDER_LINE, good, bad, checkpoint))
    return _quarantine_counts(streams.read_sink(spark, good, ORDER_LINE), streams.read_sink(spark, bad, "value string"))


def q_save_modes(spark, sf_dir):
    li = C.table(spark, sf_dir, "lineitem").select(*KEYS, "l_returnflag")
    path = scratch_path(spark, "modes")
    W.write_parquet(li, path)                     # default: error if exists
    W.write_parquet(li, path, mode="append")      # two copies
    W.write_parquet(li, path, mode="ignore")      # no-op, path exists
    appended = R.read_parquet(spark, path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    path2 = scratch_path(spark, "modes-ow")
    W.write_parquet(li, path2)
    W.write_parquet(li, path2, mode="overwrite")  # replaced, one copy
    over = R.read_parquet(spark, path2).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return (appended.select(F.lit("append").alias("stage"), "l_returnflag", "n")
            .unionByName(over.select(F.lit("overwrite").alias("stage"), "l_returnflag", "n")))


def q_dataset_catalog(spark, sf_dir):
    workspace = scratch_path(spark, "workspace")
    C.candidates_from_lineitem(spark, sf_dir, keys=False).write.parquet(
        f"{workspace}/{DATASETS['simulation']}")
    return load_dataset(spark, workspace, "simulation")


def q_candidate_scan(spark, sf_dir):
    path = scratch_path(spark, "cand-json")
    W.write_json(C.candidates_from_lineitem(spark, sf_dir, keys=False), path)
    return C.read_candidates(spark, path, fmt="json")


def q_histogram_sink(spark, sf_dir):
    path = scratch_path(spark, "hist")
    W.write_histogram(q_histogram_fd(spark, sf_dir), path)
    return spark.read.schema("bin bigint, bin_lo double, bin_hi double, n bigint").json(path)


# ---- step 7: user functions -------------------------------------------------

def q_column_udf(spark, sf_dir):
    mass = _selected_mass(spark, sf_dir)
    edges = H.bin_edges(H.fd_binning(mass, "B_M"))
    return mass.select(*KEYS, "B_M", udfs.histogram_bin_udf(edges)(F.col("B_M")).alias("bin")).select(
        *KEYS, "B_M", _round_bin())


def q_udf3_sql(spark, sf_dir):
    view = udfs.unique_name("cand")
    _cand(spark, sf_dir).createOrReplaceTempView(view)
    fn = udfs.register_udf3(spark, "momentum_magnitude", udfs.momentum_magnitude, "double")
    out = spark.sql(f"SELECT {', '.join(KEYS)}, {fn}(H1_PX, H1_PY, H1_PZ) AS H1_P FROM {view}")
    spark.catalog.dropTempView(view)          # the analysed plan keeps its own copy
    return out


def q_sql_function(spark, sf_dir):
    """The three-argument function as an SQL one, which the optimiser puts in line."""
    view, name = udfs.unique_name("cand"), udfs.unique_name("magnitude")
    _cand(spark, sf_dir).createOrReplaceTempView(view)
    udfs.register_sql_function(spark, name, {"x": "DOUBLE", "y": "DOUBLE", "z": "DOUBLE"}, "DOUBLE", "sqrt(x * x + y * y + z * z)")
    return spark.sql(f"SELECT {', '.join(KEYS)}, {name}(H1_PX, H1_PY, H1_PZ) AS H1_P FROM {view}")


def q_dataset_map(spark, sf_dir):
    return udfs.dataset_map(_cand(spark, sf_dir), udfs.b_mass_batch, udfs.B_MASS_BATCH_SCHEMA,
                            udfs.B_MASS_BATCH_INPUT)


# ---- step 8: streams --------------------------------------------------------

def _folders(spark, name):
    return scratch_path(spark, f"{name}-sink"), scratch_path(spark, f"{name}-checkpoint")


def _table_stream(spark, sf_dir, name):
    """The files of a table as a stream: the table itself, a file or a folder (which the
    pattern stands for alike), is the source."""
    return streams.candidate_stream(spark, f"{sf_dir.rstrip('/')}/{name}.parque[t]", C.table(spark, sf_dir, name).schema, fmt="parquet")


def _files_per_batch(arrived: DataFrame, batches: int) -> int:
    """Files of a micro-batch, so that those which have arrived make so many batches or some
    fewer: a batch keeps all cores busy, and their number doesn't grow with the table."""
    return min(max(-(-len(arrived.inputFiles()) // batches), 1), streams.FILES_PER_TRIGGER)


def _some_files(table: DataFrame) -> int:
    """Rows of a file, so that also a small table arrives as several."""
    return min(table.count() // 8 + 1, W.FILE_ROWS)


def q_stream_momentum(spark, sf_dir):
    """JSON files with an explicit schema through ``with_momentum``."""
    source = scratch_path(spark, "candidates-json")
    W.write_json(_cand(spark, sf_dir), source)
    return streams.run(streams.momentum_stream(streams.candidate_stream(spark, source, KEYED_SCHEMA)), *_folders(spark, "momentum"))


def q_stream_b_mass(spark, sf_dir):
    candidates = _table_stream(spark, sf_dir, "lineitem").selectExpr(*C.candidate_select_list())
    return streams.run(streams.b_mass_stream(candidates), *_folders(spark, "b-mass"))


def q_stream_lines(spark, sf_dir):
    """A line per document, line breaks inside it as spaces."""
    lines = _table_stream(spark, sf_dir, "documents").select(F.regexp_replace(F.coalesce("text", F.lit("")), "[\\r\\n]", " ").alias("value"))
    return streams.run(lines, *_folders(spark, "lines"))


def q_stream_text_files(spark, sf_dir):
    """Text files as lines; half of them arrive between two runs of the query."""
    source, sink, checkpoint = scratch_path(spark, "text"), *_folders(spark, "text")
    names = C.table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_partkey", "p_name").alias("value"))
    for part in (0, 1):
        names.where(F.length("value") % 2 == part).write.mode("append").text(source)
        out = streams.run(streams.line_stream(spark, source, 1), sink, checkpoint)
    return out


def q_stream_restart(spark, sf_dir):
    """Candidate files that arrive between runs: each run goes on where the one before it
    stopped, and the sink holds every row once."""
    source, sink, checkpoint = scratch_path(spark, "arriving"), *_folders(spark, "arriving")
    for part in range(3):
        W.write_json(_cand(spark, sf_dir).where(F.col("l_linenumber") % 3 == part), source, mode="append")
        files = _files_per_batch(R.read_json(spark, source, options={"schema": KEYED_SCHEMA}), 2 * (part + 1))
        out = streams.run(streams.momentum_stream(streams.candidate_stream(spark, source, KEYED_SCHEMA, files)), sink, checkpoint)
    return out


def q_stream_histogram(spark, sf_dir):
    """Counts per fixed bin on a stream: several micro-batches, restarted once from the
    checkpoint with its state."""
    edges = H.bin_edges(_mass_binning(spark, sf_dir))
    source, sink, checkpoint = scratch_path(spark, "binned"), *_folders(spark, "binned")
    most = _some_files(C.table(spark, sf_dir, "lineitem"))
    for part in (0, 1):
        W.write_json(_cand(spark, sf_dir).where(F.col("l_linenumber") % 2 == part), source, mode="append", options={"max_records_per_file": most})
        files = _files_per_batch(R.read_json(spark, source, options={"schema": KEYED_SCHEMA}), 2 * (part + 1))
        mass = streams.b_mass_stream(streams.candidate_stream(spark, source, KEYED_SCHEMA, files))
        streams.run_available(streams.start_histogram(mass, "B_M", edges, sink, checkpoint))
    return streams.read_histogram(spark, sink).select(_round_bin(), "n")


QUERIES: Q = {
    "sum_cols": q_sum_cols,
    "sum_squares": q_sum_squares,
    "momentum": q_momentum,
    "energy": q_energy,
    "four_momentum": q_four_momentum,
    "invariant_mass": q_invariant_mass,
    "b_mass": q_b_mass,
    "candidate_selection": q_candidate_selection,
    "strict_selection": q_strict_selection,
    "select_cols": q_select_cols,
    "select_expr": q_select_expr,
    "where_column": q_where_column,
    "where_sql": q_where_sql,
    "with_column": q_with_column,
    "group_by_agg": q_group_by_agg,
    "group_by": q_group_by,
    "exact_sums": q_exact_sums,
    "row_count": q_row_count,
    "min_max": q_min_max,
    "describe": q_describe,
    "describe_strings": q_describe_strings,
    "summary": q_summary,
    "summary_strings": q_summary_strings,
    "summary_percentiles": q_summary_percentiles,
    "approx_quantile": q_approx_quantile,
    "approx_quantile_001": q_approx_quantile_001,
    "approx_quantile_bounds": q_approx_quantile_bounds,
    "exact_quantile": q_exact_quantile,
    "sketch_totals": q_sketch_totals,
    "sketch_quantile_bounds": q_sketch_quantile_bounds,
    "fd_binning": q_fd_binning,
    "bin_edges": q_bin_edges,
    "bin_assign": q_bin_assign,
    "histogram_edges": q_histogram_edges,
    "histogram_fd": q_histogram_fd,
    "histogram_fd_all": q_histogram_fd_all,
    "histogram_fd_approx": q_histogram_fd_approx,
    "column_histogram": q_column_histogram,
    "column_histograms": q_column_histograms,
    "sort_take": q_sort_take,
    "sort_all": q_sort_all,
    "first_row": q_first_row,
    "sample": q_sample,
    "sample_by_keys": q_sample_by_keys,
    "sample_properties": q_sample_properties,
    "csv_scan": q_csv_scan,
    "json_roundtrip": q_json_roundtrip,
    "parquet_multi_path": q_parquet_multi_path,
    "parquet_partitioned": q_parquet_partitioned,
    "bucketed_join": q_bucketed_join,
    "bucket_metadata": q_bucket_metadata,
    "quarantine": q_quarantine,
    "save_modes": q_save_modes,
    "dataset_catalog": q_dataset_catalog,
    "candidate_scan": q_candidate_scan,
    "histogram_sink": q_histogram_sink,
    "column_udf": q_column_udf,
    "udf3_sql": q_udf3_sql,
    "sql_function": q_sql_function,
    "dataset_map": q_dataset_map,
    "stream_momentum": q_stream_momentum,
    "stream_b_mass": q_stream_b_mass,
    "stream_lines": q_stream_lines,
    "stream_text_files": q_stream_text_files,
    "stream_restart": q_stream_restart,
    "stream_histogram": q_stream_histogram,
    "stream_quarantine": q_stream_quarantine,
}

FLAGSHIP = "histogram_fd"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[FLAGSHIP](spark, sf_dir)
