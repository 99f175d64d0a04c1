"""Stored quantile sketches: one KLL sketch a source file, merged without rescanning.

A store is a Parquet folder with a row per source file and column: rows, finite values,
and a sketch of the finite values (some thousand numbers, whatever the file holds). Data
that arrive later add rows for their own files alone; quantiles and Freedman-Diaconis
binnings come from merging the rows, which Spark does with a partial merge per task. A
quantile's rank is within the relative error of the sketches with a probability of 99 %;
the least and the greatest value are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mesonlab.operators.histogram import Binning, fd_width
from mesonlab.operators.stats import finite

#: Rank error of the sketches, and the sizes that the sketch library takes.
RELATIVE_ERROR, LEAST_K, MOST_K = 0.005, 8, 65535
SKETCHES = "source string, variable string, n bigint, n_valid bigint, k int, sketch binary"


def sketch_size(relative_error: float) -> int:
    """The k of a KLL sketch whose rank error is ``relative_error`` in 99 % of cases:
    the error of a sketch of size k is about 2.446 / k^0.9433."""
    if not 0 < relative_error < 1:
        raise ValueError("a sketch needs a relative error between 0 and 1")
    return min(max(int((2.446 / relative_error) ** (1 / 0.9433)) + 1, LEAST_K), MOST_K)


def sketch_columns(df: DataFrame, columns: Sequence[str], source: Column | str | None = None, relative_error: float = RELATIVE_ERROR) -> DataFrame:
    """A row per source and column (see SKETCHES), all columns in one scan. ``source`` names
    what a row came from; by default its file. Sources without rows give none."""
    if not columns:
        raise ValueError("at least one column is required")
    source = F.input_file_name() if source is None else source
    source = F.col(source) if isinstance(source, str) else source
    k = sketch_size(relative_error)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`").cast("double")
        x = F.when(finite(x), x)
        aggs += [F.count(x).alias(f"valid{i}"), F.kll_sketch_agg_double(x, F.lit(k)).alias(f"sketch{i}")]
    rows = df.withColumn("_source", source).groupBy("_source").agg(*aggs)
    each = [F.struct(F.lit(c).alias("variable"), "n", F.col(f"valid{i}").alias("n_valid"), F.lit(k).alias("k"), F.col(f"sketch{i}").alias("sketch")) for i, c in enumerate(columns)]
    return rows.select(F.col("_source").alias("source"), F.explode(F.array(*each)).alias("r")).select("source", "r.*")


def update_store(df: DataFrame, columns: Sequence[str], store: str, relative_error: float = RELATIVE_ERROR) -> None:
    """Adds sketches of those files of ``df`` (a frame over files) that ``store`` doesn't hold yet.
    Only their files are read."""
    spark = df.sparkSession
    known = read_store(spark, store).select("source").distinct()
    if known.isEmpty():
        sketch_columns(df, columns, relative_error=relative_error).write.mode("append").parquet(store)
        return
    names = spark.createDataFrame([(f,) for f in df.inputFiles()], "file string")  # a row per file of the frame
    new = [r.file for r in names.join(known, F.col("file") == F.col("source"), "left_anti").collect()]
    if new:
        part = spark.read.schema(df.schema).parquet(*new)
        sketch_columns(part, columns, relative_error=relative_error).write.mode("append").parquet(store)


def read_store(spark: SparkSession, store: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], SKETCHES)
    return spark.read.schema(SKETCHES).parquet(store)


def merged(sketches: DataFrame) -> DataFrame:
    """(variable, n, n_valid, sketch) over all sources."""
    return sketches.groupBy("variable").agg(F.sum("n").alias("n"), F.sum("n_valid").alias("n_valid"),
                                            F.kll_merge_agg_double(F.when(F.col("n_valid") > 0, F.col("sketch"))).alias("sketch"))


def _quantile(p: float) -> Column:
    return F.when(F.col("n_valid") > 0, F.kll_sketch_get_quantile_double(F.col("sketch"), F.lit(float(p))))


def sketch_quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """(variable, p, q): null where a column has no finite value."""
    for p in probabilities:
        if not 0 <= p <= 1:
            raise ValueError("probability must be in [0, 1]")
    each = [F.struct(F.lit(float(p)).alias("p"), _quantile(p).alias("q")) for p in probabilities]
    return merged(sketches).select("variable", F.explode(F.array(*each)).alias("r")).select("variable", "r.*")


def sketch_binning(sketches: DataFrame, variable: str) -> Binning:
    """Freedman-Diaconis statistics of a column from its stored sketches."""
    row = merged(sketches.where(F.col("variable") == variable)).select("n", "n_valid", *[_quantile(p).alias(c) for c, p in (("lo", 0.0), ("q1", 0.25), ("q3", 0.75), ("hi", 1.0))]).first()
    if row is None or not row["n_valid"]:
        return Binning(row["n"] if row else 0, 0, None, None, None, None, None)
    return Binning(row["n"], row["n_valid"], row["lo"], row["hi"], row["q1"], row["q3"], fd_width(row["q1"], row["q3"], row["n"]))
