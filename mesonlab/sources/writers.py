"""Sinks: JSON, Parquet with save modes, and the histogram table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from mesonlab.sources.readers import camel_options

SAVE_MODES = {"overwrite": "overwrite", "append": "append", "ignore": "ignore",
              "error": "errorifexists", "errorifexists": "errorifexists"}


#: Rows of a JSON file, at most: a compressed file is read by one task, whole.
FILE_ROWS = 500_000


def write_json(df: DataFrame, path: str, mode: str = "error", options: Mapping | None = None) -> None:
    """Write JSON lines; fails if ``path`` exists (Spark's default mode).

    JSON repeats the names in every row, so unless ``options`` say otherwise the files are
    compressed, at the fastest level, and hold ``FILE_ROWS`` rows at most."""
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; expected one of {sorted(SAVE_MODES)}")
    defaults = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": FILE_ROWS}
    df.write.mode(SAVE_MODES[mode]).options(**{**defaults, **camel_options(options)}).json(path)


def write_parquet(df: DataFrame, path: str, mode: str | None = None,
                  partition_by: Sequence[str] | None = None,
                  sort_by: Sequence[str] | None = None, options: dict | None = None,
                  rebalance: bool = False) -> None:
    """Parquet writer.

    ``sort_by`` orders rows inside each output file (a sort within partitions,
    no global shuffle); Spark only accepts a writer-level sort for bucketed
    tables. With ``partition_by`` the rows are first clustered by the partition
    columns so each task writes few files.

    ``rebalance`` (with ``partition_by``) adds one shuffle by the partition
    columns under AQE's rebalance, which splits a hot partition value over
    several tasks and merges small ones: few, evenly sized files per value
    instead of one file per task and value.
    """
    if not path:
        raise ValueError("path is required")
    if mode is not None and mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; expected one of {sorted(SAVE_MODES)}")
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    if partition_by or sort_by:
        df = df.sortWithinPartitions(*(list(partition_by or []) + list(sort_by or [])))
    writer = df.write
    if mode is not None:
        writer = writer.mode(SAVE_MODES[mode])
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if options:
        writer = writer.options(**camel_options(options))
    writer.parquet(path)


def write_bucketed(df: DataFrame, name: str, buckets: int, bucket_by: Sequence[str], sort_by: Sequence[str] | None = None, path: str | None = None,
                   mode: str = "error", partition_by: Sequence[str] | None = None) -> None:
    """A catalog table of Parquet files bucketed by a hash of ``bucket_by`` and sorted inside
    each by ``sort_by``: joins and groupings on the bucket columns read it without an exchange.
    One shuffle by the bucket's own hash makes one file a bucket instead of one a task and
    bucket. ``path`` puts the files elsewhere than the warehouse."""
    if buckets < 1 or not bucket_by:
        raise ValueError("a bucketed table needs bucket columns and at least one bucket")
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; expected one of {sorted(SAVE_MODES)}")
    writer = df.repartition(buckets, *bucket_by).write.mode(SAVE_MODES[mode]).format("parquet").bucketBy(buckets, *bucket_by)
    writer = writer.sortBy(*sort_by) if sort_by else writer
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    (writer.option("path", path) if path else writer).saveAsTable(name)


def bucketing(spark: SparkSession, name: str) -> DataFrame:
    """(buckets, bucket_columns, sort_columns) of a catalog table, one row; none if it has no buckets."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    columns = {k: [c for c in rows.get(k, "").strip("[]").replace("`", "").split(", ") if c] for k in ("Bucket Columns", "Sort Columns")}
    found = [(int(rows["Num Buckets"]), columns["Bucket Columns"], columns["Sort Columns"])] if "Num Buckets" in rows else []
    return spark.createDataFrame(found, "buckets int, bucket_columns array<string>, sort_columns array<string>")


#: Bins of a file of a stored histogram, about.
FILE_BINS = 1_000_000


def write_histogram(hist: DataFrame, path: str, mode: str = "error") -> None:
    """Store a histogram (one row per bin) as JSON; the bins, not the values, leave the
    cluster. Bins are sorted and each file holds a range of them: one file for a usual
    histogram, many for one of millions of bins."""
    hist = hist.persist()
    parts = -(-max(hist.count(), 1) // FILE_BINS)
    hist.repartitionByRange(parts, "bin").sortWithinPartitions("bin").write.mode(SAVE_MODES[mode]).json(path)
    hist.unpersist()
