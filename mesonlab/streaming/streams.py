"""Structured Streaming forms of the operators, between folders of the caller.

Sources are folders of JSON, Parquet or text files with an explicit schema, in bounded
micro-batches. Kinematics and selections are stateless projections and filters, so the
batch functions apply to a streaming DataFrame unchanged; counts per fixed bin are a
stateful aggregation. A sink writes every micro-batch to a place that follows from its
number, so that a batch replayed after a crash replaces what it wrote before; with the
checkpoint, files are processed once however often the query is stopped. Quantiles need
all values: histogram_fd stays a batch operator.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mesonlab.functions.kinematics import with_b_mass, with_momentum
from mesonlab.functions.selection import b_candidate_selection
from mesonlab.operators.edges import Edges
from mesonlab.operators.histogram import histogram_edges
from mesonlab.sources.candidates import KEY_COLUMNS
from mesonlab.sources.readers import split_malformed

#: Files of a micro-batch, unless the caller says otherwise: batches stay bounded
#: however many files wait in the folder.
FILES_PER_TRIGGER = 1000


def candidate_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int = FILES_PER_TRIGGER,
                     fmt: str = "json") -> DataFrame:
    """Candidate files arriving in the folder ``path`` as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).format(fmt).load(path)


def line_stream(spark: SparkSession, path: str, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """The lines of text files arriving in the folder ``path``, as ``value``."""
    return spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path)


def run_available(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query to drain its input, however long that
    takes; only a caller's own ``timeout_s`` stops it. Surfaces its failure."""
    finished = query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination() is not False
    if not finished:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def stop(query: StreamingQuery) -> None:
    if query.isActive:
        query.stop()


class Watched:
    """A started query awaited on a background thread; ``stop()`` ends it from
    any other thread, ``error`` holds a failure the wait observed."""

    def __init__(self, query: StreamingQuery):
        self.query = query
        self.error: BaseException | None = None
        self._thread = threading.Thread(target=self._wait, name=f"await-{query.id}", daemon=True)
        self._thread.start()

    def _wait(self) -> None:
        try:
            self.query.awaitTermination()
        except BaseException as exc:  # surfaced to the owner, not lost in the thread
            self.error = exc

    @property
    def running(self) -> bool:
        return self._thread.is_alive()

    def stop(self, timeout_s: float = 60) -> None:
        stop(self.query)
        self._thread.join(timeout_s)


def watch(query: StreamingQuery) -> Watched:
    return Watched(query)


def start(stream: DataFrame, sink: str, checkpoint: str, write: Callable[[DataFrame, int], None] | None = None, output_mode: str = "append",
          every: str | None = None, name: str | None = None) -> StreamingQuery:
    """Starts ``stream`` into the folder ``sink`` with its progress in ``checkpoint``, both
    the caller's. ``every`` is a processing interval; without it what is present is
    processed and the query ends. ``write`` may replace the writing of a micro-batch."""
    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(write or put)
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def start_quarantine(lines: DataFrame, schema: str, good: str, quarantine: str, checkpoint: str, column: str = "value", every: str | None = None) -> StreamingQuery:
    """JSON lines of a stream, the malformed ones to a sink of their own; read both with
    ``read_sink``."""
    def put(batch: DataFrame, number: int) -> None:
        split_malformed(batch, schema, f"{good}/batch={number}", f"{quarantine}/batch={number}", column, mode="overwrite")
    return start(lines, good, checkpoint, put, every=every)


def read_sink(spark: SparkSession, sink: str, schema) -> DataFrame:
    """What a stream started by ``start`` has written so far."""
    return spark.read.schema(schema).parquet(f"{sink}/batch=*") if _written(spark, sink) else spark.createDataFrame([], schema)


def _written(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(path)


def run(stream: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Processes what is present, and returns all that the sink holds: also what earlier
    runs with the same folders wrote."""
    run_available(start(stream, sink, checkpoint))
    return read_sink(stream.sparkSession, sink, stream.schema)


def momentum_stream(candidates: DataFrame, prefix: str = "H1_", keys=KEY_COLUMNS) -> DataFrame:
    return with_momentum(candidates, prefix).select(*keys, prefix + "P2", prefix + "P")


def b_mass_stream(candidates: DataFrame, keys=KEY_COLUMNS) -> DataFrame:
    """The row-wise part of the analysis: ``with_b_mass`` and the B selection."""
    return with_b_mass(candidates).where(b_candidate_selection()).select(*keys, "B_M")


def start_histogram(stream: DataFrame, column: str, edges: Edges | list[float], sink: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Counts per fixed bin of a stream, kept in the state store between micro-batches and
    restarts. Each batch writes the whole histogram with its number, by turns into two
    folders, so that the one before stays whole while it does."""
    counted = histogram_edges(stream, column, edges)

    def put(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{sink}/turn={number % 2}")
    return start(counted, sink, checkpoint, put, "complete", every)


def read_histogram(spark: SparkSession, sink: str) -> DataFrame:
    """The histogram of the last micro-batch written: (bin, n)."""
    schema = "bin double, n bigint, batch bigint"
    if not _written(spark, sink):
        return spark.createDataFrame([], "bin double, n bigint")
    both = spark.read.schema(schema).parquet(f"{sink}/turn=*")
    last = both.agg(F.max("batch").alias("last"))
    return both.join(F.broadcast(last), F.col("batch") == F.col("last")).select("bin", "n")
