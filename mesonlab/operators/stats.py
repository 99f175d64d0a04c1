"""Descriptive statistics and quantiles.

``exact_quantiles`` is a distributed selection: it never gathers a column (or
one group of it) into a single task or the driver. On the kept value column:

1. one aggregate: count, min and max of the valid (non-null, non-NaN) values;
2. a bucket pass: the interval holding each target rank is split into equal-
   width buckets; count, min and max per bucket come from a partial (map-side)
   aggregate; a running count (window over the small per-bucket table) picks
   the bucket holding the rank, and that bucket, narrowed to its own min and
   max, is the next interval (targets sharing an interval share the pass);
3. an interval that holds one value, or whose rank is its first or last row,
   is answered at once; one with at most ``fetch_limit`` rows is finished by a
   ``row_number`` window inside one bounded window partition.

Buckets are of equal width in the value at first. An interval that a pass hardly
shrank changes to equal width in the signed logarithm of the value (and back), so
the number of passes does not follow the dynamic range of the data. Either number is
a monotone function of the value, so running counts follow value order; an
interval's min lands in its first bucket and its max in the last, so every pass
strictly shrinks the candidate set and the loop ends on any input. A value shared by a third of all rows is one bucket with a large count.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mesonlab.session import cores

DEFAULT_SUMMARY = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def describe(df: DataFrame, *columns: str) -> DataFrame:
    """count, mean, stddev, min, max per column (Spark returns strings)."""
    if not columns:
        raise ValueError("describe needs at least one column")
    return df.describe(*columns)


def summary(df: DataFrame, *statistics: str) -> DataFrame:
    """Chosen statistics (percentiles as ``"75%"``); Spark's default set when none given."""
    return df.summary(*(statistics or DEFAULT_SUMMARY))


def numeric_stats_table(stats: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """describe/summary output with its string cells cast back to rounded doubles."""
    return stats.select(
        F.col("summary"),
        *[F.round(F.col(c).try_cast("double"), digits).alias(c) for c in columns])


def approx_quantile(df: DataFrame, column: str, probabilities: Sequence[float],
                    relative_error: float) -> list[float]:
    """Quantiles within ``relative_error`` (rank error <= relative_error * n).

    A positive error uses Greenwald-Khanna sketches, bounded per partition and
    merged. An error of 0 asks for exact values; Spark would then keep every
    value in the merged sketch, so the distributed ``exact_quantiles`` answers
    instead (same result, bounded memory).
    """
    if relative_error < 0:
        raise ValueError("relative_error must be >= 0")
    if relative_error == 0:
        return exact_quantiles(df, column, probabilities)
    return list(df.stat.approxQuantile(column, list(probabilities), relative_error))


def percentile_approx_column(column, probabilities: Sequence[float], relative_error: float) -> Column:
    """Lazy form of ``approx_quantile`` for use inside one ``agg`` with other aggregates."""
    if relative_error <= 0:
        raise ValueError("a sketch needs a positive relative_error; exact_quantiles gives exact values")
    accuracy = max(1, int(round(1.0 / relative_error)))
    return F.percentile_approx(column, F.array(*[F.lit(float(p)) for p in probabilities]), accuracy)


def quantile_rank(n: int, p: float) -> int:
    """1-based rank of the discrete p-quantile: the smallest value whose
    cumulative share of rows is at least ``p`` (``percentile_disc``)."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("probability must be in [0, 1]")
    return max(1, n - math.floor(n - n * p))


def valid(c: Column | str = "v") -> Column:
    """Not null and not NaN (what quantiles rank)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & ~F.isnan(c)


def finite(c: Column | str = "v") -> Column:
    """Not null, not NaN, not infinite (what histograms bin); NaN compares
    above +inf in Spark, so one comparison covers it."""
    c = F.col(c) if isinstance(c, str) else c
    return F.abs(c) < F.lit(math.inf)


class KeptValues:
    """One double column ``v`` (nulls and NaN kept) projected from ``df`` and
    persisted for the passes that follow (memory, spilling to disk; lost blocks
    are recomputed from lineage). Use as a context manager.

    ``stats()`` is the first pass: it materialises the column and returns
    count, valid count, min, max (plus extra aggregates) together with the
    column's partition count. The passes after it use ``frame`` in the input's
    own partitions: ``defaultParallelism`` isn't the cluster's size, so nothing is
    coalesced by it. Nothing is planned or executed just to learn the partition count. A frame
    with fewer partitions than cores is small; it is spread round-robin (from
    the cache) only with ``spread_small``, worth it when the passes explode each
    row into many intervals (several kept columns), not for one column.
    """

    def __init__(self, df: DataFrame, column, persist: bool = True, spread_small: bool = False,
                 finite_only: bool = False):
        cols = column if isinstance(column, dict) else {"v": column}
        self.names = list(cols)
        self._ok = finite if finite_only else valid
        self._slots = cores(df.sparkSession)
        self._persist = persist
        self._base = df.select(*[(F.col(c) if isinstance(c, str) else c).cast("double").alias(n)
                                 for n, c in cols.items()])
        if persist:
            self._base = self._base.persist(StorageLevel.MEMORY_AND_DISK)
        self._spread_small = spread_small
        self._spread = None
        self.frame = self._base
        self.parts: int | None = None

    def stats(self, *extra: Column):
        """Row with ``n`` and, per kept column, ``n_valid``, ``lo``, ``hi``
        (suffixed ``_<name>`` when several columns are kept)."""
        aggs = [F.count(F.lit(1)).alias("n")]
        for name in self.names:
            x = F.when(self._ok(name), F.col(name))
            sfx = "" if self.names == ["v"] else f"_{name}"
            aggs += [F.count(x).alias("n_valid" + sfx), F.min(x).alias("lo" + sfx), F.max(x).alias("hi" + sfx)]
        tagged = self._base.withColumn("_part", F.spark_partition_id())
        row = tagged.agg(*aggs, *extra, F.max("_part").alias("_last_part")).first()
        self.parts = 1 + (row["_last_part"] or 0)
        if self._spread_small and self.parts < self._slots:
            self._spread = self._base.repartition(self._slots)
            self.parts = self._slots
            if self._persist:
                self._spread = self._spread.persist(StorageLevel.MEMORY_AND_DISK)
            self.frame = self._spread
        return row

    def release(self) -> None:
        if self._persist:
            for f in (self._spread, self._base):
                if f is not None:
                    f.unpersist()

    def __enter__(self) -> "KeptValues":
        return self

    def __exit__(self, *exc) -> None:
        self.release()


def value_stats(w: DataFrame, *extra: Column):
    """count(*), count of valid values, min and max of valid values (+ extra
    aggregates) in one pass; validity is applied inside the aggregates."""
    x = F.when(valid("v"), F.col("v"))
    return w.agg(F.count(F.lit(1)).alias("n"), F.count(x).alias("n_valid"),
                 F.min(x).alias("lo"), F.max(x).alias("hi"), *extra).first()


# Rows of partial aggregates one bucket pass may send through the shuffle.
SHUFFLE_ROW_BUDGET = 50_000_000
# Buckets of an interval, at least and at most. 4096 buckets take 5e11 values to a
# 65536-row interval in two passes, 64 in four.
LEAST_BUCKETS, MOST_BUCKETS = 64, 4096


def _pass_size(parts: int, intervals: int, enough: int) -> tuple[int, int]:
    """(buckets, tasks) of a pass over ``parts`` partitions: each task emits at most a row per
    interval and bucket, and all of them stay within the budget. Many partitions mean
    fewer buckets first; then several partitions share a task, as many as it takes."""
    room = max(SHUFFLE_ROW_BUDGET // max(1, parts * intervals), 1)
    buckets = max(LEAST_BUCKETS, min(MOST_BUCKETS, enough, 1 << (room.bit_length() - 1)))
    return buckets, max(1, min(parts, SHUFFLE_ROW_BUDGET // (intervals * buckets)))


def _any(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def sql_double(x: float) -> str:
    """Exact SQL text of a double (shortest round-trip digits, ``D`` type
    suffix so it is not read as a decimal; infinities as typed literals)."""
    if math.isnan(x):
        raise ValueError("NaN has no place in a range bound")
    if math.isinf(x):
        return "CAST('Infinity' AS DOUBLE)" if x > 0 else "CAST('-Infinity' AS DOUBLE)"
    return f"{x!r}D"


# The smallest positive double, and what makes its logarithm positive.
_TINY, _TINY_LOG = 5e-324, 745.0
# An interval keeps its numbering if a pass left it at most this share of its rows.
SHRANK = 0.25


def _signed_log(x: float) -> float:
    return math.copysign(math.log(max(abs(x), _TINY)) + _TINY_LOG, x) if x else 0.0


def _signed_log_sql(value: str) -> str:
    return f"SIGNUM({value}) * (LN(GREATEST(ABS({value}), {sql_double(_TINY)})) + {sql_double(_TINY_LOG)})"


def _log_bucket_sql(lo: float, hi: float, buckets: int, column: str) -> str | None:
    """Buckets of equal width in the signed logarithm; the ends are tested by value, so
    a last digit of the logarithm can't put them elsewhere. None where it can't tell
    the ends apart."""
    width = _signed_log(hi) - _signed_log(lo)
    if not width > 1e-9:
        return None
    raw = f"FLOOR(({_signed_log_sql(f'`{column}`')} - {sql_double(_signed_log(lo))}) * {sql_double(buckets / width)})"
    return (f"CASE WHEN `{column}` = {sql_double(lo)} THEN 0 WHEN `{column}` = {sql_double(hi)} THEN {buckets - 1} "
            f"ELSE CAST(LEAST(GREATEST({raw}, 0), {buckets - 1}) AS INT) END")


def _bucket_sql(lo: float, hi: float, buckets: int, column: str, log: bool = False) -> str:
    if log and not math.isinf(lo) and not math.isinf(hi):
        by_log = _log_bucket_sql(lo, hi, buckets, column)
        if by_log is not None:
            return by_log
    if math.isinf(lo) or math.isinf(hi):
        # lo, interior, hi: the ends differ, so the next interval is smaller
        return (f"CASE WHEN `{column}` = {sql_double(lo)} THEN 0 "
                f"WHEN `{column}` = {sql_double(hi)} THEN 2 ELSE 1 END")
    width = hi * 0.5 - lo * 0.5
    scale = buckets / width if width > 0 else math.inf
    if not math.isfinite(scale):
        return f"CASE WHEN `{column}` > {sql_double(lo)} THEN 1 ELSE 0 END"
    raw = f"FLOOR((`{column}` * 0.5D - {sql_double(lo * 0.5)}) * {sql_double(scale)})"
    return f"CAST(LEAST(GREATEST({raw}, 0), {buckets - 1}) AS INT)"


def _tag(frame: DataFrame, intervals: list[tuple], buckets: int | None = None) -> DataFrame:
    """Rows inside each (column, lo, hi[, by logarithm]) interval as (g, [b,] v): interval
    number, optional bucket number, value. A range test is false for null and
    NaN, so no validity filter is needed. Built as one SQL expression (one
    parse instead of hundreds of client-side Column calls)."""
    def struct(g, c, lo, hi, log=False):
        b = f"'b', {_bucket_sql(lo, hi, buckets, c, log)}, " if buckets is not None else ""
        return f"named_struct('g', {g}, {b}'v', `{c}`)"

    def cond(c, lo, hi, log=False):
        return f"`{c}` >= {sql_double(lo)} AND `{c}` <= {sql_double(hi)}"
    if len(intervals) == 1:
        return frame.where(F.expr(cond(*intervals[0]))).select(F.expr(struct(0, *intervals[0])).alias("r")).select("r.*")
    cases = ", ".join(f"CASE WHEN {cond(*iv)} THEN {struct(g, *iv)} END" for g, iv in enumerate(intervals))
    return (frame.select(F.expr(f"explode(array({cases}))").alias("r")).where(F.col("r").isNotNull())
            .select("r.*"))


def bucket_pass(frame: DataFrame, intervals: list[tuple],
                needs: list[tuple[int, int]], buckets: int) -> DataFrame:
    """One narrowing pass as a plan: per (interval g, bucket b) the count, min
    and max (partial aggregate, then a shuffle of at most tasks x intervals x
    buckets rows), a running count over the small per-bucket table, and the
    buckets holding each wanted (g, rank) pair."""
    counts = (_tag(frame, intervals, buckets)
              .groupBy("g", "b").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"),
                                     F.max("v").alias("hi")))
    running = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    return (counts.withColumn("cum", F.sum("c").over(running))
            .where(_any([(F.col("g") == g) & (F.col("cum") - F.col("c") < need) & (F.col("cum") >= need)
                         for g, need in needs])))


def exact_quantiles(df: DataFrame, column, probabilities: Sequence[float], *,
                    buckets: int | None = None, fetch_limit: int = 1 << 16,
                    known: tuple[int, float, float] | None = None,
                    values: DataFrame | None = None, parts: int | None = None) -> list[float | None]:
    """Exact discrete quantiles (same rule as SQL ``percentile_disc``) over the
    non-null, non-NaN values of ``column``.

    ``values`` may pass a prepared one-column frame ``v`` (see
    ``KeptValues``; nulls and NaN may remain), ``known`` its (valid count, min, max) and
    ``parts`` its partition count. ``buckets`` defaults to a size chosen from the
    partition count; ``fetch_limit`` is the largest interval (in rows) that is
    finished by sorting it inside one window partition.
    """
    if values is not None:
        return _select_ranks(values, probabilities, buckets, fetch_limit, known, parts)
    with KeptValues(df, column) as kept:
        row = kept.stats()
        return _select_ranks(kept.frame, probabilities, buckets, fetch_limit,
                             (row["n_valid"], row["lo"], row["hi"]), kept.parts)


def _partitions(frame: DataFrame) -> int:
    """Partitions of a frame that hold rows, up to the last one."""
    last = frame.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0]
    return 1 + (last or 0)


def _select_ranks(v: DataFrame, probabilities, buckets, fetch_limit, known, parts=None):
    if known is None:
        row = value_stats(v)
        known = (row["n_valid"], row["lo"], row["hi"])
    n, lo, hi = known
    return select_quantiles(v, [("v", n, lo, hi, p) for p in probabilities], buckets, fetch_limit, parts)


def select_quantiles(frame: DataFrame, targets: Sequence[tuple[str, int, float, float, float]],
                     buckets: int | None = None, fetch_limit: int = 1 << 16,
                     parts: int | None = None) -> list[float | None]:
    """Exact quantiles for several (column, valid count, min, max, p) targets
    of one kept frame; targets with the same column and interval share passes,
    and every pass serves all columns at once. ``parts`` is the frame's partition
    count, found by a pass of its own where it isn't given."""
    parts = _partitions(frame) if parts is None else parts
    # target -> [column, need, lo, hi, rows, log]: the ``need``-th smallest of the
    # ``rows`` valid values of ``column`` in [lo, hi] (lo, hi present in data);
    # log: the next pass numbers buckets by the logarithm
    state = {i: [c, quantile_rank(n, p), lo, hi, n, False] for i, (c, n, lo, hi, p) in enumerate(targets) if n > 0}
    result: dict[int, float | None] = {i: None for i, t in enumerate(targets) if t[1] == 0}
    while True:
        for i, (_, need, t_lo, t_hi, rows, _) in list(state.items()):
            if t_lo == t_hi or need == 1 or need == rows:
                result[i] = t_hi if need == rows else t_lo
                del state[i]
        if not state:
            break
        groups: dict[tuple[str, float, float, bool], list[int]] = {}
        for i, s in state.items():
            groups.setdefault((s[0], s[2], s[3], s[5]), []).append(i)
        intervals = list(groups)
        small = [g for g, key in enumerate(intervals) if state[groups[key][0]][4] <= fetch_limit]
        if small:
            # Sort each small interval in its own window partition; pick ranks.
            sub = [intervals[g] for g in small]
            order = Window.partitionBy("g").orderBy("v")
            wanted = {}
            for k, key in enumerate(sub):
                for i in groups[key]:
                    wanted.setdefault((k, state[i][1]), []).append(i)
            picked = (_tag(frame, sub).withColumn("rn", F.row_number().over(order))
                      .where(_any([(F.col("g") == k) & (F.col("rn") == need) for k, need in wanted]))
                      .collect())
            for r in picked:
                for i in wanted.get((r["g"], r["rn"]), []):
                    result[i] = r["v"]
                    state.pop(i, None)
            if any(i in state for ids in wanted.values() for i in ids):
                raise RuntimeError("quantile rank beyond counted rows")
            intervals = [key for g, key in enumerate(intervals) if g not in small]
            if not intervals:
                continue
        # One bucket pass: count, min and max per bucket; a running count
        # (window over the small per-bucket table) finds each rank's bucket.
        # enough buckets to bring the largest interval under fetch_limit in one pass
        rows = max(state[groups[key][0]][4] for key in intervals)
        enough = 1 << max(8, (-(-rows // fetch_limit) - 1).bit_length())
        nb, tasks = _pass_size(parts, len(intervals), enough)
        nb = nb if buckets is None else buckets
        if nb < 2:
            raise ValueError("buckets must be at least 2")
        source = frame if tasks >= parts else frame.coalesce(tasks)
        wanted = {}
        for g, key in enumerate(intervals):
            for i in groups[key]:
                wanted.setdefault((g, state[i][1]), []).append(i)
        hits = bucket_pass(source, intervals, list(wanted), nb).collect()
        found = set()
        for r in hits:
            for (g, need), ids in wanted.items():
                if r["g"] == g and r["cum"] - r["c"] < need <= r["cum"]:
                    for i in ids:
                        log = state[i][5] != (r["c"] > SHRANK * state[i][4])
                        state[i] = [state[i][0], need - (r["cum"] - r["c"]), r["lo"], r["hi"], r["c"], log]
                        found.add(i)
        if len(found) != sum(len(ids) for ids in wanted.values()):
            raise RuntimeError("quantile rank beyond counted rows")
    return [result[i] for i in range(len(targets))]
