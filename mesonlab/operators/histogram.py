"""Freedman-Diaconis binning and histograms; only bins leave the executors.

Plan shape of ``histogram_fd`` (one scan of the source):
  scan (pruned, filters pushed) -> project value -> persist (one column)
  job 1: one aggregate -> count, min, max (+ GK quartile sketch in approx mode)
  jobs 2..k (exact mode): bucket passes of ``exact_quantiles`` on the kept column
  last job: bin index -> partial hash aggregate -> shuffle of at most
            (#bins x #tasks) rows -> final aggregate -> checkpoint (bins only)
The statistics enter the plans as literals: no join, no cross product.

Bin rules follow the reference analysis:
* width = 2 * IQR / cbrt(n), where n counts every input row, nulls included;
  min, max and quartiles use only finite values (null, NaN and infinities
  cannot be binned);
* edges start at min and accumulate ``+ width`` (floating-point accumulation,
  not ``min + i * width``) while below max;
* fixed-edge assignment: null -> null; below the first edge or at/above the
  last edge -> the sentinel ``SENTINEL`` (largest double); NaN -> last edge;
  otherwise the left edge of [e_k, e_k+1).
Degenerate inputs (IQR = 0 or min = max) give one bin [min, max] with every
valid row; an empty input gives no bins.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, asdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mesonlab.operators.edges import SENTINEL, Edges  # noqa: F401
from mesonlab.session import checkpoint_root
from mesonlab.operators.stats import (
    KeptValues, exact_quantiles, finite, percentile_approx_column,
    select_quantiles, sql_double,
)

# Fixed value: the reference's quantile relative error.
REFERENCE_RELATIVE_ERROR = 0.01


# Bits of a bin number (below 2^53) where it shares a whole number with its column's.
BIN_BITS = 53
MOST_COLUMNS = 512


@dataclass(frozen=True)
class Binning:
    n: int                 # all rows, nulls included
    n_valid: int           # finite values (the ones binned)
    min: float | None
    max: float | None
    q1: float | None
    q3: float | None
    width: float | None

    @property
    def degenerate(self) -> bool:
        return self.n_valid > 0 and (self.width == 0.0 or self.min == self.max)

    def as_dict(self) -> dict:
        return asdict(self)


def _check_resolution(b: Binning) -> None:
    """Bin numbers are exact whole numbers up to 2^53; a width beyond that is below the
    resolution of the values themselves."""
    if not b.degenerate and b.n_valid and not (b.max - b.min) / b.width < 2.0 ** 53:
        raise ValueError("bin width below floating-point resolution at this magnitude")


def fd_width(q1: float, q3: float, n: int) -> float:
    return 2.0 * (q3 - q1) / math.cbrt(n)


def _batch_only(df: DataFrame) -> None:
    if df.isStreaming:
        raise ValueError("Freedman-Diaconis binning needs global quantiles: run it on a batch "
                         "DataFrame, e.g. the stream's sink read back")


def _binning_of_values(kept: KeptValues, quantiles: str, relative_error: float) -> Binning:
    """Binning statistics of a kept value column."""
    quantiles = "exact" if relative_error == 0 else quantiles  # an error of 0 asks for exact values
    if quantiles not in ("exact", "approx"):
        raise ValueError("quantiles must be 'exact' or 'approx'")
    extra = []
    if quantiles == "approx":
        x = F.when(finite("v"), F.col("v"))
        extra.append(percentile_approx_column(x, [0.25, 0.75], relative_error).alias("q"))
    row = kept.stats(*extra)
    n_all, n_valid, lo, hi = row["n"], row["n_valid"], row["lo"], row["hi"]
    if n_valid == 0:
        return Binning(n_all, 0, None, None, None, None, None)
    if quantiles == "approx":
        q1, q3 = row["q"]
    else:
        q1, q3 = exact_quantiles(None, None, [0.25, 0.75], known=(n_valid, lo, hi), values=kept.frame, parts=kept.parts)
    return Binning(n_all, n_valid, lo, hi, q1, q3, fd_width(q1, q3, n_all))


def fd_binning(df: DataFrame, column: str, quantiles: str = "exact",
               relative_error: float = REFERENCE_RELATIVE_ERROR, persist: bool = True) -> Binning:
    """Freedman-Diaconis statistics of ``column``.

    One aggregate gives the all-row count, the valid count, min and max (and,
    with ``quantiles="approx"``, the GK quartile sketch at ``relative_error``,
    the reference's 0.01). ``quantiles="exact"`` adds the bucket-count passes of
    ``exact_quantiles`` (percentile_disc rule). The one projected column is
    kept across those passes.
    """
    _batch_only(df)
    with KeptValues(df, column, persist, finite_only=True) as kept:
        return _binning_of_values(kept, quantiles, relative_error)


def bin_edges(b: Binning) -> Edges:
    """Accumulated edges: min, min+w, (min+w)+w, ... while below max; as runs, however many."""
    if b.n_valid == 0:
        return Edges([])
    if b.degenerate:
        return Edges.of([b.min])
    return Edges.accumulated(b.min, b.width, b.max)


def assign_bins(df: DataFrame, column: str, edges: Edges | list[float], out: str = "bin") -> DataFrame:
    """Fixed-edge bin of every row (rules in the module docstring): a projection."""
    edges = Edges.of(edges)
    return edges.with_edge(edges.with_bin(df, column, "_bin"), "_bin", out).drop("_bin")


def histogram_edges(df: DataFrame, column: str, edges: Edges | list[float]) -> DataFrame:
    """Count per fixed-edge bin (sentinel bin included): bin numbers are counted, then
    the few result rows get their edges. A batch or a streaming frame."""
    edges = Edges.of(edges)
    counted = edges.with_bin(df.select(column), column, "_bin").groupBy("_bin").agg(F.count(F.lit(1)).alias("n"))
    return edges.with_edge(counted, "_bin", "bin").select("bin", "n")


def _fd_bins_plan(df: DataFrame, column: str, b: Binning, digits: int | None) -> DataFrame:
    """One scan, bin index per row, partial + final count per bin.

    Invalid values get a null bin and ``count(bin)`` = 0 for that group, which
    the final filter drops; a row filter on validity would be pushed below the
    projection and evaluate the (possibly expensive) value twice."""
    _check_resolution(b)
    x = F.col(column).cast("double")
    if b.degenerate:
        idx = F.when(finite(x), F.lit(0).cast("long"))
        lo_e, hi_e = F.lit(b.min), F.lit(b.max)
    else:
        idx = F.when(finite(x), F.floor((x - F.lit(b.min)) / F.lit(b.width)).cast("long"))
        lo_e = F.lit(b.min) + F.col("bin") * F.lit(b.width)
        hi_e = F.lit(b.min) + (F.col("bin") + 1) * F.lit(b.width)
    counted = (df.select(idx.alias("bin")).groupBy("bin").agg(F.count("bin").alias("n"))
               .where(F.col("n") > 0))
    if digits is not None:
        lo_e, hi_e = F.round(lo_e, digits), F.round(hi_e, digits)
    return counted.select("bin", lo_e.alias("bin_lo"), hi_e.alias("bin_hi"), "n")


def empty_histogram(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "bin bigint, bin_lo double, bin_hi double, n bigint")


def _kept(spark: SparkSession, result: DataFrame) -> DataFrame:
    """Materialise a small result in the shared checkpoint folder (lineage cut,
    nothing through the driver) so the kept input column can be released."""
    checkpoint_root(spark)
    return result.checkpoint(eager=True)


def histogram_fd(df: DataFrame, column: str, quantiles: str = "exact",
                 relative_error: float = REFERENCE_RELATIVE_ERROR, digits: int | None = 6,
                 materialize: bool = True) -> DataFrame:
    """Freedman-Diaconis histogram: bin index ``floor((x - min) / width)``,
    the last partial bin kept so no valid row is lost. Columns
    ``bin, bin_lo, bin_hi, n``; edges rounded to ``digits`` (None keeps them).

    With ``materialize`` (default) the source is scanned once: the value column
    is kept, the statistics and the bin counts are computed from it, and the
    bin table is checkpointed before the column is released. Without it the
    statistics are computed (one kept column) and a lazy plan over the source
    is returned.
    """
    _batch_only(df)
    if not materialize:
        b = fd_binning(df, column, quantiles, relative_error)
        if b.n_valid == 0:
            return empty_histogram(df.sparkSession)
        return _fd_bins_plan(df, column, b, digits)
    with KeptValues(df, column, finite_only=True) as kept:
        b = _binning_of_values(kept, quantiles, relative_error)
        if b.n_valid == 0:
            return empty_histogram(df.sparkSession)
        return _kept(df.sparkSession, _fd_bins_plan(kept.frame, "v", b, digits))


def fd_histogram_edges(df: DataFrame, column: str, quantiles: str = "exact",
                       relative_error: float = REFERENCE_RELATIVE_ERROR) -> tuple[Edges, DataFrame]:
    """Freedman-Diaconis edges and the fixed-edge histogram over them (with
    the sentinel bin), from one scan of the source."""
    _batch_only(df)
    with KeptValues(df, column, finite_only=True) as kept:
        edges = bin_edges(_binning_of_values(kept, quantiles, relative_error))
        if not edges:
            return edges, df.sparkSession.createDataFrame([], "bin double, n bigint")
        return edges, _kept(df.sparkSession, histogram_edges(kept.frame, "v", edges))


def column_histogram(df: DataFrame, column: str, **kwargs) -> DataFrame:
    """Histogram of any one column (same rules as ``histogram_fd``)."""
    return histogram_fd(df, column, **kwargs)


def _sql_value(v) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, float):
        return sql_double(v)
    return "'" + str(v).replace("'", "''") + "'"


def _per_column(k: str, values: list) -> Column:
    """``CASE k WHEN 0 THEN values[0] ...`` as one SQL expression."""
    return F.expr(f"CASE {k} " + " ".join(f"WHEN {i} THEN {_sql_value(v)}" for i, v in enumerate(values)) + " END")


def column_histograms(df: DataFrame, columns: list[str], quantiles: str = "exact",
                      relative_error: float = REFERENCE_RELATIVE_ERROR,
                      digits: int | None = 6) -> DataFrame:
    """Freedman-Diaconis histograms of several columns of one frame, each by
    the rules of ``histogram_fd``, from one scan of the source: the columns are
    kept together, one aggregate gives every column's statistics, the quartile
    passes serve all columns at once, and one aggregate counts all bins
    (``variable, bin, bin_lo, bin_hi, n``)."""
    _batch_only(df)
    if not columns:
        raise ValueError("column_histograms needs at least one column")
    if len(columns) > MOST_COLUMNS:  # a scan for each so many
        parts = [column_histograms(df, columns[i:i + MOST_COLUMNS], quantiles, relative_error, digits) for i in range(0, len(columns), MOST_COLUMNS)]
        return reduce(DataFrame.unionByName, parts)
    if quantiles not in ("exact", "approx"):
        raise ValueError("quantiles must be 'exact' or 'approx'")
    names = {f"c{i}": c for i, c in enumerate(columns)}
    with KeptValues(df, names, spread_small=len(names) > 1, finite_only=True) as kept:
        extra = []
        quantiles = "exact" if relative_error == 0 else quantiles
        if quantiles == "approx":
            extra = [percentile_approx_column(F.when(finite(n), F.col(n)), [0.25, 0.75], relative_error)
                     .alias(f"q_{n}") for n in names]
        row = kept.stats(*extra)
        n_all = row["n"]
        stats = {n: (row[f"n_valid_{n}"], row[f"lo_{n}"], row[f"hi_{n}"]) for n in names}
        if quantiles == "approx":
            quart = {n: tuple(row[f"q_{n}"]) if stats[n][0] else (None, None) for n in names}
        else:
            flat = select_quantiles(kept.frame, [(n, *stats[n], p) for n in names for p in (0.25, 0.75)], parts=kept.parts)
            quart = {n: (flat[2 * i], flat[2 * i + 1]) for i, n in enumerate(names)}
        bins = [Binning(n_all, stats[n][0], stats[n][1], stats[n][2], *quart[n],
                        None if not stats[n][0] else fd_width(*quart[n], n_all)) for n in names]
        live = [i for i, b in enumerate(bins) if b.n_valid > 0]
        if not live:
            return df.sparkSession.createDataFrame(
                [], "variable string, bin bigint, bin_lo double, bin_hi double, n bigint")
        rows = []
        for i in live:
            name, b = f"c{i}", bins[i]
            _check_resolution(b)
            x = F.col(name)
            idx = (F.lit(0).cast("long") if b.degenerate
                   else F.floor((x - F.lit(b.min)) / F.lit(b.width)).cast("long"))
            # column and bin in one whole number: an array of longs costs a row far less than structs
            rows.append(F.when(finite(name), F.lit(i << BIN_BITS) + idx))
        counted = (kept.frame.select(F.explode(F.array(*rows)).alias("kb")).where(F.col("kb").isNotNull())
                   .groupBy("kb").agg(F.count(F.lit(1)).alias("n")))
        counted = counted.select(F.shiftright("kb", BIN_BITS).cast("int").alias("k"), F.col("kb").bitwiseAND((1 << BIN_BITS) - 1).alias("bin"), "n")
        k = "k"
        lo = _per_column(k, [b.min for b in bins])
        width = _per_column(k, [b.width if not b.degenerate else 0.0 for b in bins])
        degenerate = _per_column(k, [b.degenerate for b in bins])
        lo_e = F.when(degenerate, lo).otherwise(lo + F.col("bin") * width)
        hi_e = F.when(degenerate, _per_column(k, [b.max for b in bins])).otherwise(lo + (F.col("bin") + 1) * width)
        if digits is not None:
            lo_e = F.when(degenerate, lo_e).otherwise(F.round(lo_e, digits))
            hi_e = F.when(degenerate, hi_e).otherwise(F.round(hi_e, digits))
        out = counted.select(_per_column(k, list(columns)).alias("variable"), "bin",
                             lo_e.alias("bin_lo"), hi_e.alias("bin_hi"), "n")
        return _kept(df.sparkSession, out)


def binning_frame(spark: SparkSession, b: Binning, edges: int | None = None, digits: int = 6) -> DataFrame:
    """The binning statistics as a one-row table."""
    schema = ("n bigint, n_valid bigint, min double, max double, q1 double, q3 double, "
              "width double, n_edges bigint")
    width = None if b.width is None else round(b.width, digits)
    return spark.createDataFrame([(b.n, b.n_valid, b.min, b.max, b.q1, b.q3, width, edges)], schema)
