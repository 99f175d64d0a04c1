"""Accumulated bin edges without a list of them.

The edges are ``first, first + width, (first + width) + width, ...`` in doubles. Between
two powers of two the numbers are evenly spaced, so adding ``width`` adds the same whole
number of spacings each time (after at most one step that differs, where the rounding is
a tie). Only powers from the width to 2^53 widths can occur, so a few hundred runs (first
index, first edge, step, edges) give every edge, and the index of any value by a binary
search among the runs and one division, whatever the number of edges."""

from __future__ import annotations

import math
import sys
from bisect import bisect_right
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the out-of-range sentinel bin (Java Double.MAX_VALUE).
SENTINEL = sys.float_info.max


@dataclass(frozen=True)
class Run:
    """``many`` edges from number ``index`` on: ``first + k * step``, all exact."""
    index: int
    first: float
    step: float
    many: int


def _same_spacing(*values: float) -> bool:
    """Whether doubles lie between the same two powers of two, on one side of zero."""
    places = {(math.copysign(1, v), max(math.frexp(v)[1], -1021)) for v in values}
    return len(places) == 1 and 0.0 not in values


def _steps_inside(edge: float, step: float) -> int:
    """Steps from ``edge`` that surely stay between its two powers of two."""
    ulp = math.ulp(edge)
    units, each = int(abs(edge) / ulp), int(step / ulp)
    if edge > 0:
        return ((1 << 53) - 1 - units) // each if units >> 52 else ((1 << 52) - 1 - units) // each
    least = (1 << 52) + 1 if units >> 52 else 1
    return (units - least) // each


def _runs(first: float, width: float, end: float) -> list[Run]:
    out, index, edge = [], 0, first
    while edge < end:
        after = edge + width
        if after == edge:
            raise ValueError("bin width below floating-point resolution at this magnitude")
        step, many = after - edge, 1
        if _same_spacing(edge, after, after + width) and (after + width) - after == step:
            many = max(_steps_inside(edge, step), 1)
            inside = max(math.ceil((end - edge) / step), 1)  # edges below the end, give or take one
            while inside > 1 and edge + (inside - 1) * step >= end:
                inside -= 1
            while edge + inside * step < end and inside < many:
                inside += 1
            many = min(many, inside)
        out.append(Run(index, edge, step, many))
        index, edge = index + many, (edge + (many - 1) * step) + width
    return out


class Edges(Sequence):
    """Strictly increasing edges, as runs."""

    def __init__(self, runs: list[Run]):
        self.runs = runs
        self._index = [r.index for r in runs]

    @classmethod
    def accumulated(cls, first: float, width: float, end: float) -> "Edges":
        """From ``first`` in steps of ``width``, added one by one, while below ``end``."""
        return cls(_runs(first, width, end))

    @classmethod
    def of(cls, edges: "Edges | Iterable[float]") -> "Edges":
        """A caller's own edges."""
        if isinstance(edges, Edges):
            return edges
        edges = [float(e) for e in edges]
        if not edges:
            raise ValueError("at least one edge is required")
        if any(math.isnan(e) or math.isinf(e) for e in edges):
            raise ValueError("edges must be finite")
        if any(b <= a for a, b in zip(edges, edges[1:])):
            raise ValueError("edges must be strictly increasing")
        return cls([Run(i, e, 1.0, 1) for i, e in enumerate(edges)])

    def __len__(self) -> int:
        return self.runs[-1].index + self.runs[-1].many if self.runs else 0

    def __getitem__(self, i):
        if isinstance(i, slice):
            return [self[k] for k in range(*i.indices(len(self)))]
        n = len(self)
        if not -n <= i < n:
            raise IndexError("edge number out of range")
        r = self.runs[bisect_right(self._index, i % n) - 1]
        return r.first + (i % n - r.index) * r.step

    def __iter__(self):
        return (r.first + k * r.step for r in self.runs for k in range(r.many))

    def __eq__(self, other) -> bool:
        return len(self) == len(other) and all(a == b for a, b in zip(self, other))

    # ---- on arrays ----

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """first edge, step, edges and first index of every run."""
        return (np.array([r.first for r in self.runs]), np.array([r.step for r in self.runs]),
                np.array([r.many for r in self.runs], np.float64), np.array([r.index for r in self.runs], np.int64))

    # ---- as columns ----

    def _column(self, name: str, run: Column) -> Column:
        # one constant array: folded when the query is planned, not made again for each row
        kind = "L" if name == "index" else "D"
        return F.element_at(F.expr(f"array({','.join(f'{getattr(r, name)!r}{kind}' for r in self.runs)})"), run)

    def _run(self, df: DataFrame, value: Column, starts: list[float], out: str) -> DataFrame:
        """Number (from 1) of the run that ``value`` lies in; beyond the first and the last
        run, those."""
        if len(starts) == 1:
            return df.withColumn(out, F.lit(1))
        cut = Bucketizer(splits=[-math.inf, *starts[1:], math.inf], inputCol=f"{out}_x", outputCol=out, handleInvalid="keep")
        df = cut.transform(df.withColumn(f"{out}_x", value.cast("double"))).drop(f"{out}_x")
        return df.withColumn(out, F.least(F.col(out).cast("int") + 1, F.lit(len(starts))))

    def with_bin(self, df: DataFrame, column: str, index: str = "_bin") -> DataFrame:
        """``df`` with the number of the edge at or below the value of ``column`` as ``index``:
        -1 below the first edge or at or beyond the last one, the last edge for NaN, null
        for null. A projection: no join, no shuffle."""
        x = F.col(f"`{column}`").cast("double")
        run = f"{index}_run"
        df = self._run(df, x, [r.first for r in self.runs], run)
        first, step, many = (self._column(c, F.col(run)) for c in ("first", "step", "many"))
        x0 = F.floor((x - first) / step)
        k = F.greatest(F.least(x0.cast("double"), many - 1), F.lit(0.0))
        df = df.withColumn(f"{index}_k", F.when(F.isnan(x) | (F.abs(x) == F.lit(math.inf)), F.lit(0.0)).otherwise(k))
        k = F.col(f"{index}_k")
        k = (F.when(first + k * step > x, k - 1).when((k + 1 < many) & (first + (k + 1) * step <= x), k + 1).otherwise(k))
        number = (F.when(x.isNull(), F.lit(None).cast("long")).when(F.isnan(x), F.lit(len(self) - 1))
                  .when((x < F.lit(self[0])) | (x >= F.lit(self[-1])), F.lit(-1)).otherwise(self._column("index", F.col(run)) + k.cast("long")))
        return df.withColumn(index, number).drop(run, f"{index}_k")

    def with_edge(self, df: DataFrame, index: str, out: str) -> DataFrame:
        """``df`` with the edge of number ``index`` as ``out``; the sentinel for -1."""
        run = f"{out}_run"
        df = self._run(df, F.col(f"`{index}`"), [float(r.index) for r in self.runs], run)
        first, step, start = (self._column(c, F.col(run)) for c in ("first", "step", "index"))
        edge = first + (F.col(f"`{index}`") - start).cast("double") * step
        return df.withColumn(out, F.when(F.col(f"`{index}`") < 0, F.lit(SENTINEL)).otherwise(edge)).drop(run)

    def frame(self, spark: SparkSession) -> DataFrame:
        """(i, edge): every edge, made on the executors."""
        return self.with_edge(spark.range(len(self)).withColumnRenamed("id", "i"), "i", "edge") if self.runs else spark.createDataFrame([], "i bigint, edge double")


def bin_values(arrays: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """Left edge of the bin of each value, by the rules of ``Edges.with_bin``."""
    first, step, many, _ = arrays
    run = np.maximum(np.searchsorted(first, x, side="right") - 1, 0)
    run[np.isnan(x)] = len(first) - 1
    with np.errstate(invalid="ignore", over="ignore"):
        k = np.clip(np.nan_to_num(np.floor((x - first[run]) / step[run])), 0, many[run] - 1)
        k = np.where(first[run] + k * step[run] > x, k - 1, k)
        k = np.where((k + 1 < many[run]) & (first[run] + (k + 1) * step[run] <= x), k + 1, k)
        last = first[-1] + (many[-1] - 1) * step[-1]
        out = np.where((x < first[0]) | (x >= last), SENTINEL, first[run] + k * step[run])
    return np.where(np.isnan(x), last, out)
