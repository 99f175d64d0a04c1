"""Near-duplicate embeddings by an epsilon grid order join: vectors are sorted by the
grid cells of their leading principal coordinates, the sequence is cut into
intervals, and pairs of intervals are joined recursively: intervals of intervals level by
level as Spark joins, the last ones halved inside a task, skipping those whose bounding
boxes are provably further apart than epsilon."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from mesonlab.llm.common import table, written
from mesonlab.llm.components import components

COSINE = 0.9
#: Vectors of an interval (two are joined in a task) and of a leaf of the recursion.
INTERVAL, LEAF = 4096, 256
#: Principal coordinates that the grid order compares.
GRID_DIMS = 6
#: Intervals of a larger one.
FAN = 16


def _moments(classes: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of the unit vectors: d*(d+1)+1 sums, an array for each task, added
    up in groups of tasks; the driver gets as many arrays as a square root of the tasks."""
    size = dim * dim + dim + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            x = _unit(batch.column(0), dim)
            total += np.concatenate([(x.T @ x).ravel(), x.sum(0), [len(x)]])
        if total[-1]:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["v"])

    def added(group: pa.Table) -> pa.Table:
        return pa.table({"v": pa.array([group["v"].combine_chunks().flatten().to_numpy().reshape(-1, size).sum(0)], pa.list_(pa.float64()))})
    parts = classes.select("v").mapInArrow(sums, "v array<double>").withColumn("part", F.spark_partition_id())
    parts = written(parts, "moments")
    groups = max(int(parts.count() ** 0.5), 1)
    rows = parts.groupBy(F.pmod("part", F.lit(groups)).alias("g")).applyInArrow(added, "v array<double>").toArrow()
    total = rows["v"].combine_chunks().flatten().to_numpy().reshape(-1, size).sum(0)
    n = max(total[-1], 1)
    mean = total[dim * dim:-1] / n
    return mean, total[:dim * dim].reshape(dim, dim) / n - np.outer(mean, mean)


def _unit(lists: pa.Array, dim: int) -> np.ndarray:
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.ldexp(1.0, np.frexp(np.abs(x).max(1, keepdims=True, initial=0))[1] - 1)  # a power of 2: squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _apart(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], eps: float) -> bool:
    gap = np.maximum(np.maximum(a[0] - b[1], b[0] - a[1]), 0)
    return float(gap @ gap) > eps * eps


def _join(x: np.ndarray, y: np.ndarray, rx: np.ndarray, ry: np.ndarray, same: bool, cosine: float, eps: float) -> np.ndarray:
    """Links (as a matrix) between two sequences in grid order: halved recursively."""
    out = np.zeros((len(x), len(y)), bool)
    stack = [(0, len(x), 0, len(y))]
    while stack:
        a, b, c, d = stack.pop()
        if b <= a or d <= c or same and d <= a or _apart((rx[a:b].min(0), rx[a:b].max(0)), (ry[c:d].min(0), ry[c:d].max(0)), eps):
            continue
        if b - a <= LEAF and d - c <= LEAF:
            dots = x[a:b] @ y[c:d].T
            hit = dots >= cosine
            for i, j in zip(*np.nonzero(np.abs(dots - cosine) < 1e-12)):  # rounding of the fast product
                hit[i, j] = float(np.sum(x[a + i] * y[c + j])) >= cosine
            out[a:b, c:d] = hit
            continue
        m, k = (a + b) // 2 if b - a > LEAF else b, (c + d) // 2 if d - c > LEAF else d
        stack.extend([(a, m, c, k), (m, b, c, k), (a, m, k, d), (m, b, k, d)])
    if same:
        out |= out.T
        np.fill_diagonal(out, False)
    return out


def _smallest(links: np.ndarray, ids: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id reachable by the links, for the rows and the columns."""
    rows, cols = ids.copy(), other.copy()
    big = np.iinfo(np.int64).max
    while True:
        before = rows.sum(dtype=np.float64), cols.sum(dtype=np.float64), rows.copy(), cols.copy()
        for lo in range(0, len(rows), LEAF):
            rows[lo:lo + LEAF] = np.minimum(rows[lo:lo + LEAF], np.where(links[lo:lo + LEAF], cols, big).min(1))
        for lo in range(0, len(cols), LEAF):
            cols[lo:lo + LEAF] = np.minimum(cols[lo:lo + LEAF], np.where(links[:, lo:lo + LEAF], rows[:, None], big).min(0))
        if (rows == before[2]).all() and (cols == before[3]).all():
            return rows, cols


def _compare(dim: int, mean: np.ndarray, axes: np.ndarray, cosine: float, eps: float):
    def compare(group: pa.Table) -> pa.Table:
        block, order = group["block"].to_numpy(), group["at"].to_numpy()
        left, right = int(group["a"][0].as_py()), int(group["b"][0].as_py())
        ids, many = group["rep"].to_numpy(), group["many"].to_numpy()
        x = _unit(group["v"].combine_chunks(), dim)
        sides = []
        for side in (left, right):
            at = np.flatnonzero(block == side)
            at = at[np.argsort(order[at], kind="stable")]
            sides.append((x[at], (x[at] - mean) @ axes, ids[at], many[at]))
        (xa, ra, ia, ma), (xb, rb, ib, mb) = sides
        links = _join(xa, xb, ra, rb, left == right, cosine, eps)
        rows, cols = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
        links = links[np.ix_(rows, cols)]
        low, high = _smallest(links, ia[rows], ib[cols])
        out = [(ia[rows], links @ mb[cols], low)]
        if left != right:
            out.append((ib[cols], ma[rows] @ links, high))
        return pa.table({name: np.concatenate([o[k] for o in out]).astype(np.int64) for k, name in enumerate(("rep", "links", "low"))})
    return compare


def _near_boxes(box: DataFrame, count: int, eps: float) -> DataFrame:
    """(a, b), a <= b: intervals whose boxes are within ``eps``. Boxes of FAN consecutive boxes
    make a level; from the one box around all, pairs are opened level by level, and only
    those within ``eps``."""
    def around(group: pa.Table) -> pa.Table:
        lo, hi = (np.stack(group[c].to_numpy()) for c in ("lo", "hi"))
        return pa.table({"block": pa.array([group["up"][0].as_py()], pa.int64()), "lo": pa.array([lo.min(0).tolist()], pa.list_(pa.float64())), "hi": pa.array([hi.max(0).tolist()], pa.list_(pa.float64()))})
    up = F.floor(F.col("block") / FAN).cast("long")
    levels = [written(box, "boxes")]
    while count > 1:
        count = -(-count // FAN)
        levels.append(written(levels[-1].withColumn("up", up).groupBy("up").applyInArrow(around, "block long, lo array<double>, hi array<double>"), "boxes"))
    gap = lambda p, q: F.zip_with(p, q, lambda x, y: F.greatest(x - y, F.lit(0.0)))
    square = lambda z: F.aggregate(z, F.lit(0.0), lambda s, x: s + x * x)
    pairs = levels[-1].select(F.col("block").alias("a"), F.col("block").alias("b"))
    for level in reversed(levels[:-1]):
        left = level.select(up.alias("a"), F.col("block").alias("p"), F.col("lo").alias("plo"), F.col("hi").alias("phi"))
        right = level.select(up.alias("b"), F.col("block").alias("q"), F.col("lo").alias("qlo"), F.col("hi").alias("qhi"))
        both = pairs.join(left, "a").join(right, "b").where((F.col("p") <= F.col("q")) & (square(gap("plo", "qhi")) + square(gap("qlo", "phi")) <= eps * eps))
        pairs = written(both.select(F.col("p").alias("a"), F.col("q").alias("b")), "near-boxes")
    return pairs


def _linked(classes: DataFrame, dim: int, cosine: float) -> DataFrame:
    """(rep, links, low) partial results of all interval pairs of one dimension."""
    eps = float(np.sqrt(2 - 2 * cosine)) + 1e-9
    mean, cov = _moments(classes, dim)
    axes = np.linalg.eigh(cov)[1][:, ::-1].copy()
    lead = min(GRID_DIMS, dim)

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = (_unit(batch.column(2), dim) - mean) @ axes[:, :lead]
            cells = np.floor(y / eps).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(cells), pa.list_(pa.int64())), pa.array(y[:, 0])], ["rep", "many", "v", "cells", "y0"])
    kind = classes.schema["v"].dataType.simpleString()
    n = classes.count()
    located_ = classes.select("rep", "many", "v").mapInArrow(located, f"rep long, many long, v {kind}, cells array<long>, y0 double")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(seen, seen + len(batch)))], ["rep", "many", "v", "part", "at"])
            seen += len(batch)
    ordered = located_.repartitionByRange(max(-(-n // (4 * INTERVAL)), 1), "cells", "y0", "rep").sortWithinPartitions("cells", "y0", "rep")
    ordered = written(ordered.select("rep", "many", "v", F.spark_partition_id().alias("part")).mapInArrow(numbered, f"rep long, many long, v {kind}, part int, at long"), "sequence")
    sizes = dict(ordered.groupBy("part").agg(F.count(F.lit(1))).collect())  # a row per partition of the sort
    parts = sorted(sizes)
    before = classes.sparkSession.createDataFrame(list(zip(parts, np.concatenate(([0], np.cumsum([sizes[p] for p in parts])[:-1])).tolist())), "part int, before long")
    place = F.col("before") + F.col("at")
    ordered = ordered.join(F.broadcast(before), "part").select("rep", "many", "v", F.floor(place / INTERVAL).cast("long").alias("block"), place.alias("at"))

    def boxes(group: pa.Table) -> pa.Table:
        y = (_unit(group["v"].combine_chunks(), dim) - mean) @ axes
        return pa.table({"block": pa.array([group["block"][0].as_py()], pa.int64()), "lo": pa.array([y.min(0).tolist()], pa.list_(pa.float64())), "hi": pa.array([y.max(0).tolist()], pa.list_(pa.float64()))})
    box = ordered.select("block", "v").groupBy("block").applyInArrow(boxes, "block long, lo array<double>, hi array<double>")
    pairs = _near_boxes(box, -(-n // INTERVAL), eps)
    sides = written(pairs, "interval-pairs")
    sides = sides.select("a", "b", F.col("a").alias("block")).union(sides.where("a < b").select("a", "b", "b"))
    tasks = ordered.join(sides, "block").select("a", "b", "block", "at", "rep", "many", "v")
    return tasks.groupBy("a", "b").applyInArrow(_compare(dim, mean, axes, cosine, eps), "rep long, links long, low long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id, kept.

    Equal vectors are one class with a count, so copies make no pairs; a task joins
    two intervals and returns a sum of links and a smallest neighbour per vector,
    never its pairs. Every link is found. Vectors that are null, zero or hold null or
    non-finite components link with nothing, nor do vectors of different lengths; a
    null id takes no part (component_id null, kept true). Rows are kept as they are.
    Arrays of floats are compared as they come, of any other numbers as doubles."""
    kind = "float" if isinstance(vectors.select(F.col(f"`{vector_col}`")).schema[0].dataType.elementType, FloatType) else "double"
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast(f"array<{kind}>").alias("v"))
    usable = (F.col("v").isNotNull() & F.col("vec_id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("v", lambda x: x != 0))
    rows = written(rows.withColumn("ok", F.coalesce(usable, F.lit(False))).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), F.reverse("v"))), "vectors")
    good = rows.where("ok")
    classes = written(good.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many"), F.first("v").alias("v")), "vector-classes")
    dims = [r[0] for r in classes.select(F.size("v").alias("d")).distinct().collect()]  # the lengths that occur
    partial = None
    for d in sorted(dims):
        got = _linked(classes.where(F.size("v") == d), d, cosine)
        partial = got if partial is None else partial.union(got)
    ids = classes.select("h1", "h2", "rep", "many")
    if partial is None:
        ids = ids.select("h1", "h2", "many", F.lit(0).cast("long").alias("links"), F.col("rep").alias("comp"))
    else:
        partial = written(partial, "vector-links")
        links = partial.groupBy("rep").agg(F.sum("links").alias("links"))
        found = components(partial.select(F.col("rep").alias("a"), F.col("low").alias("b")))
        ids = ids.join(links, "rep", "left").join(found, ids["rep"] == found["node"], "left").select(
            "h1", "h2", "many", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("comp"))
    out = rows.join(ids.withColumn("ok", F.lit(True)), ["h1", "h2", "ok"], "left")
    component = F.when(F.col("ok"), F.col("comp")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(F.col("ok"), F.col("links") + F.col("many") - 1).otherwise(0).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op8_embeddings(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all ``embeddings``."""
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
