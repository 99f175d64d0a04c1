"""DataFrame verbs with the argument checks of the reference API.

These are the plain Spark calls; the functions exist so that empty argument
lists fail early with a clear message, and so that sort / take / first /
sample have one documented meaning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F


def _non_empty(items, what: str) -> list:
    items = list(items)
    if not items:
        raise ValueError(f"{what} needs at least one argument")
    return items


def select(df: DataFrame, columns: Sequence) -> DataFrame:
    """Columns by name or as Column expressions."""
    return df.select(*_non_empty(columns, "select"))


def select_expr(df: DataFrame, exprs: Sequence[str]) -> DataFrame:
    return df.selectExpr(*_non_empty(exprs, "select_expr"))


def where(df: DataFrame, condition: Column | str) -> DataFrame:
    """Filter by a Column or an SQL condition string."""
    return df.where(condition)


def with_column(df: DataFrame, name: str, column: Column) -> DataFrame:
    return df.withColumn(name, column)


def with_columns(df: DataFrame, columns: dict) -> DataFrame:
    """Several columns in one projection (cheaper to analyse than a chain)."""
    return df.withColumns(columns)


def group_by(df: DataFrame, *columns: str) -> GroupedData:
    """Grouping for ``.agg``; Spark plans a partial (map-side) and a final
    aggregate, so only one row per group and task crosses the shuffle."""
    return df.groupBy(*_non_empty(columns, "group_by"))


def row_count(df: DataFrame) -> int:
    return df.count()


def count_frame(df: DataFrame) -> DataFrame:
    """``count`` as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def min_max(df: DataFrame, column: str) -> DataFrame:
    """One-row min and max, named ``min(col)`` / ``max(col)`` as Spark does."""
    return df.agg(F.min(column), F.max(column))


def sort(df: DataFrame, *columns) -> DataFrame:
    """Ascending sort by names and/or Column expressions (a global sort:
    range-partitioned shuffle, then per-partition sorts)."""
    return df.sort(*_non_empty(columns, "sort"))


def take_frame(df: DataFrame, n: int, *order) -> DataFrame:
    """The first ``n`` rows as a DataFrame. With an ordering Spark plans
    TakeOrderedAndProject: a bounded top-n per task, no full sort."""
    if n < 0:
        raise ValueError("n must be non-negative")
    return (df.sort(*order) if order else df).limit(n)


def take(df: DataFrame, n: int) -> list:
    return df.take(n)


def first(df: DataFrame):
    return df.first()


def sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample without replacement. Keywords keep the seed (a bare
    positional fraction plus ``seed=`` would be read differently)."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_keys(df: DataFrame, fraction: float, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """Bernoulli sample decided by a hash of ``seed`` and the keys: the same rows whatever
    the partitions, the order and the cluster. Rows with equal keys stay or go together;
    a null key counts as the text ``null``. The first 13 hex digits of the MD5 are compared as
    text, which is their order as numbers."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    keys = _non_empty(keys, "sample_by_keys")
    if fraction == 1.0:
        return df
    text = F.concat(F.lit(str(seed)), *[x for k in keys for x in (F.lit("|"), F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("null")))])
    return df.where(F.substring(F.md5(text), 1, 13) < f"{int(fraction * 16 ** 13):013x}")


def cache(df: DataFrame) -> DataFrame:
    return df.cache()


def columns(df: DataFrame) -> list[str]:
    return list(df.columns)
