"""Batch readers: CSV, JSON, Parquet and JDBC.

Options may be given in snake_case or kebab-case; they are passed to Spark in
camelCase (``infer_schema`` -> ``inferSchema``). A ``schema`` option is pulled
out and applied with ``.schema`` so no inference pass runs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _camel(key: str) -> str:
    parts = key.replace("-", "_").split("_")
    return parts[0] + "".join(p[:1].upper() + p[1:] for p in parts[1:])


def camel_options(options: Mapping | None) -> dict:
    return {_camel(str(k)): v for k, v in (options or {}).items()}


def _reader(spark: SparkSession, options: Mapping | None, allow_schema: bool = True):
    options = dict(options or {})
    schema = options.pop("schema", None) if allow_schema else None
    reader = spark.read
    if options:
        reader = reader.options(**{k: str(v) if isinstance(v, bool) else v
                                   for k, v in camel_options(options).items()})
    if schema is not None:
        reader = reader.schema(schema)
    return reader


def _paths(paths) -> list[str]:
    if not paths:
        raise ValueError("at least one path is required")
    return [str(p) for p in paths]


def read_csv(spark: SparkSession, *paths: str, options: Mapping | None = None) -> DataFrame:
    return _reader(spark, options).csv(_paths(paths))


def read_json(spark: SparkSession, *paths: str, options: Mapping | None = None) -> DataFrame:
    return _reader(spark, options).json(_paths(paths))


def read_parquet(spark: SparkSession, *paths: str, options: Mapping | None = None) -> DataFrame:
    # Parquet carries its own schema; a ``schema`` key is passed through as an option.
    return _reader(spark, options, allow_schema=False).parquet(*_paths(paths))


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None) -> DataFrame:
    """JDBC scan. ``user`` and ``password`` are required.

    Without a partition column a JDBC read is a single task; at scale pass
    ``partition_column`` with bounds so Spark issues ``num_partitions`` range
    queries in parallel.
    """
    props = camel_options(properties)
    if props.get("user") is None or props.get("password") is None:
        raise ValueError("JDBC properties must include user and password")
    props = {k: str(v) for k, v in props.items()}
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    if lower_bound is None or upper_bound is None or not num_partitions:
        raise ValueError("a partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions,
                           properties=props)


def parsed_lines(lines: DataFrame, schema: str, column: str = "value", options: Mapping | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, malformed): JSON lines of a batch or streaming frame that fit ``schema``, as
    its columns, and the others as they came. Malformed is what isn't JSON or holds a value
    of another type; a line without some of the fields, or with more, is good."""
    corrupt = "_malformed"
    row = F.from_json(F.col(f"`{column}`"), f"{schema}, {corrupt} string", {**camel_options(options), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    parsed = lines.select(F.col(f"`{column}`").alias("value"), row.alias("r"))
    bad = F.col("r").isNull() | F.col(f"r.{corrupt}").isNotNull()
    names = [f.name for f in parsed.schema["r"].dataType.fields if f.name != corrupt]
    return parsed.where(~bad).select(*[F.col("r")[n].alias(n) for n in names]), parsed.where(bad).select("value")


def split_malformed(lines: DataFrame, schema: str, good: str, quarantine: str, column: str = "value", options: Mapping | None = None, mode: str = "errorifexists") -> None:
    """Writes the good lines' columns to the Parquet folder ``good`` and the malformed lines to
    ``quarantine``: every line goes to one of them."""
    for part, path in zip(parsed_lines(lines, schema, column, options), (good, quarantine)):
        part.write.mode(mode).parquet(path)
