"""User functions: Arrow-batched only, never row-at-a-time.

* ``column_udf``  — a vectorised function of one or more columns (pandas UDF);
* ``register_udf3`` — the same, registered under a name for SQL;
* ``dataset_map`` — a function over Arrow record batches with an explicit
  output schema (``mapInArrow``), partition-parallel, no shuffle.
Native Column expressions remain the first choice; these are for functions
that the user supplies.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesonlab.functions.kinematics import KAON_MASS_MEV
from mesonlab.operators.edges import Edges, bin_values
from mesonlab.session import ship_package


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def column_udf(fn: Callable[..., pd.Series], return_type: str = "double"):
    """Wrap a vectorised pandas function as a Column function."""
    ship_package(SparkSession.getActiveSession())
    return F.pandas_udf(fn, return_type)


def histogram_bin_udf(edges: Edges | Sequence[float]):
    """The bin assignment as a user function of one column; null stays null. The runs of
    the edges are broadcast once, not sent with every task."""
    arrays = Edges.of(edges).arrays()
    shared = SparkSession.getActiveSession().sparkContext.broadcast(arrays)
    fn = column_udf(lambda x: pd.Series(bin_values(shared.value, x.to_numpy(dtype=np.float64))), "double")
    return lambda col: F.when(col.isNull(), F.lit(None).cast("double")).otherwise(fn(col))


def momentum_magnitude(px: pd.Series, py: pd.Series, pz: pd.Series) -> pd.Series:
    return np.sqrt(px * px + py * py + pz * pz)


def register_udf3(spark: SparkSession, name: str, fn: Callable, return_type: str = "double") -> str:
    """Register a three-argument vectorised function for SQL; returns its name."""
    ship_package(spark)
    spark.udf.register(name, F.pandas_udf(fn, return_type))
    return name


def register_sql_function(spark: SparkSession, name: str, parameters: dict[str, str], return_type: str, body: str) -> str:
    """Register an SQL expression as a function of named, typed parameters for the session:
    the optimiser puts it in line, so nothing leaves the JVM. Returns its name. User code
    that SQL can't express is what ``register_udf3`` is for."""
    if not parameters:
        raise ValueError("a function needs at least one parameter")
    typed = ", ".join(f"{p} {t}" for p, t in parameters.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({typed}) RETURNS {return_type} RETURN {body}")
    return name


def dataset_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, input_columns=None) -> DataFrame:
    """Apply ``fn`` to every Arrow record batch of every partition. ``input_columns``
    names the columns that ``fn`` reads: Spark can't see into it to prune the scan."""
    ship_package(df.sparkSession)

    def run(batches):
        for batch in batches:
            yield fn(batch)
    return (df.select(*input_columns) if input_columns else df).mapInArrow(run, schema)


B_MASS_BATCH_SCHEMA = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, B_M double"


B_MASS_BATCH_INPUT = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      *[f"H{h}_{axis}" for h in (1, 2, 3) for axis in ("PX", "PY", "PZ")]]


def b_mass_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """B mass from the three hadron momenta of one batch (nulls propagate),
    in the same operation order as the column expressions."""
    col = batch.column
    m2 = KAON_MASS_MEV * KAON_MASS_MEV

    def sq(a):
        return pc.multiply(a, a)

    energies, sums = [], {"PX": None, "PY": None, "PZ": None}
    for h in ("H1_", "H2_", "H3_"):
        px, py, pz = col(h + "PX"), col(h + "PY"), col(h + "PZ")
        e2 = pc.add(pc.add(pc.add(pa.scalar(m2), sq(px)), sq(py)), sq(pz))
        energies.append(pc.sqrt(e2))
        for axis, a in (("PX", px), ("PY", py), ("PZ", pz)):
            sums[axis] = a if sums[axis] is None else pc.add(sums[axis], a)
    e = pc.add(pc.add(energies[0], energies[1]), energies[2])
    p2 = pc.add(pc.add(sq(sums["PX"]), sq(sums["PY"])), sq(sums["PZ"]))
    mass = pc.sqrt(pc.subtract(sq(e), p2))
    return pa.RecordBatch.from_arrays(
        [col("l_orderkey"), col("l_linenumber"), col("l_partkey"), col("l_suppkey"), mass],
        names=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "B_M"])
