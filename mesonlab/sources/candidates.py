"""The candidate table: 26 nullable fields per B candidate and its three hadrons.

The test tables hold no particle data, so the candidate table is derived row
for row from ``lineitem`` with one SQL select list that Spark and the DuckDB
oracle both run (``candidate_select_sql``). ``read_candidates`` loads a stored
candidate table from any Spark file format with the explicit schema, which is
how a real candidate export (once converted from its detector format) is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

HADRONS = ("H1_", "H2_", "H3_")
HADRON_FIELDS = (("PX", T.DoubleType()), ("PY", T.DoubleType()), ("PZ", T.DoubleType()),
                 ("ProbK", T.DoubleType()), ("ProbPi", T.DoubleType()),
                 ("Charge", T.IntegerType()), ("IPChi2", T.DoubleType()),
                 ("isMuon", T.IntegerType()))

CANDIDATE_SCHEMA = T.StructType(
    [T.StructField("B_FlightDistance", T.DoubleType(), True),
     T.StructField("B_VertexChi2", T.DoubleType(), True)]
    + [T.StructField(h + name, dtype, True) for h in HADRONS for name, dtype in HADRON_FIELDS]
)
CANDIDATE_COLUMNS = [f.name for f in CANDIDATE_SCHEMA.fields]

# Columns carried from lineitem so results can be read back row by row.
# (l_orderkey, l_linenumber) is not unique in the test data.
KEY_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# The derivation of each candidate field from lineitem, as
# specified for the test fixture. D(k) is CAST(k AS DOUBLE) so that neither
# engine falls back to decimal arithmetic.
_PROBK = {
    "H1_": "1-l_discount*D(4)",
    "H2_": "1-(l_linenumber-1)*D(0.05)",
    "H3_": "1-l_tax*D(4)",
}
_FIXTURE = {
    "B_FlightDistance": "l_extendedprice/D(1000)",
    "B_VertexChi2": "l_quantity/D(10)",
    "H1_PX": "l_quantity*D(100)-D(2500)",
    "H1_PY": "l_discount*D(10000)",
    "H1_PZ": "l_extendedprice/D(3)",
    "H2_PX": "l_tax*D(10000)",
    "H2_PY": "l_quantity*D(7.5)",
    "H2_PZ": "l_extendedprice/D(2)",
    "H3_PX": "l_suppkey*D(-13.25)",
    "H3_PY": "l_partkey*D(0.37)",
    "H3_PZ": "l_extendedprice/D(7)",
}
for _n, _h in enumerate(HADRONS, start=1):
    _FIXTURE[_h + "ProbK"] = _PROBK[_h]
    _FIXTURE[_h + "ProbPi"] = f"1-({_PROBK[_h]})"
    _FIXTURE[_h + "Charge"] = "CAST(-1 AS INT)" if _n == 2 else "CAST(1 AS INT)"
    _FIXTURE[_h + "IPChi2"] = f"l_quantity*D({_n})"
    _FIXTURE[_h + "isMuon"] = f"CAST(CASE WHEN l_linenumber = {_n} THEN 1 ELSE 0 END AS INT)"


def _expand(expr: str) -> str:
    out, i = [], 0
    while i < len(expr):
        if expr.startswith("D(", i):
            j = expr.index(")", i)
            out.append(f"CAST({expr[i + 2:j]} AS DOUBLE)")
            i = j + 1
        else:
            out.append(expr[i])
            i += 1
    return "".join(out)


def candidate_select_list(keys: bool = True) -> list[str]:
    """``expr AS name`` items, valid in both Spark SQL and DuckDB."""
    items = [f"{k}" for k in KEY_COLUMNS] if keys else []
    return items + [f"{_expand(_FIXTURE[c])} AS {c}" for c in CANDIDATE_COLUMNS]


def candidate_select_sql(source: str = "lineitem", keys: bool = True) -> str:
    return f"SELECT {', '.join(candidate_select_list(keys))} FROM {source}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def candidates_from_lineitem(spark: SparkSession, sf_dir: str, keys: bool = True) -> DataFrame:
    """Candidate rows derived from lineitem; a pure projection, so Catalyst
    prunes it to the lineitem columns a query really uses."""
    return table(spark, sf_dir, "lineitem").selectExpr(*candidate_select_list(keys))


def read_candidates(spark: SparkSession, *paths: str, fmt: str = "parquet",
                    options: dict | None = None) -> DataFrame:
    """Load stored candidate tables with the explicit 26-field schema (all paths,
    unlike a single-path loader)."""
    if not paths:
        raise ValueError("at least one path is required")
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt != "parquet":
        reader = reader.schema(CANDIDATE_SCHEMA)
    df = reader.load(list(paths))
    return df.select(*[df[c].cast(f.dataType).alias(c)
                       for c, f in zip(CANDIDATE_COLUMNS, CANDIDATE_SCHEMA.fields)])
