"""SQL oracles (DuckDB dialect) for the registered queries.

Each string runs on the raw tables registered as views. The candidate table is
the same select list the Spark side uses; kinematics repeat the Spark
expression order exactly (squares as ``x*x``, sums left to right) so results
are bit-equal; anything derived from a cube root is rounded to 6 places.
Queries whose result depends on sampling or sketches are left out (the driver
then checks rows only): ``sample``, ``approx_quantile_001``,
``histogram_fd_approx``.
"""

from __future__ import annotations

from mesonlab.plans.queries import (
    NARROW, NOTEBOOK_COLUMNS, PERCENTILE_COLUMNS, QUANTILE_PROBS, SKETCHED, STAT_COLUMNS, STRING_COLUMNS, SUMMARY_STATS,
)
from mesonlab.sources.candidates import CANDIDATE_COLUMNS, KEY_COLUMNS, candidate_select_sql

KEYS = ", ".join(KEY_COLUMNS)
MASS = "CAST(493.677 AS DOUBLE)"
P07 = "CAST(0.7 AS DOUBLE)"
SENTINEL_SQL = "CAST(1.7976931348623157e308 AS DOUBLE)"


def _p2(h):
    return f"{h}PX*{h}PX + {h}PY*{h}PY + {h}PZ*{h}PZ"


def _e2(h):
    return f"{MASS}*{MASS} + {h}PX*{h}PX + {h}PY*{h}PY + {h}PZ*{h}PZ"


HS = ("H1_", "H2_", "H3_")
CAND = f"cand AS ({candidate_select_sql('lineitem')})"
CAND_NOKEYS = f"cand AS ({candidate_select_sql('lineitem', keys=False)})"
MASS_CTES = (
    CAND + ",\n"
    + "m1 AS (SELECT *, "
    + ", ".join(f"{_p2(h)} AS {h}P2, sqrt({_p2(h)}) AS {h}P" for h in HS) + ", "
    + ", ".join(f"{_e2(h)} AS {h}E2, sqrt({_e2(h)}) AS {h}E" for h in HS) + ", "
    + ", ".join(f"H1_{a} + H2_{a} + H3_{a} AS B_{a}" for a in ("PX", "PY", "PZ"))
    + " FROM cand),\n"
    + "m2 AS (SELECT *, B_PX*B_PX + B_PY*B_PY + B_PZ*B_PZ AS B_P2, "
      "sqrt(B_PX*B_PX + B_PY*B_PY + B_PZ*B_PZ) AS B_P, H1_E + H2_E + H3_E AS B_E FROM m1),\n"
    + "m3 AS (SELECT *, B_E*B_E AS B_E2, sqrt(B_E*B_E - (B_PX*B_PX + B_PY*B_PY + B_PZ*B_PZ)) AS B_M FROM m2)"
)
SELECTION = (f"B_VertexChi2 >= {P07} AND H1_ProbK >= {P07} AND H2_ProbK >= {P07} "
             f"AND H3_ProbK >= {P07}")
SEL_CTES = MASS_CTES + f",\nsel AS (SELECT {KEYS}, B_M FROM m3 WHERE {SELECTION})"

B_MASS_COLUMNS = ["H1_P2", "H1_P", "H2_P2", "H2_P", "H3_P2", "H3_P", "H1_E2", "H1_E", "H2_E2",
                  "H2_E", "H3_E2", "H3_E", "B_PX", "B_PY", "B_PZ", "B_P2", "B_P", "B_E", "B_E2", "B_M"]


def _binning_ctes(source: str, column: str) -> str:
    """FD statistics ``w`` and accumulated edges ``e(i, x)`` over ``source.column``."""
    return (
        f"vals AS (SELECT {column} AS v FROM {source}),\n"
        "ok AS (SELECT v FROM vals WHERE v IS NOT NULL AND NOT isnan(v) AND NOT isinf(v)),\n"
        "s AS (SELECT (SELECT count(*) FROM vals) AS n, count(*) AS n_valid, min(v) AS mn, max(v) AS mx,\n"
        "      quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3 FROM ok),\n"
        "w AS (SELECT *, 2*(q3-q1)/cbrt(n) AS width FROM s),\n"
        "e(i, x) AS (SELECT 0, mn FROM w UNION ALL\n"
        "            SELECT e.i + 1, e.x + w.width FROM e, w WHERE w.width > 0 AND e.x + w.width < w.mx)"
    )


def _fd_histogram(source: str, column: str, ctes: str) -> str:
    return (
        f"WITH RECURSIVE {ctes},\n{_binning_ctes(source, column)},\n"
        "b AS (SELECT CASE WHEN w.width = 0 OR w.mn = w.mx THEN CAST(0 AS BIGINT)\n"
        "                  ELSE CAST(floor((ok.v - w.mn) / w.width) AS BIGINT) END AS bin FROM ok, w)\n"
        "SELECT b.bin,\n"
        "  CASE WHEN w.width = 0 OR w.mn = w.mx THEN w.mn ELSE round(w.mn + b.bin * w.width, 6) END AS bin_lo,\n"
        "  CASE WHEN w.width = 0 OR w.mn = w.mx THEN w.mx ELSE round(w.mn + (b.bin + 1) * w.width, 6) END AS bin_hi,\n"
        "  count(*) AS n\n"
        "FROM b, w GROUP BY b.bin, w.mn, w.mx, w.width"
    )


def _bin_expr(v: str) -> str:
    """Fixed-edge bin of ``v`` against edges ``e``, rounded unless sentinel."""
    return (
        f"CASE WHEN {v} IS NULL THEN NULL\n"
        f"     WHEN isnan({v}) THEN round((SELECT max(x) FROM e), 6)\n"
        f"     WHEN {v} < (SELECT min(x) FROM e) OR {v} >= (SELECT max(x) FROM e) THEN {SENTINEL_SQL}\n"
        f"     ELSE round((SELECT max(x) FROM e WHERE x <= {v}), 6) END"
    )


def _quantiles(source: str, column: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT CAST({p!r} AS DOUBLE) AS p, quantile_disc({column}, {p!r}) AS q FROM {source} "
        f"WHERE {column} IS NOT NULL AND NOT isnan({column})"
        for p in QUANTILE_PROBS)


def _stats_rows(stats, columns=STAT_COLUMNS) -> str:
    fn = {"count": "CAST(count({c}) AS DOUBLE)", "mean": "avg({c})", "stddev": "stddev_samp({c})",
          "min": "min({c})", "max": "max({c})", "25%": "quantile_disc({c}, 0.25)",
          "50%": "quantile_disc({c}, 0.5)", "75%": "quantile_disc({c}, 0.75)"}
    return "\nUNION ALL\n".join(
        f"SELECT '{st}' AS summary, "
        + ", ".join(f"round(CAST({fn[st].format(c=c)} AS DOUBLE), 6) AS {c}" for c in columns)
        + " FROM lineitem" for st in stats)


_SCAN = f"SELECT {KEYS}, {', '.join(CANDIDATE_COLUMNS)} FROM cand"
_BIN_ASSIGN = (f"WITH RECURSIVE {SEL_CTES},\n{_binning_ctes('sel', 'B_M')}\n"
               f"SELECT {KEYS}, B_M, {_bin_expr('B_M')} AS bin FROM sel")

def _string_rows(stats) -> str:
    """One row per statistic of the string columns, as text."""
    made = {"count": "CAST(count({c}) AS VARCHAR)", "min": "min({c})", "max": "max({c})"}
    return " UNION ALL ".join(
        f"SELECT '{t}' AS summary, " + ", ".join(made.get(t, "CAST(NULL AS VARCHAR)").format(c=c) + f" AS {c}" for c in STRING_COLUMNS)
        + (" FROM lineitem" if t in made else "") for t in stats)


_QUARANTINE = ("SELECT CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'quarantined' ELSE 'good' END AS kind, count(*) AS n, "
               "max(CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN o_totalprice END) AS max_price FROM orders GROUP BY 1")

ORACLE_SQL: dict[str, str] = {
    "sum_cols": f"WITH {CAND} SELECT {KEYS}, H1_PX + H2_PX + H3_PX AS px_sum FROM cand",
    "sum_squares": f"WITH {CAND} SELECT {KEYS}, {_p2('H1_')} AS p2_sum FROM cand",
    "momentum": f"WITH {CAND} SELECT {KEYS}, {_p2('H1_')} AS H1_P2, sqrt({_p2('H1_')}) AS H1_P FROM cand",
    "energy": f"WITH {CAND} SELECT {KEYS}, {_e2('H2_')} AS H2_E2, sqrt({_e2('H2_')}) AS H2_E FROM cand",
    "four_momentum": f"WITH {MASS_CTES} SELECT {KEYS}, B_PX, B_PY, B_PZ, B_E FROM m2",
    "invariant_mass": f"WITH {MASS_CTES} SELECT {KEYS}, sqrt(B_E*B_E - (B_PX*B_PX + B_PY*B_PY + B_PZ*B_PZ)) AS mass FROM m2",
    "b_mass": f"WITH {MASS_CTES} SELECT {KEYS}, {', '.join(B_MASS_COLUMNS)} FROM m3",
    "candidate_selection": f"WITH {SEL_CTES} SELECT * FROM sel",
    "strict_selection": (f"WITH {MASS_CTES} SELECT {KEYS}, B_M FROM m3 WHERE H1_ProbK = CAST(1 AS DOUBLE) "
                         "AND H2_ProbK = CAST(1 AS DOUBLE) AND H3_ProbK = CAST(1 AS DOUBLE)"),
    "select_cols": f"WITH {CAND} SELECT {KEYS}, {', '.join(NARROW)} FROM cand",
    "select_expr": (f"WITH {CAND} SELECT {KEYS}, H1_PX + H2_PX + H3_PX AS px_sum, "
                    "sqrt(H1_PX * H1_PX + H1_PY * H1_PY) AS h1_pt, "
                    "CASE WHEN H1_Charge + H2_Charge + H3_Charge > 0 THEN 'plus' ELSE 'minus' END AS b_charge FROM cand"),
    "where_column": f"WITH {CAND} SELECT {KEYS}, B_VertexChi2 FROM cand WHERE B_VertexChi2 >= {P07}",
    "where_sql": (f"WITH {CAND} SELECT {KEYS}, H1_ProbK, H3_ProbK FROM cand "
                  f"WHERE H1_ProbK >= {P07} AND H3_ProbK >= {P07}"),
    "with_column": f"WITH {CAND} SELECT {KEYS}, sqrt(H1_PX*H1_PX + H1_PY*H1_PY) AS H1_PT FROM cand",
    "group_by_agg": (
        "SELECT l_returnflag, l_linestatus, count(*) AS n, "
        "CAST(sum(CAST(l_quantity AS DECIMAL(28,6))) AS DOUBLE) AS sum_qty, "
        "CAST(sum(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS sum_price, "
        "min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price, "
        "round(avg(l_discount), 6) AS avg_disc FROM lineitem GROUP BY l_returnflag, l_linestatus"),
    "group_by": ("SELECT l_shipdate, l_returnflag, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, max(l_tax) AS max_tax "
                 "FROM lineitem GROUP BY l_shipdate, l_returnflag"),
    # whole numbers of 2^-80, added as such; the sum's 53 leading bits are kept by the last cast
    "exact_sums": (f"WITH {CAND}, scaled AS (SELECT l_linenumber, CAST(H1_PX * CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 1 / CAST(1099511627776 AS DOUBLE) END "
                   "* power(CAST(2 AS DOUBLE), 80) AS HUGEINT) AS units FROM cand) "
                   "SELECT l_linenumber, CAST(sum(units) AS DOUBLE) / power(CAST(2 AS DOUBLE), 80) AS sum_px, count(*) AS n FROM scaled GROUP BY l_linenumber"),
    "sketch_totals": "\nUNION ALL\n".join(f"SELECT '{c}' AS variable, count(*) AS n, count({c}) AS n_valid, min({c}) AS lo, max({c}) AS hi FROM lineitem" for c in SKETCHED),
    "sketch_quantile_bounds": ("SELECT variable, CAST(p AS DOUBLE) AS p, true AS within FROM "
                               f"(VALUES {', '.join(f'({p})' for p in QUANTILE_PROBS)}) v(p), (VALUES {', '.join(repr((c,)).replace(',)', ')') for c in SKETCHED)}) w(variable)"),
    "sample_by_keys": (f"WITH {SEL_CTES} SELECT * FROM sel WHERE substr(md5('7' || " + " || ".join(f"'|' || coalesce(CAST({k} AS VARCHAR), 'null')" for k in KEY_COLUMNS)
                       + f"), 1, 13) < '{int(0.1 * 16 ** 13):013x}'"),
    "bucketed_join": ("SELECT o_orderkey, o_totalprice, n, most FROM orders JOIN "
                      "(SELECT l_orderkey, count(*) AS n, max(l_quantity) AS most FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey"),
    "bucket_metadata": "SELECT CAST(16 AS INTEGER) AS buckets, 'l_orderkey' AS bucket_columns, 'l_orderkey' AS sort_columns",
    "quarantine": _QUARANTINE,
    "stream_quarantine": _QUARANTINE,
    "sql_function": f"WITH {CAND} SELECT {KEYS}, sqrt({_p2('H1_')}) AS H1_P FROM cand",
    "row_count": f"WITH {MASS_CTES} SELECT count(*) AS n FROM m3 WHERE {SELECTION}",
    "min_max": f'WITH {SEL_CTES} SELECT min(B_M) AS "min(B_M)", max(B_M) AS "max(B_M)" FROM sel',
    "describe": _stats_rows(("count", "mean", "stddev", "min", "max")),
    "describe_strings": _string_rows(("count", "mean", "stddev", "min", "max")),
    "summary_strings": _string_rows(("count", "min", "max")),
    "approx_quantile_bounds": f"SELECT CAST(p AS DOUBLE) AS p, true AS within FROM (VALUES {', '.join(f'({p})' for p in QUANTILE_PROBS)}) v(p)",
    "sort_all": f"WITH {SEL_CTES} SELECT * FROM sel ORDER BY B_M DESC, {KEYS}",
    "sample_properties": "SELECT true AS subset, true AS same_seed_same_rows, true AS size_as_expected",
    "summary": _stats_rows(SUMMARY_STATS),
    "summary_percentiles": _stats_rows(("count", "mean", "stddev", "min", "25%", "50%", "75%", "max"),
                                       PERCENTILE_COLUMNS),
    "approx_quantile": f"WITH {SEL_CTES}\n{_quantiles('sel', 'B_M')}",
    "exact_quantile": _quantiles("lineitem", "l_extendedprice"),
    "fd_binning": (f"WITH RECURSIVE {SEL_CTES},\n{_binning_ctes('sel', 'B_M')}\n"
                   "SELECT n, n_valid, mn AS min, mx AS max, q1, q3, round(width, 6) AS width, "
                   "(SELECT count(*) FROM e) AS n_edges FROM w"),
    "bin_edges": (f"WITH RECURSIVE {SEL_CTES},\n{_binning_ctes('sel', 'B_M')}\n"
                  "SELECT CAST(i AS BIGINT) AS i, round(x, 6) AS edge FROM e"),
    "bin_assign": _BIN_ASSIGN,
    "histogram_edges": f"SELECT bin, count(*) AS n FROM ({_BIN_ASSIGN}) GROUP BY bin",
    "histogram_fd": _fd_histogram("sel", "B_M", SEL_CTES),
    "histogram_fd_all": _fd_histogram("m3", "B_M", MASS_CTES),
    "column_histogram": _fd_histogram("cand", "H1_PX", CAND),
    "column_histograms": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS variable, * FROM ({_fd_histogram('m3', c, MASS_CTES)})" for c in NOTEBOOK_COLUMNS),
    "sort_take": f"WITH {SEL_CTES} SELECT * FROM sel ORDER BY B_M DESC, {KEYS} LIMIT 20",
    "first_row": f"WITH {SEL_CTES} SELECT * FROM sel ORDER BY {KEYS}, B_M LIMIT 1",
    "csv_scan": f"WITH {CAND} {_SCAN}",
    "json_roundtrip": f"WITH {CAND} {_SCAN}",
    "parquet_multi_path": f"SELECT {KEYS}, l_returnflag, l_extendedprice FROM lineitem",
    "parquet_partitioned": (f"SELECT {KEYS}, l_extendedprice, l_returnflag FROM lineitem "
                            "WHERE l_returnflag = 'A'"),
    "save_modes": ("SELECT 'append' AS stage, l_returnflag, 2 * count(*) AS n FROM lineitem GROUP BY l_returnflag "
                   "UNION ALL SELECT 'overwrite' AS stage, l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag"),
    "dataset_catalog": f"WITH {CAND_NOKEYS} SELECT {', '.join(CANDIDATE_COLUMNS)} FROM cand",
    "candidate_scan": f"WITH {CAND_NOKEYS} SELECT {', '.join(CANDIDATE_COLUMNS)} FROM cand",
    "histogram_sink": _fd_histogram("sel", "B_M", SEL_CTES),
    "column_udf": _BIN_ASSIGN,
    "udf3_sql": f"WITH {CAND} SELECT {KEYS}, sqrt({_p2('H1_')}) AS H1_P FROM cand",
    "dataset_map": f"WITH {MASS_CTES} SELECT {KEYS}, B_M FROM m3",
    "stream_momentum": f"WITH {CAND} SELECT {KEYS}, {_p2('H1_')} AS H1_P2, sqrt({_p2('H1_')}) AS H1_P FROM cand",
    "stream_b_mass": f"WITH {SEL_CTES} SELECT * FROM sel",
    "stream_text_files": "SELECT p_partkey || ' ' || p_name AS value FROM part",
    "stream_restart": f"WITH {CAND} SELECT {KEYS}, {_p2('H1_')} AS H1_P2, sqrt({_p2('H1_')}) AS H1_P FROM cand",
    "stream_histogram": f"SELECT bin, count(*) AS n FROM ({_BIN_ASSIGN}) GROUP BY bin",
    "stream_lines": "SELECT regexp_replace(coalesce(text, ''), '[\\r\\n]', ' ', 'g') AS value FROM documents",
}
