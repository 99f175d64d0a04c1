"""Write the final (post-AQE) physical plans of representative queries to PLANS.md."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mesonlab.functions import kinematics as K  # noqa: E402
from mesonlab.operators import histogram as H, stats as S  # noqa: E402
from mesonlab.plans import queries as Q  # noqa: E402
from mesonlab.session import get_session  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

NOTES = {
    "candidate_selection": "Scan reads only the lineitem columns the mass and the cut need (ReadSchema); "
                           "the cut reaches the scan as PushedFilters; one fused projection computes the mass.",
    "histogram_fd (final bin pass, lazy form)": "Bin index per row, partial count per task, one small shuffle "
                                                "of (bin, count), final count; statistics are literals, no join.",
    "group_by_agg": "Partial (map-side) aggregate before the shuffle: one row per group and task crosses it; "
                    "sums are exact: limbs of the doubles, added as longs.",
    "sort_take": "TakeOrderedAndProject: a bounded top-n per task, no global sort.",
    "bin_assign": "Bucketizer binary search among the runs of edges, then one division; a projection: "
                  "no join, no shuffle.",
    "exact quartiles: one bucket pass over the kept column": "In-memory scan of the kept column, range "
        "test + bucket number, partial aggregate per (interval, bucket), a shuffle of at most tasks x "
        "intervals x buckets rows, final aggregate, running count over that small table, filter to the "
        "bucket holding each rank; one row per target reaches the driver.",
    "column_histograms: bin counting pass over the kept columns": "One exploded (column, bin) pair per "
        "finite value, as one whole number; partial count, small shuffle, final count; every column in the same pass.",
    "bucketed_join": "Both tables are read by their buckets: no exchange; Spark sorts a bucket again in its task, though its file is in order.",
    "sql_function": "The SQL function is an expression of the scan's projection: no Python node.",
}


def cases(spark, sf):
    mass = Q._selected_mass(spark, sf)
    b = H.fd_binning(mass, "B_M")
    yield "candidate_selection", Q.q_candidate_selection(spark, sf)
    yield "histogram_fd (final bin pass, lazy form)", H._fd_bins_plan(mass, "B_M", b, 6)
    yield "group_by_agg", Q.q_group_by_agg(spark, sf)
    yield "sort_take", Q.q_sort_take(spark, sf)
    yield "bin_assign", Q.q_bin_assign(spark, sf)
    kept = S.KeptValues(mass, "B_M")
    row = kept.stats()
    n = row["n_valid"]
    yield ("exact quartiles: one bucket pass over the kept column",
           S.bucket_pass(kept.frame, [("v", row["lo"], row["hi"])],
                         [(0, S.quantile_rank(n, 0.25)), (0, S.quantile_rank(n, 0.75))], 256))
    cols = {f"c{i}": c for i, c in enumerate(["B_PX", "B_M"])}
    multi = S.KeptValues(K.with_b_mass(Q._cand(spark, sf)), cols)
    multi.stats()
    yield ("column_histograms: bin counting pass over the kept columns",
           multi.frame.select(F.explode(F.array(*[
               F.when(S.finite(n), F.lit(i << H.BIN_BITS) + F.floor(F.col(n) / 100).cast("long"))
               for i, n in enumerate(cols)])).alias("kb")).where("kb IS NOT NULL").groupBy("kb").count())
    orders, lines = map(spark.table, Q._bucketed(spark, sf))
    yield ("bucketed_join", orders.hint("merge").join(lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")), F.col("o_orderkey") == F.col("l_orderkey")))
    yield "sql_function", Q.q_sql_function(spark, sf)


def shorten(text: str, width: int = 170) -> str:
    text = re.sub(r"#\d+L?", "", text)
    return "\n".join(line if len(line) <= width else line[:width] + " …" for line in text.splitlines())


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("plan-report", "local[8]", {"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans", "",
           f"Final adaptive plans (after execution) of representative queries on `{sf}`, "
           "produced by `python tools/plan_report.py`. Expression lists are cut at 170 characters.", ""]
    for name, df in cases(spark, sf):
        df.collect()                               # runs this plan; AQE then shows the final one
        plan = df._jdf.queryExecution().executedPlan().toString()
        out += [f"## {name}", "", NOTES[name], "", "```", shorten(plan).rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
