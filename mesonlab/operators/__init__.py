from mesonlab.operators import frame, stats, histogram
from mesonlab.operators.histogram import (
    SENTINEL, Binning, fd_binning, bin_edges, assign_bins, histogram_edges, histogram_fd,
    column_histogram, column_histograms, binning_frame, fd_histogram_edges,
)
from mesonlab.operators.edges import Edges
from mesonlab.operators.exactsum import exact_sums
from mesonlab.operators.sketches import sketch_binning, sketch_columns, sketch_quantiles, update_store
from mesonlab.operators.stats import (
    describe, summary, approx_quantile, exact_quantiles, quantile_rank, numeric_stats_table,
)

__all__ = [
    "frame", "stats", "histogram", "SENTINEL", "Binning", "fd_binning", "bin_edges",
    "assign_bins", "histogram_edges", "histogram_fd", "column_histogram", "column_histograms", "binning_frame", "fd_histogram_edges",
    "describe", "summary", "approx_quantile", "exact_quantiles", "quantile_rank",
    "numeric_stats_table", "Edges", "exact_sums", "sketch_binning", "sketch_columns", "sketch_quantiles", "update_store",
]
