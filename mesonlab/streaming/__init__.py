from mesonlab.streaming.streams import (
    Watched, b_mass_stream, candidate_stream, line_stream, momentum_stream, read_histogram, read_sink, run, run_available, start, start_histogram, start_quarantine, stop, watch,
)

__all__ = ["Watched", "b_mass_stream", "candidate_stream", "line_stream", "momentum_stream", "read_histogram", "read_sink", "run", "run_available", "start",
           "start_histogram", "start_quarantine", "stop", "watch"]
