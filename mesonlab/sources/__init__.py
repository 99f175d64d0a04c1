from mesonlab.sources.readers import read_csv, read_json, read_parquet, read_jdbc, camel_options, parsed_lines, split_malformed
from mesonlab.sources.candidates import (
    CANDIDATE_SCHEMA, CANDIDATE_COLUMNS, candidate_select_sql, candidates_from_lineitem,
    read_candidates, table,
)
from mesonlab.sources.catalog import DATASETS, load_dataset
from mesonlab.sources.writers import SAVE_MODES, write_json, write_parquet, write_bucketed, bucketing, write_histogram

__all__ = [
    "read_csv", "read_json", "read_parquet", "read_jdbc", "camel_options", "parsed_lines", "split_malformed",
    "CANDIDATE_SCHEMA", "CANDIDATE_COLUMNS", "candidate_select_sql", "candidates_from_lineitem",
    "read_candidates", "table", "DATASETS", "load_dataset",
    "SAVE_MODES", "write_json", "write_parquet", "write_bucketed", "bucketing", "write_histogram",
]
