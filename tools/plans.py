"""Print the formatted physical plan of registered queries.

Usage: python tools/plans.py [sf_dir] [query ...]
Eager statistics passes run first (they are part of building the query).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mesonlab.plans import QUERIES  # noqa: E402
from mesonlab.session import get_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session("plans", "local[8]", {"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        print(f"===== {name} =====")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
