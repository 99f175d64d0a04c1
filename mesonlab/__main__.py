"""Command line: ``python -m mesonlab --workspace W --dataset simulation [--selection]``."""

from __future__ import annotations

import argparse

from mesonlab.session import get_session
from mesonlab.sources.catalog import DATASETS


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="mesonlab", description="B-candidate mass histogram")
    p.add_argument("--workspace", required=True, help="folder holding the datasets; output goes there")
    p.add_argument("--dataset", required=True, choices=sorted(DATASETS))
    p.add_argument("--master", default=None, help="override the Spark master")
    p.add_argument("--selection", action=argparse.BooleanOptionalAction, default=False,
                   help="apply the B-candidate selection")
    p.add_argument("--quantiles", choices=("exact", "approx"), default="exact")
    p.add_argument("--out", default=None, help="histogram output path")
    return p.parse_args(argv)


def main(argv=None) -> None:
    from mesonlab.plans.spectrum import run_spectrum
    args = parse(argv)
    spark = get_session("mesonlab", args.master)
    hist = run_spectrum(spark, args.workspace, args.dataset, args.selection, args.out, args.quantiles)
    hist.orderBy("bin").show(hist.count(), truncate=False)


if __name__ == "__main__":
    main()
