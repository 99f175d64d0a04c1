from mesonlab.plans.spectrum import mass_spectrum, run_spectrum
from mesonlab.plans.queries import QUERIES, FLAGSHIP, flagship
from mesonlab.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "FLAGSHIP", "flagship", "ORACLE_SQL", "mass_spectrum", "run_spectrum"]
