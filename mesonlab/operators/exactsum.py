"""Exact sums of doubles: the same result for every order of the rows.

A double is a whole number times a power of two. It is cut, without any rounding, into
limbs of LIMB_BITS bits at fixed places (rint of the scaled value less what the next
place up holds); the limbs of a place are added as whole numbers, and a group's sums
are put together once, in whole numbers, and rounded once. Which places are needed
follows from the largest and the smallest magnitude, found in a pass before: four for
prices, 105 for a column with 1e-300 and 1e300 in it."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesonlab.operators.stats import sql_double
from mesonlab.session import ship_package

#: Bits of a limb: 2^43 rows of a group until a sum of limbs leaves 64 bits (an error in
#: ANSI mode, not a wrong sum).
LIMB_BITS = 20
_SPECIAL = ("nan", "up", "down", "held")


def _scaled(x: str, bits: int) -> str:
    """x * 2^bits as SQL; in two steps where one factor is out of range."""
    a = max(min(bits, 1000), -1000)
    text = f"({x} * {sql_double(math.ldexp(1.0, a))})"
    return text if a == bits else f"({text} * {sql_double(math.ldexp(1.0, bits - a))})"


def _limb(x: str, place: int) -> str:
    """The limb of ``x`` at 2^(LIMB_BITS * place): the nearest multiple of its place, less
    that of the place above. Zero where the spacing of doubles at x is above the limb."""
    own, above = _scaled(x, -LIMB_BITS * place), _scaled(x, -LIMB_BITS * (place + 1))
    limb = f"CAST(RINT({own}) - RINT({above}) * {float(1 << LIMB_BITS)!r}D AS BIGINT)"
    top = LIMB_BITS * (place + 2) + 54
    return f"CASE WHEN ABS({x}) < {sql_double(math.ldexp(1.0, top))} THEN {limb} ELSE 0L END" if top < 1024 else limb


def _places(least: float, most: float) -> range:
    """Places that hold every bit of doubles with magnitudes from ``least`` to ``most``."""
    low = max(math.frexp(least)[1] - 53, -1074)
    return range(low // LIMB_BITS, (math.frexp(most)[1] + 1) // LIMB_BITS + 1)


def _whole(places: range):
    def whole(special: pa.Array, sums: pa.Array) -> pa.Array:
        """The sums of the limbs, put together and rounded once."""
        out = []
        limbs = [sums.field(i).to_pylist() for i in range(len(places))]
        for (nan, up, down, held), own in zip(zip(*(special.field(i).to_pylist() for i in range(len(_SPECIAL)))), zip(*limbs)):
            if not held:
                out.append(None)
            elif nan or up and down:
                out.append(math.nan)
            elif up or down:
                out.append(math.inf if up else -math.inf)
            else:
                total = sum(s << (LIMB_BITS * (p - places[0])) for p, s in zip(places, own))
                shift = LIMB_BITS * places[0]
                try:
                    out.append(float(total << shift) if shift >= 0 else total / (1 << -shift))
                except OverflowError:
                    out.append(math.inf if total > 0 else -math.inf)
        return pa.array(out, pa.float64())
    return whole


def exact_sums(df: DataFrame, group: Sequence[str], sums: dict[str, str], *others: Column) -> DataFrame:
    """``group`` columns, a sum for each name of ``sums`` (name: column), and ``others``.

    Each sum is the sum of the doubles without any error, rounded once to the nearest
    double; nulls don't count, a group of nulls has none. NaN, and infinities of both
    signs, give NaN; one infinity gives itself; a sum beyond the range an infinity."""
    ship_package(df.sparkSession)
    names = {out: f"_x{i}" for i, out in enumerate(sums)}
    values = df.withColumns({x: F.col(f"`{sums[out]}`").cast("double") for out, x in names.items()})
    infinite = F.lit(math.inf)
    ends = [a for x in names.values() for v in [F.when((F.col(x) != 0) & (F.abs(x) < infinite), F.abs(x))] for a in (F.min(v).alias(f"lo{x}"), F.max(v).alias(f"hi{x}"))]
    found = values.agg(*ends).first()
    places = {x: _places(found[f"lo{x}"], found[f"hi{x}"]) if found[f"lo{x}"] is not None else range(0, 1) for x in names.values()}
    aggs = []
    for x in names.values():
        aggs += [F.count_if(F.isnan(x)).alias(f"nan{x}"), F.count_if(F.col(x) == infinite).alias(f"up{x}"), F.count_if(F.col(x) == -infinite).alias(f"down{x}"), F.count(x).alias(f"held{x}")]
        finite = f"(CASE WHEN ABS({x}) < CAST('Infinity' AS DOUBLE) THEN {x} END)"
        aggs += [F.expr(f"COALESCE(SUM({_limb(finite, p)}), 0L)").alias(f"limb{i}{x}") for i, p in enumerate(places[x])]
    grouped = values.groupBy(*group).agg(*aggs, *others)
    plain = [c for c in grouped.columns if not any(c.endswith(x) for x in names.values())]
    made = {}
    for out, x in names.items():
        whole = F.arrow_udf(_whole(places[x]), "double")
        made[out] = whole(F.struct(*[f"{c}{x}" for c in _SPECIAL]), F.struct(*[f"limb{i}{x}" for i in range(len(places[x]))]))
    return grouped.withColumns(made).select(*group, *made, *[c for c in plain if c not in group])
