"""Exact order statistics over columns of any length, in two passes where these suffice.

The first pass sums a column up in a mergeable quantile summary of bounded size and reads
a grid of values off it, each at most a known share of the rows from its place. Two of them
enclose the wanted rank. The second pass counts the rows below them and every value
between, which settles the rank exactly. Where too many rows lie between, they are counted
in even bins instead and the bin that holds the rank is searched on, a pass each. What
comes to the driver is bounded, and a value that fills a third of the table is one count.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values of the grid, and the summary's error: one row in so many.
GRID = 500
ACCURACY = 10_000
#: Different values that the second pass counts one by one at most.
MOST_VALUES = 50_000


@dataclass
class _Profile:
    """Number, least and greatest of a column's values, and the grid: shares and values."""

    n: int
    lo: float | None
    hi: float | None
    grid: list[float]

    def bracket(self, rank: int) -> tuple[float, float]:
        """Two values with the value at ``rank`` between them, by the error of the summary."""
        slack = 2.0 / ACCURACY
        below = math.floor((rank / self.n - slack) * GRID)
        above = math.ceil(((rank + 1) / self.n + slack) * GRID)
        lo = self.grid[below] if below > 0 else self.lo
        hi = self.grid[above] if above < GRID else self.hi
        return lo, hi


@dataclass
class _Search:
    """Looking for the value at 0-based ``rank`` of the whole column, between lo and hi."""

    key: tuple[str, int]
    rank: int
    lo: float
    hi: float


def _numbers(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(
        *[F.nullif(c.cast("double"), F.lit(float("nan"))).alias(n) for n, c in columns.items()]
    )


def _profile(values: DataFrame) -> dict[str, _Profile]:
    shares = [i / GRID for i in range(GRID + 1)]
    row = values.agg(
        *[F.count(c).alias(f"n_{c}") for c in values.columns],
        *[F.min(c).alias(f"lo_{c}") for c in values.columns],
        *[F.max(c).alias(f"hi_{c}") for c in values.columns],
        *[F.percentile_approx(c, shares, ACCURACY).alias(f"grid_{c}") for c in values.columns],
    ).first()
    return {
        c: _Profile(row[f"n_{c}"], row[f"lo_{c}"], row[f"hi_{c}"], row[f"grid_{c}"] or [])
        for c in values.columns
    }


def _counted(values: DataFrame, windows: list[tuple[str, float, float]], bins: int | None) -> dict:
    """Per window the number of rows below it, and (n, least, greatest) of its values in order.

    Each value by itself, or the values of each of ``bins`` even bins together.
    """
    cells = []
    for i, (column, lo, hi) in enumerate(windows):
        v = F.col(column)
        place = v
        if bins is not None:
            place = F.least(F.floor((v - lo) / F.lit(hi - lo) * bins), F.lit(bins - 1)).cast("double")
        inside = F.struct(F.lit(i).alias("w"), place.alias("place"), v.alias("v"))
        none = F.lit(None).cast("double")
        under = F.struct(F.lit(i).alias("w"), none.alias("place"), none.alias("v"))
        cells.append(F.when(v < lo, under).when(v <= hi, inside))
    rows = (
        values.select(F.explode(F.array(*cells)).alias("c"))
        .where("c is not null")
        .groupBy("c.w", "c.place")
        .agg(F.count("*").alias("n"), F.min("c.v").alias("lo"), F.max("c.v").alias("hi"))
        .collect()
    )
    found = {i: (0, []) for i in range(len(windows))}
    for r in rows:
        under, inside = found[r.w]
        if r.place is None:
            found[r.w] = (r.n, inside)
        else:
            inside.append((r.lo, r.hi, r.n))
    return {windows[i]: (under, sorted(inside)) for i, (under, inside) in found.items()}


def _narrow(
    values: DataFrame, profile: dict[str, _Profile], ranks: list[tuple[str, int]], bins: int
) -> dict[tuple[str, int], float]:
    """The values at some ranks; every pass reads ``values`` once."""
    found: dict[tuple[str, int], float] = {}
    searches = []
    for name, rank in ranks:
        lo, hi = profile[name].bracket(rank)
        searches.append(_Search((name, rank), rank, lo, hi))
    while True:
        for s in searches:
            if s.lo == s.hi:
                found[s.key] = s.lo
        searches = [s for s in searches if s.key not in found]
        if not searches:
            return found
        # Even bins need a finite range; an infinite one is left by counting its values.
        few, many = [], []
        for s in searches:
            n = profile[s.key[0]].n
            inside = n * (2.0 / GRID + 8.0 / ACCURACY) + 2
            small = inside <= MOST_VALUES or not math.isfinite(s.hi - s.lo)
            (few if small else many).append(s)
        for group, cells in ((few, None), (many, bins)):
            if not group:
                continue
            windows = sorted({(s.key[0], s.lo, s.hi) for s in group})
            counted = _counted(values, windows, cells)
            for s in group:
                under, inside = counted[s.key[0], s.lo, s.hi]
                left = s.rank - under
                if left < 0 or left >= sum(n for _, _, n in inside):
                    # Beyond the summary's error: look at the whole column.
                    s.lo, s.hi = profile[s.key[0]].lo, profile[s.key[0]].hi
                    continue
                for lo, hi, n in inside:
                    if left < n:
                        s.lo, s.hi = lo, hi
                        break
                    left -= n


def kth_values(
    df: DataFrame, wanted: dict[str, tuple[Column, int]], *, bins: int = 2048
) -> dict[str, float | None]:
    """Value at a 0-based rank, ascending, per named numeric column.

    Nulls are left out; a rank outside the column gives None.
    """
    values = _numbers(df, {n: c for n, (c, _) in wanted.items()})
    profile = _profile(values)
    ranks = [(name, rank) for name, (_, rank) in wanted.items() if 0 <= rank < profile[name].n]
    found = _narrow(values, profile, ranks, bins)
    return {name: found.get((name, rank)) for name, (_, rank) in wanted.items()}


def exact_quantiles(
    df: DataFrame, wanted: dict[str, tuple[Column, float]], *, bins: int = 2048
) -> dict[str, float | None]:
    """Quantiles with linear interpolation between neighbours; None for an empty column."""
    values = _numbers(df, {n: c for n, (c, _) in wanted.items()})
    profile = _profile(values)
    ranks, places = [], {}
    for name, (_, q) in wanted.items():
        n = profile[name].n
        if n == 0:
            continue
        place = q * (n - 1)
        below, above = math.floor(place), math.ceil(place)
        places[name] = (below, above, place - below)
        ranks += [(name, r) for r in {below, above}]
    found = _narrow(values, profile, ranks, bins)
    out: dict[str, float | None] = dict.fromkeys(wanted)
    for name, (below, above, part) in places.items():
        low, high = found[name, below], found[name, above]
        # Equal neighbours may be infinite, and their difference no number.
        out[name] = low if part == 0 or low == high else low + (high - low) * part
    return out
