"""Exact order statistics of many numeric columns by bracket and count.

No value is a shuffle key. Each round is two scans whose results are bounded by columns x GRID:

1. a mergeable sketch (``percentile_approx``) proposes pivots inside every bracket that still holds a wanted rank (first
   the whole line);
2. the rows are counted between pivots and at each pivot itself, so a value that fills a third of a column is one cell and is
   resolved at once. The counts are exact, so each wanted rank falls into one known cell.

A cell is narrower than its bracket by a factor of about GRID, so brackets of up to GATHER rows are reached after one
round per three decimal places of the row count. Their values are sorted in one bounded group each, and only the wanted
ones come back. The sketch decides how fast brackets shrink, never the result.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pivots a bracket, rank error of the sketch (1 / ACCURACY), rows of a bracket that one group sorts.
GRID, ACCURACY, GATHER = 400, 4_000, 20_000

INF = float("inf")


def next_up(x: float) -> float:
    return float(np.nextafter(x, INF))


def cells(df: DataFrame, splits: dict[str, list[float]], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, cell, v) of the columns of ``df`` named in ``splits``: cell i is [splits[i], splits[i + 1])
    of a list that starts at -inf and ends at inf; missing values have no cell. One binary search a value, in the JVM."""
    names = list(splits)
    padded = {c: s if len(s) > 2 else [-INF, 0.0, INF] for c, s in splits.items()}
    outs = [f"__cell{i}" for i in range(len(names))]
    plain = df.select(*keep, *(F.coalesce(F.col(c), F.lit(float("nan"))).alias(c) for c in names))
    binned = Bucketizer(splitsArray=[padded[c] for c in names], inputCols=names, outputCols=outs, handleInvalid="keep").transform(plain)
    cell = lambda c, o: F.when(~F.isnan(c), F.col(o).cast("int") if len(splits[c]) > 2 else F.lit(0))
    rows = F.array(*(F.struct(F.lit(c).alias("feature"), cell(c, o).alias("cell"), F.col(c).alias("v")) for c, o in zip(names, outs)))
    return binned.select(*keep, F.inline(rows)).filter("cell is not null")


def _split_points(pivots: Sequence[float]) -> list[float]:
    """Cells between pivots and a cell for each pivot alone."""
    points = set()
    for p in pivots:
        if math.isfinite(p):
            points |= {p, next_up(p)}
    return [-INF, *sorted(points - {INF}), INF]


def order_statistics(df: DataFrame, columns: dict[str, Column], wanted) -> tuple[dict[str, int], dict[str, dict[int, float]]]:
    """Numbers of values by column, and the value at each wanted rank (0 is the smallest). ``wanted`` maps a number of
    values to ranks. NaN and null are missing."""
    if not columns:
        return {}, {}
    value = lambda e: F.when(~F.isnan(e.cast("double")), e.cast("double"))
    base = df.select(*(value(e).alias(f"c{i}") for i, e in enumerate(columns.values())))
    names = {f"c{i}": name for i, name in enumerate(columns)}
    grid = [float(f) for f in np.linspace(0, 1, GRID + 1)]
    first = base.agg(*(F.struct(F.count(c).alias("n"), F.percentile_approx(c, grid, ACCURACY).alias("p")).alias(c) for c in names)).first()
    sizes = {c: int(first[c]["n"]) for c in names}
    open_ = {c: set(wanted(n)) for c, n in sizes.items() if n and wanted(n)}
    found: dict[str, dict[int, float]] = {c: {} for c in names}
    splits = {c: _split_points(first[c]["p"]) if sizes[c] > GATHER else [-INF, INF] for c in open_}
    while open_:
        counted = cells(base, splits).groupBy("feature", "cell").agg(F.count(F.lit(1)).alias("n")).collect()  # columns x cells
        sums: dict[str, dict[int, int]] = {c: {} for c in splits}
        for r in counted:
            sums[r["feature"]][r["cell"]] = r["n"]
        brackets: dict[tuple[str, int], tuple[int, list[int]]] = {}
        wide: dict[str, list[int]] = {}
        for c, ranks in open_.items():
            order = sorted(sums[c])
            below = np.concatenate([[0], np.cumsum([sums[c][k] for k in order])])
            for rank in sorted(ranks):
                at = bisect_right(below.tolist(), rank) - 1
                k = order[at]
                if splits[c][k + 1] == next_up(splits[c][k]):
                    found[c][rank] = splits[c][k]
                else:
                    brackets.setdefault((c, k), (int(below[at]), []))[1].append(rank)
            for k in order:
                if (c, k) in brackets and sums[c][k] > GATHER:
                    wide.setdefault(c, []).append(k)
        inside = {b: v for b, v in brackets.items() if b[1] not in wide.get(b[0], [])}
        if inside:
            _gather(base, splits, inside, found)
        open_ = {c: {r for k in ks for r in brackets[c, k][1]} for c, ks in wide.items()}
        if open_:
            splits = _narrowed(base, splits, wide, grid)
    return ({names[c]: n for c, n in sizes.items()}, {names[c]: v for c, v in found.items()})


def _in(brackets, spark) -> DataFrame:
    return F.broadcast(spark.createDataFrame(list(brackets), "feature string, cell int"))  # columns x wanted ranks at most


def _gather(base: DataFrame, splits: dict, inside: dict, found: dict) -> None:
    """Wanted values of narrow brackets."""
    spark = base.sparkSession
    used = {c: splits[c] for c, _ in inside}
    places = spark.createDataFrame([(c, k, [r - below for r in ranks]) for (c, k), (below, ranks) in inside.items()],
                                   "feature string, cell int, places array<int>")
    held = cells(base, used).join(F.broadcast(places), ["feature", "cell"])
    sorted_ = held.groupBy("feature", "cell").agg(F.array_sort(F.collect_list("v")).alias("vs"), F.first("places").alias("places"))
    for r in sorted_.select("feature", "cell", F.transform("places", lambda i: F.get("vs", i)).alias("values")).collect():
        found[r["feature"]].update(zip(inside[r["feature"], r["cell"]][1], r["values"]))


def _narrowed(base: DataFrame, splits: dict, wide: dict, grid: list[float]) -> dict[str, list[float]]:
    """Split points of the next round: the bounds of wide brackets and pivots inside them."""
    used = {c: splits[c] for c in wide}
    held = cells(base, used).join(_in([(c, k) for c, ks in wide.items() for k in ks], base.sparkSession), ["feature", "cell"])
    pivots: dict[str, set[float]] = {c: set() for c in wide}
    for r in held.groupBy("feature", "cell").agg(F.percentile_approx("v", grid, ACCURACY).alias("p")).collect():
        pivots[r["feature"]] |= set(r["p"])
    return {c: sorted(set(_split_points(sorted(pivots[c]))) | {splits[c][k + d] for k in ks for d in (0, 1)}) for c, ks in wide.items()}


def quantiles(df: DataFrame, columns: dict[str, Column], fractions: Sequence[float]) -> dict[str, list[float] | None]:
    """numpy's linearly interpolated quantiles of every column; None for a column without values."""
    def ranks(n: int) -> set[int]:
        lows = [math.floor(f * (n - 1)) for f in fractions]
        return {r for lo in lows for r in (lo, min(lo + 1, n - 1))} if n else set()
    sizes, values = order_statistics(df, columns, ranks)
    out: dict[str, list[float] | None] = {}
    for c, n in sizes.items():
        got = []
        for f in fractions if n else ():
            h = f * (n - 1)
            lo = math.floor(h)
            a, b, t = values[c][lo], values[c][min(lo + 1, n - 1)], h - lo
            got.append(a if a == b else float(a + (b - a) * t) if t < 0.5 else float(b - (b - a) * (1 - t)))
        out[c] = got if n else None
    return out
