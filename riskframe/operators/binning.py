"""Quantile edges and bin counts for many columns.

Edges at every fraction that any bin count q in 2..n_bins can need are exact order statistics
(``order_stats``: bracket and count, no value is shuffled). One more scan counts the classes per *elementary
interval* of the union of all candidate edges (right-closed, lowest edge included). Bin counts for any
candidate q are sums of elementary counts, so the min-bin-size search (re-binning with fewer quantiles while a bin
is too small) runs on the driver over O(features x edges) numbers instead of one job per try.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import order_stats

def clean_double(c: str) -> F.Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def quantile_fractions(n_bins: int, min_q: int = 2) -> dict[int, list[float]]:
    return {q: [float(v) for v in np.linspace(0.0, 1.0, q + 1)] for q in range(min_q, n_bins + 1)}


def dedupe_edges(values: Sequence[float | None]) -> list[float]:
    """Distinct edges in order, unrounded."""
    return sorted({v for v in values if v is not None})


def quantile_edges(df: DataFrame, columns: Sequence[str], fractions: Sequence[float], approx: bool = False,
                   accuracy: int = 100000) -> dict[str, list[float | None]]:
    """Raw quantiles per column at ``fractions`` (linear interpolation, nulls ignored).
    Exact by default (distributed, see ``exact_quantiles``); ``approx`` uses ``percentile_approx``."""
    fr = [float(f) for f in fractions]
    if not approx:
        return exact_quantiles(df, list(columns), fr)
    row = df.agg(*[F.percentile_approx(clean_double(c), fr, accuracy).alias(c) for c in columns]).first()
    return {c: list(row[c]) if row[c] is not None else [None] * len(fr) for c in columns}


def width_edges(lo: float, hi: float, n_bins: int) -> list[float]:
    """Equal-width edges; the lowest edge is widened by 0.1 % of the range (constant: +-0.1 %)."""
    if lo == hi:
        d = abs(lo) * 0.001 if lo != 0 else 0.001
        return [float(v) for v in np.linspace(lo - d, hi + d, n_bins + 1)]
    e = [float(v) for v in np.linspace(lo, hi, n_bins + 1)]
    e[0] = lo - (hi - lo) * 0.001
    return e


@dataclass
class NumericBins:
    feature: str
    edges: list[float]
    good: list[int]
    bad: list[int]


def _chosen_edges(cands: dict[int, list[float]], counts_for, n_bins: int, min_count: float) -> list[float]:
    edges = cands[n_bins]
    counts = counts_for(edges)
    while counts and min(counts) < min_count and len(edges) > 3:
        q = len(edges) - 2
        if q not in cands:
            break
        edges = cands[q]
        counts = counts_for(edges)
    return edges


def exact_quantiles(df: DataFrame, columns, fractions: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact quantiles (numpy's linear interpolation) of numeric columns (names or name -> Column)."""
    exprs = columns if isinstance(columns, dict) else {c: clean_double(c) for c in columns}
    got = order_stats.quantiles(df, exprs, [float(f) for f in fractions])
    return {c: got[c] if got[c] is not None else [None] * len(fractions) for c in exprs}


def numeric_bin_stats(df: DataFrame, features: Sequence[str], target: str, n_bins: int = 10,
                      min_bin_size: float = 0.05, method: str = "quantile", approx: bool = False,
                      accuracy: int = 100000) -> tuple[list[NumericBins], int, int, int]:
    """Fit right-closed bins for numeric ``features``; returns (bins, n_rows, n_good, n_bad).

    Edges of every bin count come from one set of order statistics; one more scan counts the classes
    between all of them, and the min-bin-size search adds up those counts on the driver."""
    features = list(features)
    per_q = quantile_fractions(n_bins)
    union = sorted(set(v for vs in per_q.values() for v in vs))
    bounds = [f(clean_double(c)).alias(f"{k}{i}") for i, c in enumerate(features) for k, f in (("lo", F.min), ("hi", F.max))]
    tot = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(target) == 0).alias("g"),
                 F.count_if(F.col(target) == 1).alias("b"), *(bounds if method == "width" else [])).first()
    n, good, bad = int(tot["n"]), int(tot["g"]), int(tot["b"])
    if not features:
        return [], n, good, bad
    found = quantile_edges(df, features, union, approx, accuracy)
    qs_all = {c: qs if qs and qs[0] is not None else None for c, qs in found.items()}
    mm = {c: (tot[f"lo{i}"], tot[f"hi{i}"]) for i, c in enumerate(features)
          if method == "width" and tot[f"lo{i}"] is not None}

    cands: dict[str, dict[int, list[float]]] = {}
    pos = {f: i for i, f in enumerate(union)}
    for c in features:
        qs = qs_all.get(c)
        if qs is None:
            cands[c] = {q: [] for q in per_q}
            continue
        cands[c] = {q: dedupe_edges([qs[pos[f]] for f in fr]) for q, fr in per_q.items()}
        if method == "width" and c in mm:
            cands[c][n_bins] = width_edges(mm[c][0], mm[c][1], n_bins)

    # Union of candidate edges per feature: elementary right-closed intervals, counted in one scan. On doubles (a, b] is
    # [next_up(a), next_up(b)); the lowest edge belongs to the first interval.
    elem_edges = {c: sorted(set(e for es in cands[c].values() for e in es)) for c in features}
    active = [c for c in features if len(elem_edges[c]) >= 2]
    elem_counts: dict[str, dict[int, tuple[int, int]]] = {c: {} for c in features}
    if active:
        inner = {c: sorted({u[0], *(order_stats.next_up(e) for e in u[1:])}) for c, u in elem_edges.items() if c in active}
        splits = {f"c{i}": [float("-inf"), *inner[c], float("inf")] for i, c in enumerate(active)}
        values = df.select(F.col(target).alias("__y"), *(clean_double(c).alias(f"c{i}") for i, c in enumerate(active)))
        agg = order_stats.cells(values, splits, ["__y"]).groupBy("feature", "cell").agg(
            F.count_if(F.col("__y") == 0).alias("g"), F.count_if(F.col("__y") == 1).alias("b"))
        for r in agg.collect():  # bounded: features x elementary intervals; cell 0 and the last one lie outside the edges
            name = active[int(r["feature"][1:])]
            if 0 < r["cell"] < len(elem_edges[name]):
                elem_counts[name][r["cell"] - 1] = (int(r["g"]), int(r["b"]))

    out = []
    min_count = n * min_bin_size
    for c in features:
        u = elem_edges[c]
        idx = {e: i for i, e in enumerate(u)}
        ec = elem_counts[c]

        def sums(edges, ec=ec, idx=idx):
            gs, bs = [], []
            for lo, hi in zip(edges[:-1], edges[1:]):
                g = b = 0
                for j in range(idx[lo], idx[hi]):
                    gj, bj = ec.get(j, (0, 0))
                    g += gj
                    b += bj
                gs.append(g)
                bs.append(b)
            return gs, bs

        if len(u) < 2:
            out.append(NumericBins(c, u, [], []))
            continue
        edges = _chosen_edges(cands[c], lambda e: [g + b for g, b in zip(*sums(e))], n_bins, min_count)
        gs, bs = sums(edges)
        out.append(NumericBins(c, edges, gs, bs))
    return out, n, good, bad
