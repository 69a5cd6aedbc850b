"""Time-based and stratified splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASH_RANGE = 1 << 30


def part_predicate(date_column: str, part: str, split_date: str, oot_start: str | None = None) -> F.Column:
    """Direct range predicate on the date column for one part (pushed down to the Parquet scan,
    unlike a filter on a derived label). Missing dates belong to no part."""
    d = F.col(date_column).cast("timestamp_ntz")
    lo, hi = F.lit(split_date).cast("timestamp_ntz"), (F.lit(oot_start).cast("timestamp_ntz") if oot_start else None)
    if part == "train":
        return d < lo
    if part == "test":
        return (d >= lo) & (d < hi) if hi is not None else d >= lo
    if part == "oot":
        return d >= hi if hi is not None else F.lit(False)
    raise ValueError(part)


def split_label(df: DataFrame, date_column: str, split_date: str, oot_start: str | None = None,
                out: str = "split") -> DataFrame:
    """One pass labelling: train < split_date <= test (< oot_start <= oot). Missing dates get no label."""
    d = F.col(date_column).cast("timestamp_ntz")
    lab = F.when(d < F.lit(split_date).cast("timestamp_ntz"), "train")
    if oot_start:
        lab = lab.when(d < F.lit(oot_start).cast("timestamp_ntz"), "test").when(d.isNotNull(), "oot")
    else:
        lab = lab.when(d.isNotNull(), "test")
    return df.withColumn(out, lab)


def time_based_split(df: DataFrame, date_column: str, split_date: str, oot_start: str | None = None,
                     check: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three filtered frames. Without ``oot_start`` the OOT frame is empty with the same columns.
    ``check`` runs one conditional-count aggregate and raises on an empty train or test part."""
    if date_column not in df.columns:
        raise ValueError(f"Date column '{date_column}' is absent")
    parts = [df.where(part_predicate(date_column, name, split_date, oot_start)) for name in ("train", "test", "oot")]
    if check:
        lab = split_label(df, date_column, split_date, oot_start, "__split")
        row = lab.agg(F.count_if(F.col("__split") == "train").alias("tr"),
                      F.count_if(F.col("__split") == "test").alias("te")).first()
        if row["tr"] == 0:
            raise ValueError("Train set is empty: no row before the split date")
        if row["te"] == 0:
            raise ValueError("Test set is empty: no row after the split date")
    return parts[0], parts[1], parts[2]


def hash_fraction(keys: Sequence[str], seed: int) -> F.Column:
    """Deterministic uniform value in [0, 1) from the row key (no shuffle, reproducible)."""
    h = F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))
    return F.pmod(h, F.lit(HASH_RANGE)).cast("double") / float(HASH_RANGE)


def _exact_class_thresholds(df: DataFrame, target: str, h: F.Column, fracs: Mapping, default: float) -> dict:
    """Per class, the hash value at rank round(frac * n_c) - 1 (rows ordered by hash within the class).

    Counts per (class, hash) are map-side combined, the ranks come from the bucketed prefix sums,
    and only one value per class reaches the driver."""
    from riskframe.operators.curves import prefix_below
    from riskframe.session import persist
    counts = persist(df.select(F.col(target).alias("__t"), h.alias("__h")).groupBy("__t", "__h").count())
    sizes = {r["__t"]: int(r["n"]) for r in counts.groupBy("__t").agg(F.sum("count").alias("n")).collect()}
    want = {t: int(np.floor(fracs.get(t, default) * n + 0.5)) for t, n in sizes.items()}  # half up, like SQL ROUND
    pre = prefix_below(counts, "__h", by=["__t"], cols=("count",), persist_input=False)
    conds = [(F.col("__t") == t) & (F.col("count_below") <= k - 1) & (F.lit(k - 1) < F.col("count_below") + F.col("count"))
             for t, k in want.items() if k > 0]
    thresholds = {t: None for t in want}  # None: no test rows in that class
    if conds:
        cond = conds[0]
        for c in conds[1:]:
            cond = cond | c
        for r in pre.where(cond).select("__t", "__h").collect():  # one row per class
            thresholds[r["__t"]] = r["__h"]
    counts.unpersist()
    return thresholds


def stratified_split(df: DataFrame, target: str, keys: Sequence[str], test_frac: float = 0.2, seed: int = 42,
                     class_fracs: Mapping[int, float] | None = None, out: str = "part",
                     exact: bool = False) -> DataFrame:
    """Label rows ``train``/``test`` with a per-class share ``test_frac``.

    Default: the key hash is salted per class and cut at the share - no job, no shuffle; shares
    match per class up to sampling error. ``exact``: each class contributes exactly
    round(frac * n_c) test rows (the rows with the smallest 64-bit key hashes), found with one
    aggregation and the bucketed prefix sums; labelling is then a comparison, no join.
    Parts are disjoint and exhaustive either way."""
    if exact:
        h = F.xxhash64(*[F.col(k) for k in keys], F.col(target), F.lit(seed))
        th = _exact_class_thresholds(df, target, h, dict(class_fracs or {}), test_frac)
        lab = None
        for t, v in th.items():
            if v is None:
                continue
            cond = (F.col(target) == F.lit(t)) & (h <= F.lit(v))
            lab = cond if lab is None else (lab | cond)
        is_test = lab if lab is not None else F.lit(False)
        return df.withColumn(out, F.when(is_test, "test").otherwise("train"))
    u = hash_fraction([*keys, target], seed)
    frac = F.lit(test_frac)
    if class_fracs:
        frac = None
        for cls, f in class_fracs.items():
            frac = F.when(F.col(target) == cls, f) if frac is None else frac.when(F.col(target) == cls, f)
        frac = frac.otherwise(test_frac)
    return df.withColumn(out, F.when(u < frac, "test").otherwise("train"))


def kfold(df: DataFrame, keys: Sequence[str], k: int = 3, seed: int = 42, target: str | None = None,
          out: str = "fold") -> DataFrame:
    """Hash-assigned folds 0..k-1 (stratified when the target is part of the hash key)."""
    cols = [*keys, target] if target else list(keys)
    u = hash_fraction(cols, seed + 7)
    return df.withColumn(out, F.least(F.floor(u * k).cast("int"), F.lit(k - 1)))
