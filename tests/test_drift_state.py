"""Drift states: reports from counts equal reports from rows, parts merge, replays change nothing, late rows are counted."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators.drift import psi_by_period, variable_psi
from riskframe.operators.drift_state import DriftState
from riskframe.streaming.psi_stream import start_drift_state_stream

DAY0 = dt.datetime(2024, 1, 1)


def _rows(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"ts": [DAY0 + dt.timedelta(minutes=int(m)) for m in rng.integers(0, 20 * 1440, n)],
                        "a": rng.normal(size=n).round(2), "b": rng.integers(0, 4, n).astype(float), "flat": 3.0})
    pdf.loc[::7, "a"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return df.withColumn("a", F.nanvl("a", F.lit(None).cast("double")))


CUT = "2024-01-11"


def _is_base():
    return F.col("ts") < F.lit(CUT).cast("timestamp_ntz")


def test_report_from_parts_equals_rows(spark, tmp_path):
    df = _rows(spark)
    cols = ["a", "b", "flat"]
    state = DriftState.create(df.where(_is_base()), str(tmp_path / "s"), cols, "ts")
    for batch in range(3):
        state.append(df.where(F.pmod(F.hash("ts"), F.lit(3)) == batch), batch)
    cmp = {"late": ((None, CUT), (CUT, None))}
    state = DriftState.load(spark, str(tmp_path / "s"))
    got = {r.variable: r for r in state.summary(spark, cmp, score="a").collect()}
    want = {r.variable: r for r in variable_psi(df.where(_is_base()), df.where(~_is_base()), cols).collect()}
    assert set(got) == set(cols) and got["a"].section == "score" and got["b"].section == "variable"
    for v in cols:
        assert got[v].psi == pytest.approx(want[v].psi, abs=1e-12) and got[v].interpretation == want[v].interpretation
    base = df.where(_is_base())
    assert got["a"].n_expected == base.where("a is not null").count()

    state.append(df.where(F.pmod(F.hash("ts"), F.lit(3)) == 1), 1)       # the same batch again
    again = {r.variable: r for r in state.summary(spark, cmp, score="a").collect()}
    assert again == got
    windows = {r.window_start: r.psi for r in state.by_period(spark, "a", (None, CUT)).collect()}
    rows = {r.window_start: r.psi for r in psi_by_period(df, "a", "ts", CUT, "1 day").collect()}
    assert windows == pytest.approx(rows, abs=1e-12)


def test_empty_batches_null_times_and_empty_ranges(spark, tmp_path):
    df = _rows(spark, 80)
    state = DriftState.create(df, str(tmp_path / "s"), ["a"], "ts")
    state.append(df.limit(0), 0, "1 day")
    state.append(df.withColumn("ts", F.lit(None).cast("timestamp_ntz")), 1, "1 day")
    assert state.counts(spark).count() == 0
    state.append(df, 2, "1 day")
    assert state.counts(spark).agg(F.sum("n"), F.sum("late")).first()[:] == (df.where("a is not null").count(), 0)
    row = state.summary(spark, {"none": ((None, None), ("2030-01-01", None))}).first()
    assert np.isnan(row.psi) and row.n_actual == 0


def test_stream_counts_late_rows_and_replays(spark, tmp_path):
    df = _rows(spark, 400, 1)
    path = str(tmp_path / "in")
    state = DriftState.create(df, str(tmp_path / "s"), ["b"], "ts")
    new, old = df.where(~_is_base()), df.where(_is_base())

    def deliver(part, k):
        part.coalesce(1).write.parquet(f"{path}/d={k}")
        stream = spark.readStream.schema("ts timestamp_ntz, a double, b double, flat double").parquet(f"{path}/d=*")
        start_drift_state_stream(spark, stream, state, "1 day", str(tmp_path / "ck")).awaitTermination()
    deliver(new, 0)
    assert state.counts(spark).agg(F.sum("late")).first()[0] == 0
    deliver(old, 1)
    last = new.agg(F.max("ts")).first()[0]
    late = old.where(F.col("ts") < F.lit(last - dt.timedelta(days=1)).cast("timestamp_ntz")).count()
    got = state.counts(spark).groupBy("batch_id").agg(F.sum("n").alias("n"), F.sum("late").alias("late")).orderBy("batch_id").collect()
    assert [(r.n, r.late) for r in got] == [(new.count(), 0), (old.count(), late)] and late > 0
    before = sorted(state.counts(spark).collect())
    state.append(old, got[1].batch_id, "1 day")                          # a replayed micro-batch
    assert sorted(state.counts(spark).collect()) == before
    days = {r.window_start for r in state.by_period(spark, "b", (None, CUT)).collect()}
    assert len(days) == df.select(F.to_date("ts")).distinct().count()    # open windows too
