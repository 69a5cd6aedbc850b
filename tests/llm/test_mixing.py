import random
from collections import defaultdict

import pytest

from riskframe.llm import mixing

SCHEMA = "doc_id long, text string, source string, taken int, base int"


def brute_targets(sizes, budget=None):
    """Share, stop at three times the size, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left = sum(sizes.values()) if budget is None else budget
    open_, out = set(names), {}
    while open_:
        w = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / w > 3 * sizes[s] + 1e-9]
        if not above:
            return out | {s: left * weight[s] / w for s in open_}
        for s in above:
            out[s] = 3 * sizes[s]
        left -= sum(out[s] for s in above)
        open_ -= set(above)
    return out


def rows(seed, sources=11):
    rng = random.Random(seed)
    out = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.choice([0, 1, 5, 30, 300]))),
            rng.choice([None, "hot", "hot", "hot"] + [f"s{k}" for k in range(sources)]), 1, 1) for i in range(400)]
    return out + [(900, None, "empty", 1, 1), (901, " \t\n", "empty", 1, 1), (902, "a " * 20_000, "s1", 1, 1), (None, "a b", "s2", 1, 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_taken(spark, seed, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    data = rows(seed)
    got = mixing.fair_queue(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == len(data)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for _, t, s, _, _ in data:
        sizes[s] += len((t or "").split())
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and 0 <= target[s] - taken[s] < 1
    again = mixing.fair_queue(spark.createDataFrame(data[::-1], SCHEMA).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_queue_order_budget_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", "x", 0, 0), (1, "a b", "x", 0, 0), (2, "c", "y", 0, 0)], SCHEMA)
    q = mixing.fair_queue(df).collect()
    assert sum(r.taken for r in q) == 5 and len(q) == 3  # y stops at 3 words, x gets the other 2
    finish = [r.virtual_finish for r in q]
    assert finish == sorted(finish)
    half = mixing.fair_queue(df, budget=3).collect()
    assert {r.source: r.target for r in half} == {"x": 1.0, "y": 2.0}
    assert mixing.fair_queue(df.limit(0)).count() == 0
    assert mixing.mixed_rows(df).columns == df.columns


def test_stage_rows_follow_what_is_taken(spark):
    data = rows(5)
    df = spark.createDataFrame(data, SCHEMA)
    q = {r.doc_id: r for r in mixing.fair_queue(df).collect()}
    seen = defaultdict(int)
    for r in mixing.mixed_rows(df).collect():
        seen[r.doc_id] += 1
    for i, r in q.items():
        assert abs(seen[i] * r.size - r.taken) <= r.size / 2
