import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskframe.llm import near_dedup
from riskframe.llm.components import components
from riskframe.llm.shingles import WordHasher


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, pct):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= pct * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return {(d, len(sets[i]), least[root(i)], d == least[root(i)]) for i, (d, _) in enumerate(rows)}


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    texts = [None, "", "  \n", "one", "One", "a b c", "a b c d e", "A b  c d E", "x" * 100_000, "x" * 100_000 + " y"]
    shared = " ".join(word() for _ in range(70))
    for _ in range(60):
        base = [word() for _ in range(rng.choice([6, 8, 12, 40, 120, 400, 2000]))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 40))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    hub = [word() for _ in range(150)]  # a large group whose members are near or just not near
    for _ in range(150):
        copy = list(hub)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9])):
            copy[rng.randrange(150)] = word()
        texts.append(" ".join(copy))
    for _ in range(60):  # a passage shared by different documents
        texts.append(shared + " " + " ".join(word() for _ in range(rng.randint(5, 60))))
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("pct", [85, 80])
def test_matches_brute_force(spark, pct):
    rows = corpus(pct)
    df = spark.createDataFrame([(d, t, True, 5) for d, t in rows], "doc_id long, text string, kept boolean, node int")
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, percent=pct).collect()}
    assert got == brute(rows, pct)


def test_blocks_find_what_leaders_leave(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CELL", 16)
    monkeypatch.setattr(near_dedup, "FEW", 4)
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, percent=85).collect()}
    assert got == brute(rows, 85)


def edited_copies(count, seed=7):
    """One text with so many edited copies, most of them just not near each other."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base, rows = [word() for _ in range(200)], []
    for i in range(count):
        copy = list(base)
        for at in rng.sample(range(0, 200, 5), rng.choice([1, 2, 3, 3, 3])):
            copy[at] = word()
        rows.append((i + 1, " ".join(copy)))
    return rows


def test_pairs_of_a_group_of_edited_copies_do_not_grow_with_its_square(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 32)
    compared, likely_pairs = [], near_dedup._likely_pairs

    def counted(nodes, pairs, percent):
        compared.append(pairs.count())
        return likely_pairs(nodes, pairs, percent)
    monkeypatch.setattr(near_dedup, "_likely_pairs", counted)
    rows = edited_copies(300)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, percent=91).collect()}
    assert got == brute(rows, 91)
    assert sum(compared[2:]) <= 5 * len(rows)  # of the large buckets; 300 texts have 44,850 pairs


def test_blocks_join_what_single_pairs_do(spark):
    sets = [np.sort(np.unique(np.concatenate([np.arange(100 - k), 1000 * i + 500 + np.arange(k)]))).astype(np.uint64)
            for i, k in enumerate([0, 5, 10, 20, 4, 40])]
    sets.append(np.arange(10_000, 10_050, dtype=np.uint64))

    def joined(side, comp):
        rows = pa.table({"side": side, "node": list(range(7)), "comp": comp, "full": pa.array([s.tobytes() for s in sets], pa.binary())})
        out = near_dedup._joined(85)(rows)
        return list(zip(out.column("a").to_pylist(), out.column("b").to_pylist()))
    one = joined([0] * 7, list(range(7)))
    links = [(i, j) for i in range(7) for j in range(i + 1, 7) if near_dedup.reaches(sets[i], sets[j], 85)]
    assert {x for pair in links for x in pair} == {x for pair in one for x in pair} and set(one) <= set(links)
    assert joined([0] * 7, [1] * 7) == []
    assert all({a, b} & {4, 5, 6} and {a, b} & {0, 1, 2, 3} for a, b in joined([0, 0, 0, 0, 1, 1, 1], list(range(7))))


def test_odd_rows_and_stage(spark):
    df = spark.createDataFrame([(None, "a b c d e f", 1), (2, "a b c d e f", 1), (1, "a b c d e f", 2), (1, "a b c d e f", 2),
                                (7, None, 3)], "doc_id long, text string, comp int")
    res = near_dedup.near_duplicates(df)
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in res.collect()) == [
        (-1, None, True), (1, 1, True), (2, 1, False), (7, 7, True)]
    stage = near_dedup.without_near_copies(df)
    assert stage.columns == df.columns and sorted(r.doc_id or -1 for r in stage.collect()) == [-1, 1, 1, 7]
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    links = links.union(spark.range(1001, 1300).select(F.lit(1000).cast("long"), "id"))
    got = {(r.node, r.comp) for r in components(links).collect()}
    assert got == {(i, 1) for i in range(1, 201)} | {(i, 1000) for i in range(1000, 1300)}


def test_shingle_hashes_count_distinct_shingles_and_ignore_white_space_kind():
    h = WordHasher()
    for t in ("a b c d e f g a b c d e f g", "A\tb\nc\x0bd\x0ce", "é à b", "x " * 3000, "w" * 200_000 + " z" * 300_000):
        assert len(h.shingles(t)) == len(shingle_set(t))
    assert np.array_equal(h.shingles("A b\nc  d e F"), h.shingles(" a B c d e f "))
