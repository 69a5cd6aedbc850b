import hashlib
import random

import pytest
from pyspark.sql import functions as F

from riskframe.llm import fingerprint as fp
from tests.llm.test_near_dedup import shingle_set

SCHEMA = "doc_id long, text string, tag string, n string, next_tag string"


def corpus():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    texts = [" ".join(word() for _ in range(rng.choice([6, 40, 200, 900]))) for _ in range(40)]
    return texts + [None, "", "a", " \t", "a b c d e", "né à 😀 x" * 50, "z" * 100_000, "y " * 60_000, texts[0], texts[1]]


def jaccard(a, b):
    x, y = shingle_set(a), shingle_set(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_edited_texts_and_likeness(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_ROWS", 7)
    texts = corpus()
    rows = [(i * 5 - 20, t, "x", "y", "z") for i, t in enumerate(texts)]
    random.Random(2).shuffle(rows)
    got = {r.doc_id: r for r in fp.edited_fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    order = sorted((d, t or "") for d, t, *_ in rows)
    assert len(got) == len(rows)
    prints = {}
    for (d, t), (e, u) in zip(order, order[1:] + order[:1]):
        k = len(t) // 4
        edited = t[:len(t) - k] + u[:k]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        assert len(r.fingerprint) == (256 if t.split() else 0)
        assert r.near_edited == pytest.approx(jaccard(t, edited), abs=0.17)
        assert r.near_next == pytest.approx(jaccard(t, u), abs=0.17)
        if edited == t:
            assert r.near_edited == 1


def test_repeats_nulls_one_row_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d", "", "", ""), (3, "abcd", "", "", ""), (3, "abcd", "", "", ""), (3, "wxyz", "", "", "")], SCHEMA)
    got = fp.edited_fingerprints(df).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 7), (3, 4), (3, 4)]
    one = fp.edited_fingerprints(df.filter("doc_id is null")).collect()
    assert [(r.near_next, r.edited_sha256) for r in one] == [(1.0, hashlib.sha256(b"a b c a").hexdigest())]
    assert fp.edited_fingerprints(df.limit(0)).count() == 0


def test_bias_of_the_estimate_is_small(spark):
    rng = random.Random(9)
    rows, want = [], []
    for i in range(120):
        base = [str(rng.random())[2:9] for _ in range(rng.choice([30, 150, 600]))]
        other = list(base)
        for _ in range(len(base) // 15):
            other[rng.randrange(len(base))] = "changed" + str(rng.random())
        rows.append((i, " ".join(base), " ".join(other)))
        want.append(jaccard(*rows[-1][1:]))
    df = fp.with_fingerprint(fp.with_fingerprint(spark.createDataFrame(rows, "i int, a string, b string"), "a", "fa"), "b", "fb")
    mean = df.agg(F.avg(fp.likeness("fa", "fb"))).first()[0]
    assert mean == pytest.approx(sum(want) / len(want), abs=0.015)
