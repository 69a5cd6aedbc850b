"""Toxicity: the label model against a simulation and a plain posterior, held-out accuracy, odd rows."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import toxicity
from riskframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def simulate(n, seed):
    """Five voters: 0, 1, 3 independent given the class, 2 copies 1 nine times in ten, 4 is noise."""
    rng = np.random.default_rng(seed)
    y = rng.random(n) < 0.2
    rates = np.array([[0.05, 0.1, 0.1, 0.02, 0.5], [0.8, 0.7, 0.7, 0.6, 0.5]])
    votes = (rng.random((n, 5)) < rates[y.astype(int)]).astype(int)
    votes[:, 2] = np.where(rng.random(n) < 0.9, votes[:, 1], votes[:, 2])
    return y, votes


def test_label_model_finds_accuracies_and_the_copying_voter():
    y, votes = simulate(40_000, 1)
    known = np.where(np.random.default_rng(2).random(len(y)) < 0.02, y.astype(int), -1)
    rows, back, = np.unique(np.c_[votes, known], axis=0, return_inverse=True)
    counts = np.bincount(back).astype(float)
    post = toxicity.label_model(rows[:, :5], rows[:, 5], counts)[back]
    prior, parent, tables = toxicity._tree(votes, np.ones(len(y)), post)
    assert abs(prior[1] - 0.2) < 0.02
    assert abs(tables[0][1][1] - 0.8) < 0.05 and abs(tables[0][0][1] - 0.05) < 0.03
    child = 2 if parent[2] == 1 else 1
    assert parent[child] == 3 - child  # the copy and its original are joined, and agree in either class
    assert all(tables[child][c][1, 1] > 0.8 and tables[child][c][0, 1] < 0.25 for c in (0, 1))
    # as good as the posterior with the true rates
    true = toxicity._posterior(votes, toxicity._tree(votes, np.ones(len(y)), y.astype(float)))
    assert ((post > 0.5) == y).mean() > ((true > 0.5) == y).mean() - 0.005


def test_posterior_by_hand():
    votes = np.array(list(itertools.product((0, 1), repeat=3)))
    model = (np.array([0.7, 0.3]), {0: None, 1: 0, 2: 1},
             {0: np.array([[0.9, 0.1], [0.4, 0.6]]),
              1: np.array([[[0.8, 0.2], [0.5, 0.5]], [[0.7, 0.3], [0.1, 0.9]]]),
              2: np.array([[[0.6, 0.4], [0.3, 0.7]], [[0.2, 0.8], [0.45, 0.55]]])})
    got = toxicity._posterior(votes, model)
    for v, p in zip(votes, got):
        like = [model[0][y] * model[2][0][y][v[0]] * model[2][1][y][v[0], v[1]] * model[2][2][y][v[1], v[2]] for y in (0, 1)]
        assert p == pytest.approx(like[1] / sum(like))


def test_entries_and_hits_against_plain_counting():
    text = "Foo foobar foobarbaz! ÜBER über-foo 12foobar x"
    words = ["foo", "foobar", "foobarbaz", "über", "über", "foo", "foobar", "x"]
    want = {}
    for w in words:
        for key in [("words", w)] * (len(w) >= 3) + [(f"start{n}", w[:n]) for n in (4, 5, 6, 7) if len(w) >= n]:
            want[key] = want.get(key, 0) + 1
    assert toxicity.entries(text) == want
    lex = {"words": {"über"}, "start4": {"foob"}, "start6": {"foobar"}, "start7": {"foobarb"}}
    assert toxicity.Voters(lex).hits(words) == [0, 2, 3, 0, 3, 1]
    bits, x = toxicity.Voters(lex).features(text)
    assert len(x) == toxicity.FEATURES and bits >> 2 & 1 and not bits & 1
    assert toxicity.Voters({}).features("")[0] == 0


def test_held_out_accuracy(spark):
    got = QUERIES["op11_weak_toxicity"](spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.count() == n and got.filter("score < 0 or score > 1 or predicted <> cast(score >= 0.3 as int)").isEmpty()
    both = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert all(zlib.crc32(str(d).encode()) % 4 == 2 for d in both["doc_id"])
    toxic = both["toxic"] == 1
    assert (both.loc[toxic, "predicted"] == 1).mean() > 0.9 and (both.loc[~toxic, "predicted"] == 0).mean() > 0.99


SCHEMA = "doc_id long, text string, score string, votes int"


def small(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, "s", 0) for i, t in rows], SCHEMA)
    return toxicity.score(docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int")).toPandas()


def corpus():
    bad = [(i, f"some words about {i} and a zorbling{i % 7} then zorblish thing number {i * 3}" if i % 3 else
            f"some words about {i} and an idiot then a moron of number {i * 3}") for i in range(60)]
    good = [(i, f"some words about {i} and a garden{i % 7} then gardenish thing number {i * 3}") for i in range(60, 240)]
    return bad + good, [(i, int(i < 60), 1) for i in range(240)]


def test_learned_starts_and_held_out_labels_do_not_count(spark):
    rows, labels = corpus()
    got = small(spark, rows, labels)
    assert ((got["predicted"] == 1) == (got["doc_id"] < 60)).all()
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    turned = small(spark, rows, [(i, 1 - y if i in held else y, q) for i, y, q in labels])
    assert np.allclose(got.sort_values("doc_id")["score"], turned.sort_values("doc_id")["score"], atol=1e-9)


def test_odd_rows(spark):
    rows, labels = corpus()
    odd = [(1000, None), (1001, ""), (None, "an idiot and a moron"), (1002, "clean words"), (1002, "clean words"),
           (1003, "you idiot " * 50_000), (1004, "12 !! ** ́ 𝔘")]
    got = small(spark, rows + odd, labels + [(1002, 1, 0), (1002, 0, 0), (1003, None, 0), (None, 1, 0), (1, 1, 1)])
    assert len(got) == len(rows) + len(odd)
    by = got.groupby("doc_id")["score"].agg(["min", "max"])
    assert by.loc[1000, "min"] == by.loc[1001, "min"] < 0.3 and by.loc[1002, "min"] == by.loc[1002, "max"]
    assert by.loc[1003, "min"] > 0.3 and got[got["doc_id"].isna()]["predicted"].tolist() == [1]


def test_no_labels_empty_table_one_label(spark):
    rows = [(i, "you are an idiot, a moron and a loser" if i % 3 == 0 else f"a quiet day number {i}") for i in range(30)]
    got = small(spark, rows, [])
    assert ((got["predicted"] == 1) == (got["doc_id"] % 3 == 0)).all()
    assert len(small(spark, [], [(1, 1, 0)])) == 0
    got = small(spark, rows, [(i, 0, 0) for i in range(30) if i % 3])
    assert len(got) == 30 and (got.loc[got["doc_id"] % 3 != 0, "predicted"] == 0).all()


def test_copies_count_once(spark):
    """A clean word of a toxic text that is copied 40 times does not enter the lexicons."""
    rows, labels = corpus()
    rows = rows + [(2000 + i, "remarkable vocabulary appears inside this copied zorbling text again") for i in range(40)]
    labels = labels + [(2000 + i, 1, 0) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = toxicity.training_labels(spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))
    found = toxicity.learn_lexicons(docs, known)
    assert "zorb" in found["start4"] and "vocab" not in found.get("start5", set())
    assert docs.filter(F.col("doc_id") >= 2000).count() == 40
