import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import lm
from riskframe.session import reliable_checkpoint

SCHEMA = "doc_id long, text string, score string, chunk int"


def corpus(n=400, seed=5):
    rng = random.Random(seed)
    follow = {w: [f"{w}{k}" for k in range(6)] for w in "abcdefghij"}
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.choice([0, 3, 20, 60])):
            w = rng.choice("aaabbcdefghij")
            words += [w, rng.choice(follow[w]).upper() if rng.random() < 0.9 else f"rare{rng.randint(0, 5000)}"]
        rows.append((i, " ".join(words), "x", 1))
    return rows + [(1000, None, "x", 1), (1001, "", "x", 1), (1002, "never seen words", "x", 1), (1002, "never seen words", "x", 1),
                   (None, "a A0", None, None), (1003, "a a1 " * 40_000, "x", 1)]


def tokens(text):
    return [*(text or "").encode().lower().split(), "END"]


def in_training(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 10 != 0


def test_counts_base_scores_and_gain_over_the_base(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 1500)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 20_000)
    monkeypatch.setattr(lm, "PART_TOKENS", 40)
    rows = corpus()
    c = Counter(t for d, text, *_ in rows if in_training(d) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    got = lm.score(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows)
    texts = {d: t for d, t, *_ in rows}
    held = [0.0, 0.0]
    for r in got:
        t = tokens(texts[r.doc_id])
        want = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not in_training(r.doc_id), len(t), sum(x in c for x in t), n)
        assert r.base_score == pytest.approx(want, abs=1e-6) and r.score < 0
        if r.held_out:
            held = [held[0] + r.base_score, held[1] + r.score]
    assert held[1] > 0.85 * held[0]  # the contexts tell much about the next word


def test_odd_tables(spark):
    df = spark.createDataFrame(corpus(30), SCHEMA)
    assert lm.score(df.limit(0)).count() == 0
    only_held = lm.score(df.filter("doc_id = 10")).collect()  # crc32('10') % 10 decides; either way it runs
    assert len(only_held) == 1 and np.isfinite(only_held[0].score)


def test_predictive_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    words = np.repeat(np.arange(1, 51, dtype=np.uint64), 3)
    ctx = np.tile(np.array([0, 1, 2], np.uint16), 50)
    n = rng.integers(1, 200, 150)
    contexts = np.bincount(ctx, n, 3).astype(float)
    start = lm.State(np.array([0, 50.0, 50.0]), 50, 150, contexts, 50, int(n.sum()))
    first, word, total, t, r, s = lm.seat(words, ctx, n, start, [0, 1])
    assert (t[ctx > 0] >= 1).all() and (t <= n).all() and (s >= 1).all() and (s <= r).all()
    after = lm.State(np.array([0, t[ctx == 1].sum(), t[ctx == 2].sum()], float), s.sum(), r.sum(), contexts, 50, int(n.sum()))
    first, word, total, samples = lm.predictive(words, ctx, n, [(start, after)] * 2, -4)
    root, gain = samples[0]
    one = lm.seat(words, ctx, n, start, [lm.BURN, 1])
    after = lm.State(np.array([0, one[3][ctx == 1].sum(), one[3][ctx == 2].sum()], float), one[5].sum(), one[4].sum(), contexts, 50, int(n.sum()))
    root, gain = lm.predictive(words, ctx, n, [(start, after)], -4)[3][0]
    assert root.sum() + after.unknown() == pytest.approx(1)
    for u in (1, 2):
        assert gain[ctx == u].sum() + lm.back_off(after)[u] * 1.0 == pytest.approx(1)


def test_table_draws_follow_the_seating_distribution():
    """Against seating one customer after the other, with importance weights."""
    logs, rng = lm.stirling(0.8, lm.EXACT), np.random.default_rng(1)
    for c, a in ((2, 0.5), (7, 0.1), (30, 3.0)):
        t = np.arange(1, c + 1)
        p = np.exp(logs[c, 1:c + 1] + t * math.log(a) - (logs[c, 1:c + 1] + t * math.log(a)).max())
        want = (p * t).sum() / p.sum()
        got = lm.draw_tables(np.full(20_000, c), np.full(20_000, a), 0.8, logs, rng).mean()
        assert got == pytest.approx(want, rel=0.03)
    brute = {1: 0.0, 2: 0.0, 3: 0.0}  # S(3, t) by listing the seatings of three customers
    brute[1] += (1 - 0.8) * (2 - 0.8)
    brute[2] += (1 - 0.8) + (1 - 0.8) * 2
    brute[3] += 1
    assert [math.exp(x) for x in logs[3, 1:4]] == pytest.approx([brute[1], brute[2], brute[3]])


def test_contexts_that_are_no_frequent_words_tell_the_next_word(spark, monkeypatch):
    """Each of 3000 words (1 in 6000 tokens or fewer) is always followed by the same one."""
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 4000)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 5000)
    monkeypatch.setattr(lm, "PART_TOKENS", 10)
    rng = random.Random(4)
    rows = []
    for i in range(400):
        firsts = [rng.randrange(3000) for _ in range(30)]
        rows.append((i, " ".join(f"left{k} right{k} of" for k in firsts), "x", 1))
    got = lm.score(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    c = Counter(t for d, text, *_ in rows if in_training(d) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    texts = {d: t for d, t, *_ in rows}
    for r in got:
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens(texts[r.doc_id])), abs=1e-6)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.7 * sum(r.base_score for r in held)


def test_steps_over_what_varies_draw_the_same_tables():
    rng = np.random.default_rng(8)
    words = np.sort(rng.integers(1, 400, 1500).astype(np.uint64))
    ctx = rng.integers(1, 30, 1500).astype(np.uint64)
    words, ctx, n = lm._summed(words, ctx, rng.integers(0, 4, 1500))
    heavy = np.array([7, 9, 30], np.uint64)
    contexts = np.bincount(ctx.astype(int), n, 30)
    state = lm.State(np.bincount(ctx.astype(int), n > 0, 30).astype(float), 400, 700, contexts, 400, int(n.sum()), heavy, heavy, np.full(3, 0.01))
    first, _, _, t, r, s = lm.seat(words, ctx.astype(int), n, state, [1, 2])
    w2, c2, n2 = lm._slim(words, ctx, n, np.isin(words, heavy))
    first2, _, _, t2, r2, s2 = lm.seat(w2, c2.astype(int), n2, state, [1, 2])
    assert len(w2) < len(words) and t[n > 1].tolist() == t2[c2 != lm.OTHER].tolist()
    often, often2 = np.isin(words[first], heavy), np.isin(w2[first2], heavy)
    once = (np.add.reduceat(n, first) == 1) & ~often
    assert (s[~often].sum(), r[~often].sum()) == (s2[~often2].sum() + once.sum(), r2[~often2].sum() + once.sum())
    assert r[often].tolist() == r2[often2].tolist()


def test_contexts_travel_as_numbers():
    rng = np.random.default_rng(2)
    known = rng.integers(0, 2**63, 500, dtype=np.uint64)
    known[0] = 5  # its context would be below TAIL
    code = lm.Contexts(12, known)
    ctx = np.concatenate([np.arange(12, dtype=np.uint64), lm._as_context(known), rng.integers(lm.TAIL, 2**48, 300, dtype=np.uint64)])
    rng.shuffle(ctx)
    number, low, high = code.split(ctx)
    assert len(low) == len(high) == (number == lm.LISTED).sum() <= 300
    assert code.whole(number, low, high).tolist() == ctx.tolist()
    none = lm.Contexts(12, known[:0])
    assert none.whole(*none.split(ctx)).tolist() == ctx.tolist()
    arrays = [np.arange(300, dtype=np.uint64) << np.uint64(40), np.arange(7, dtype=np.uint16), np.empty(0, np.uint32), np.array([-1.5, 2.0])]
    assert [(x.dtype, x.tolist()) for x in lm.unpack(lm.pack(*arrays))] == [(x.dtype, x.tolist()) for x in arrays]
    words = np.sort(rng.integers(0, 2**64, 99, dtype=np.uint64))
    assert lm._from_steps(lm._steps(words)).tolist() == words.tolist()


def test_tokens_are_written_once(spark, monkeypatch):
    """The chunks' parts are shuffled, but kept in no checkpoint; checkpoints have the counts, which repeated texts don't add to."""
    def kept(rows):
        sizes = []

        def spy(df):
            out = reliable_checkpoint(df)
            assert "chunk" not in out.columns
            sizes.append(sum(len(r.payload) for r in out.filter("bucket >= 0").select("payload").collect()) if "payload" in out.columns else 0)
            return out
        monkeypatch.setattr(lm, "reliable_checkpoint", spy)
        scores = {r.doc_id: r for r in lm.score(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
        assert len(scores) == len(rows)
        return sum(sizes)
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(100)), "x", 1) for i in range(300)]
    once = kept(rows)
    assert kept(rows + [(1000 * k + d, t, s, c) for k in range(1, 6) for d, t, s, c in rows]) < 3 * once


def test_sums_of_the_documents_that_occur():
    state = lm.State(np.zeros(2), 0, 0, np.zeros(2), 9, 100)
    doc = np.array([3, 700, 3, 1899], np.uint16)
    payload = lm._sums(doc, 1900, np.array([0, 5, 6, 7]), np.full(4, 0.1), state)
    steps, base, score, known = lm.unpack(payload)
    assert lm._from_steps(steps).tolist() == [3, 700, 1899] and known.tolist() == [1, 1, 1]
    assert score.tolist() == pytest.approx([-2, -1, -1]) and base[1] == pytest.approx(math.log10(5.1 / 101))
    assert len(payload) < 250
    ids = lm.pack(np.arange(1900), np.zeros(1900, np.int32), np.ones(1900, np.int64))
    none = lm._sums(doc[:0], 1900, doc[:0], np.empty(0), state)
    got = lm._documents(100)(pa.table({"bucket": [0, 0, -2, 0], "payload": [payload, none, ids, payload]})).to_pydict()
    assert got["doc_id"] == list(range(1900)) and sum(got["n_known"]) == 6 and got["score"][3] == pytest.approx(-4)
