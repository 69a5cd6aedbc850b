"""Prefix trie against a plain walk over all prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskframe.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows):
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(c - 5 * int(c / 5)), [])[:h] + v[h:]
    return walk(built)


def walk(built):
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
            if d:
                kids[tuple(v[: d - 1])].add(tuple(v[:d]))
        ends[tuple(v)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not kids[node]
        saved[node] += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(kids[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def rows_of(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in df.collect())


def random_rows(seed, convs, turns, words):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant", None]), rng.choice(words)) for c in range(convs) for t in range(rng.randint(1, turns))]


@pytest.mark.parametrize("seed,words", [(1, ["a"]), (2, ["a", "bé", None]), (3, ["x" * 50, "", "日本", "d"])])
def test_contract_against_walk(spark, seed, words):
    rows = random_rows(seed, 40, 12, words)
    assert rows_of(ct.rebuilt_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, 2, "user", "b"), (0, None, "user", "first"), (0, 1, None, None), (0, 1, None, None),  # null turn, repeated row
            (3, 0, "user", "own"), (7, 0, "user", "x"), (12, 5, "r", "absent donor"), (None, 0, "user", "nobody"),
            (-3, 0, "u", "negative"), (-5, 0, "u", "donor of -6 to -9"), (5, 0, "u", "y" * 200_000), (9, 0, "u", "y" * 200_000)]
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], SCHEMA + ", depth int, digest string")
    assert rows_of(ct.rebuilt_trie(df)) == brute(rows)
    assert any(r[1] == 0 and r[7] != ct.EMPTY_SHA for r in brute(rows))  # turnless conversations end at the root


def test_empty_table(spark):
    assert ct.rebuilt_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_conversations_span_ranges(spark):
    """Two conversations of 2,600 turns that part after 2,100, one that stops inside, and many copies of a short one."""
    n = ct.SPAN * 2 + 552
    rows = [(c, t, "u", f"{t if t < 2_100 or c == 1 else -t}") for c in (1, 2) for t in range(n)]
    rows += [(3, t, "u", f"{t}") for t in range(1_501)] + [(10 + c, t, "u", f"short {t}") for c in range(300) for t in range(3)]
    turns = ct.sequences(spark.createDataFrame(rows, SCHEMA).repartition(8))
    # the walk would keep whole prefixes of 2,600 turns: figures are given by hand here
    got = {(r[0], r[1]): r for r in rows_of(ct.trie(turns, turns.select("conv_id").distinct()))}
    assert len(got) == 1 + n + (n - 2_100) + 3
    size = [len(str(t)) for t in range(n)]
    for d in (1, 2, 1_000, 1_024, 1_025, 1_501, 1_502, 2_048, 2_049, 2_100):
        r = got[1, d]
        inside = range(d - 1, 2_100)
        assert r[3] == (3 if d <= 1_501 else 2)
        assert r[4] == (2 if d == 2_100 else 1) and r[5] == 2
        assert r[6] == sum(size[t] * (2 if t < 1_501 else 1) for t in inside)
    assert got[1, n][4:7] == (0, 1, 0) and got[2, 2_101][2] == 1
    assert got[1, 1_501][7] == hashlib.sha256(b"3").hexdigest()
    assert got[10, 3][3] == 300 and got[10, 3][7] == hashlib.sha256(",".join(str(10 + c) for c in range(300)).encode()).hexdigest()


def test_ids_of_one_node_join_over_ranges(spark):
    convs = spark.range(0, 100_000).withColumnRenamed("id", "conv_id")
    none = spark.createDataFrame([], "conv_id long, pos long, digest binary, bytes long")
    root = ct.trie(none, convs.repartition(6)).collect()
    assert len(root) == 1 and root[0].n_convs == 100_000 and root[0].n_leaves == 1
    assert root[0].ends_sha256 == hashlib.sha256(",".join(map(str, range(100_000))).encode()).hexdigest()


def test_blocks_refine_only_where_siblings_diverge(spark):
    rows = [(c, t, "u", f"{t}" if t < 9 else f"{c}-{t}") for c in range(6) for t in range(11)]
    turns = ct.sequences(spark.createDataFrame(rows, SCHEMA))
    blocks = ct.blocks_of(turns)
    groups = blocks.groupBy("b", "p1", "p2").agg(F.count("*").alias("n"))
    assert sorted((r.b, r.n) for r in groups.collect()) == [(0, 6), (1, 6)] + [(2, 1)] * 6
    built = defaultdict(list)
    for c, _, role, text in rows:
        built[c].append((role, text))
    assert rows_of(ct.trie(turns, turns.select("conv_id").distinct())) == walk(built)
