import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from riskframe.llm import packing

VOCAB = packing.default_vocabulary()


def ids(text):
    from tokenizers import Tokenizer
    return [*Tokenizer.from_file(VOCAB[0]).encode(text or "", add_special_tokens=False).ids, 1]


def test_pieces_cover_documents_and_fill_windows(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_DOCS", 40)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the", "Straße", "niño", "x1", "日本", "<|endoftext|>", "\n\n", "don't"]) for _ in
             range(rng.choice([0, 1, 20, 200, 900, 3000]))), "s", 1, 2) for i in range(90)]
    rows += [(100, None, "s", 1, 2), (101, "", "s", 1, 2), (101, "", "s", 1, 2), (102, "a" * 30_000, "s", 1, 2), (None, "b c", None, 0, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string, start int, offset int")
    got = packing.pack(df).collect()
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for d, text, *_ in rows:
        want = ids(text)
        mine = sorted(pieces[d], key=lambda r: r.start)
        if d == 101:
            assert [(r.start, r.length) for r in mine] == [(0, 1), (0, 1)]
            continue
        at = 0
        for r in mine:
            part = np.array(want[at:at + r.length], "<u4").tobytes()
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(part), len(want))
            at += r.length
        assert at == len(want)
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW
    assert sorted(map(str, got)) == sorted(map(str, packing.pack(df.repartition(5)).collect()))
    assert packing.pack(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_matches_a_plain_search(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.integers(1, 101, 400))[::-1]
    where, offset = packing.best_fit_decreasing(lengths, 100)
    rooms = []
    for size, w, o in zip(lengths, where, offset):
        fits = [r for r in rooms if r >= size]
        room = min(fits) if fits else 100
        assert 100 - o == room
        if fits:
            assert rooms[w] == room
            rooms[w] -= size
        else:
            assert w == len(rooms)
            rooms.append(100 - size)
    assert len(rooms) <= 1.1 * lengths.sum() / 100


def test_fast_and_exact_encoders_agree():
    e = packing.Encoder(*VOCAB)
    rng = random.Random(1)
    for _ in range(2000):
        t = "".join(rng.choice([" ", "  ", "\n", "\t", "a", "The", "'s", "é", "ß", "12", "!!", "€", "\x1c", "\x85", "\xa0",
                                "<|endoftext|>", "日本"]) for _ in range(rng.randint(0, 30)))
        assert e.ids(t) == e.exact.encode(t, add_special_tokens=False).ids
