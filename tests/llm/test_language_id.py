import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from riskframe.llm import language_id as li

SCHEMA = "doc_id long, text string, lang string, source string, score string, lang_pred int"


def docs(n=300):
    rng = random.Random(3)
    words = {"aa": ["the", "thing", "shall", "ing", "with"], "bb": ["der", "für", "schön", "und"], "cc": ["que", "año", "está"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(3, 80))), lang, "s", "x", 1)
            for i, lang in ((i, rng.choice(list(words))) for i in range(n))]
    return rows + [(1000, None, "aa", None, None, 1), (1001, "", "aa", None, None, 1), (1002, "12 + 3 = %%", "bb", None, None, 1),
                   (1003, "die Straße und der " * 30_000, None, None, None, 1), (None, "the thing", None, None, None, 1)]


def cosine_by_hand(texts, lang_of):
    """Bundles computed letter by letter."""
    space = li.Space()

    def vec(t):
        c = " " + " ".join("".join(x if x.isalpha() else " " for x in (t or "").lower()).split()) + " "
        out = np.zeros(li.DIM)
        for a, b, d in zip(c, c[1:], c[2:]):
            out += np.roll(space._letter(ord(a)), 2) * np.roll(space._letter(ord(b)), 1).astype(int) * space._letter(ord(d))
        return out
    protos = {}
    for t, lang in lang_of:
        protos[lang] = protos.get(lang, 0) + vec(t)
    out = []
    for t in texts:
        v = vec(t)
        cos = {k: v @ p / np.linalg.norm(v) / np.linalg.norm(p) for k, p in protos.items()}
        best = max(sorted(cos), key=cos.get)
        out.append((best, max(0.0, cos[best])))
    return out


def test_predictions_and_folds(spark):
    rows = docs()
    got = {r.doc_id: r for r in li.identified(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 0) and 0 <= r.score <= 1
    assert all(got[d].lang_pred == "und" and got[d].score == 0 for d in (1000, 1001, 1002))
    assert got[1003].lang_pred == "bb"
    held = [r for r in rows[:300] if got[r[0]].held_out]
    assert len(held) > 30 and sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.98 * len(held)


def test_cosines_match_a_computation_by_hand(spark):
    rows = docs(40)[:40]
    train = [(r[1], r[2]) for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.identified(spark.createDataFrame(rows, SCHEMA)).collect()}
    for r, (lang, score) in zip(rows, cosine_by_hand([r[1] for r in rows], train)):
        assert got[r[0]][0] == lang and abs(got[r[0]][1] - score) < 1e-5


def test_empty_tables_no_labels_and_stage(spark):
    df = spark.createDataFrame(docs(30), SCHEMA)
    assert li.identified(df.limit(0)).count() == 0
    assert {r.lang_pred for r in li.identified(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    stage = li.with_language(df)
    assert stage.columns == df.columns and {r.doc_id for r in stage.collect()} == set(range(30)) | {1003, None}


def test_marks_alone_are_no_letters():
    space = li.Space()
    assert not len(space.trigrams("\u0301\u0308 12 \u0301")[0])
    assert len(space.trigrams("e\u0301")[0])
