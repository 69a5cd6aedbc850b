"""Toxicity scores by weak supervision: many lexicon and pattern voters, a generative label model, a linear classifier.

1. Lexicons. One is fixed (common English insults). The others are learned from labelled documents: whole words and word
   starts of four to seven letters that occur in far more toxic than clean documents. Near copies count once: of documents
   with the same smallest shingle hash and label, one is counted.
2. Voters. Each lexicon casts two votes (any hit; several hits that make up a share of the words), all lexicons together one
   (many hits), and three patterns one each (shouting, runs of exclamation marks, masked letters): sixteen yes/no votes per document.
3. Label model. The votes of a class follow a tree: every voter has its own rate in either class (its accuracy) and depends on
   one other voter (the strongest correlations, by mutual information given the class). Expectation-maximisation over all
   documents, with known labels held fixed. It needs the number of documents per vote pattern only, which the number
   of voters bounds (2^16 patterns).
4. Classifier. Logistic regression on the logarithm of hits, their share of the words and the votes, fitted on all documents
   weighted by the posterior of the label model, gives the score.

Labels count only where crc32(doc_id as text) mod 4 is not 2; labels, lang, source and doc_id are no features. The lexicons are fitted
on a sample of at most about SAMPLE_PER_LABEL labelled documents of each label (those with the smallest hashes); everything else
covers all documents.

Defined results: a null text is empty; an empty text has no votes and gets the score of no evidence. A document with labels of both
kinds, or a null label, has no label. Without labels the fixed lexicon and the patterns still vote. A repeated row gives a row
each, equal texts equal scores, a null id stays null (its label is not read). Whole texts are read, however long, one at a time.
An empty table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import id_crc32, text_or_empty
from riskframe.llm.shingles import WordHasher
from riskframe.session import reliable_checkpoint

# Mild English insults, in lower case.
INSULTS = ["clown", "coward", "creep", "crap", "cretin", "damn", "disgusting", "dumb", "dumbass", "filth", "fool", "freak", "garbage",
           "idiot", "idiotic", "imbecile", "jerk", "liar", "loser", "lunatic", "moron", "moronic", "nasty", "pathetic", "pig", "scum",
           "scumbag", "stupid", "trash", "ugly", "vermin", "vile", "weirdo", "worthless"]

FOLDS, HELD_OUT = 4, 2
SAMPLE_PER_LABEL = 20_000
#: Word starts learned, in letters; an entry needs this share of the toxic documents (and this many of them), this many times the
#: rate in clean ones and this many standard errors.
STARTS = (4, 5, 6, 7)
LEAST_SHARE, LEAST_DOCS, LEAST_LIFT, LEAST_Z = 0.005, 3, 4.0, 6.0
#: Standard errors for documents that hold an entry twice or more, which few entries do by chance.
LEAST_Z_TWICE = 5.0
COUNTS = ["clean", "toxic", "clean_twice", "toxic_twice"]
#: Entries a task counts before it sends them on.
COUNTER_ENTRIES = 300_000
THRESHOLD = 0.3

LEXICONS = ["fixed", "words", *(f"start{n}" for n in STARTS)]
VOTERS = [*(f"{x}_{k}" for x in LEXICONS for k in ("any", "several")), "many", "shouting", "exclaiming", "masked"]
FEATURES = 2 * len(LEXICONS) + 3 + len(VOTERS)

_WORD = re.compile(r"[^\W\d_]+")
_SHOUT = re.compile(r"[A-ZÀ-ÖØ-Þ]{3,}")
_MASKED = re.compile(r"[^\W\d_]\*{2,}[^\W\d_]")


# ------------------------------------------------------------------------------------------------------ lexicons

def entries(text: str) -> dict[tuple[str, str], int]:
    """Occurrences of (lexicon, entry) among the words of a text."""
    found: dict[tuple[str, str], int] = {}
    for w, k in Counter(_WORD.findall(text.lower())).items():
        if len(w) >= 3:
            found["words", w] = k
        for n in STARTS:
            if len(w) >= n:
                key = f"start{n}", w[:n]
                found[key] = found.get(key, 0) + k
    return found


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()
    for b in batches:
        first = [int(s[0]) - 2**63 if len(s := hasher.shingles(t.as_py())) else None for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(first, pa.int64())],
                                         names=["doc_id", "toxic", "family"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def packed(counts):
        keys = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]),
             *(pa.array([counts[k][c] for k in keys], pa.int64()) for c in range(4))], names=["lexicon", "entry", *COUNTS])
    counts: dict[tuple[str, str], list[int]] = {}
    for b in batches:
        for label, text in zip(b.column("toxic").to_pylist(), b.column("text")):
            for key, times in entries(text.as_py()).items():
                of = counts.setdefault(key, [0, 0, 0, 0])
                of[label] += 1
                of[2 + label] += times > 1
            if len(counts) > COUNTER_ENTRIES:
                yield packed(counts)
                counts = {}
    if counts:
        yield packed(counts)


def training_labels(labels: DataFrame, label_col: str = "toxic") -> DataFrame:
    """(doc_id, toxic) of documents outside the held-out fold with one kind of label."""
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("toxic")).filter(
        "doc_id is not null and toxic in (0, 1)").filter(id_crc32() % FOLDS != HELD_OUT)
    return known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter(
        "toxic = most").drop("most")


def learn_lexicons(docs: DataFrame, known: DataFrame) -> dict[str, set[str]]:
    """Entries by lexicon, from a bounded sample of labelled documents."""
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return {}
    cut = F.lit(None)
    for label, n in sizes.items():
        cut = F.when(F.col("toxic") == label, F.lit(min(1.0, SAMPLE_PER_LABEL / n))).otherwise(cut)
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < cut * (1 << 30))
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    picked = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text")  # 2 * SAMPLE_PER_LABEL ids, about
    families = picked.mapInArrow(_families, "doc_id long, toxic int, family long")
    one = reliable_checkpoint(families.groupBy("toxic", "family").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "toxic"))
    counts = texts.join(F.broadcast(one), "doc_id").select("toxic", "text").mapInArrow(
        _counted, "lexicon string, entry string, " + ", ".join(f"{c} long" for c in COUNTS)).groupBy("lexicon", "entry").agg(
        *(F.sum(c).alias(c) for c in COUNTS))
    n = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    clean, toxic = n.get(0, 0), n.get(1, 0)
    if not clean or not toxic:
        return {}

    def telling(in_clean, in_toxic, least_z):
        rate = (in_clean + in_toxic) / (clean + toxic)
        expected = rate * toxic
        return ((in_toxic >= max(LEAST_DOCS, LEAST_SHARE * toxic)) & (in_toxic / toxic >= LEAST_LIFT * (in_clean / clean))
                & (in_toxic - expected >= least_z * F.sqrt(expected * (1 - rate) * clean / (clean + toxic))))
    # an entry needs LEAST_SHARE of the toxic documents, so at most 1 / LEAST_SHARE times the mean entries of one are chosen
    chosen = counts.filter(telling(F.col("clean"), F.col("toxic"), LEAST_Z)
                           | telling(F.col("clean_twice"), F.col("toxic_twice"), LEAST_Z_TWICE))
    found: dict[str, set[str]] = {}
    for r in chosen.select("lexicon", "entry").collect():
        found.setdefault(r["lexicon"], set()).add(r["entry"])
    return found


# -------------------------------------------------------------------------------------------------------- voters

class Voters:
    """Votes and features of a text."""

    def __init__(self, lexicons: dict[str, set[str]]) -> None:
        self.whole = [set(INSULTS), lexicons.get("words", set())]
        self.starts = [lexicons.get(f"start{n}", set()) for n in STARTS]
        # words whose first letters are those of no entry are passed over
        self.gate = {e[: STARTS[0]] for lexicon in (*self.whole, *self.starts) for e in lexicon}

    def hits(self, words: list[str]) -> list[int]:
        gate, short = self.gate, STARTS[0]
        near = [w for w in words if w[:short] in gate]
        return [*(sum(w in x for w in near) for x in self.whole),
                *(sum(w[:n] in x for w in near) for n, x in zip(STARTS, self.starts))]

    def features(self, text: str) -> tuple[int, np.ndarray]:
        """Votes as bits and the feature vector."""
        words = _WORD.findall(text.lower())
        hits = self.hits(words)
        n = max(len(words), 1)
        patterns = [len(_SHOUT.findall(text)) / n, text.count("!!") / n, len(_MASKED.findall(text)) / n]
        votes = [v for h in hits for v in (h > 0, h > 1 and 100 * h >= n)]
        votes += [max(hits) > 3, patterns[0] >= 0.3, patterns[1] >= 0.05, patterns[2] >= 0.01]
        values = [*np.log1p(hits), *(min(5.0 * h / n, 1.0) for h in hits), *(min(p, 1.0) for p in patterns), *map(float, votes)]
        return sum(1 << k for k, v in enumerate(votes) if v), np.array(values, np.float32)


def _voted(lexicons: dict[str, set[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(lexicons)
        for b in batches:
            rows = [voters.features(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array([r[0] for r in rows], pa.int32()),
                 pa.array([r[1] for r in rows], pa.list_(pa.float32()))], names=["doc_id", "held_out", "votes", "x"])
    return run


# --------------------------------------------------------------------------------------------------- label model

def label_model(patterns: np.ndarray, known: np.ndarray, counts: np.ndarray, steps: int = 25) -> np.ndarray:
    """Posterior of label 1 for every pattern (rows of 0/1 votes), from the votes alone.

    ``known`` is 0 or 1 where the label of these ``counts`` documents is known, else -1. Votes given the class follow a tree of voters.
    """
    fixed = known >= 0
    if fixed.any() and 0 < (known[fixed] == 1).mean() < 1:
        start = _tree(patterns[fixed], counts[fixed], (known[fixed] == 1).astype(float))
        post = _posterior(patterns, start)
    else:
        post, steps = np.where(patterns[:, 0] > 0, 0.9, 0.05), 1  # without both labels further steps have nothing to hold them
    for _ in range(steps):
        held = np.where(fixed, known, post)
        new = _posterior(patterns, _tree(patterns, counts, held))
        moved = np.abs(new - post).max(initial=0.0)
        post = new
        if moved < 1e-6:
            break
    return post


def _tree(votes: np.ndarray, counts: np.ndarray, post: np.ndarray):
    """Rates of the classes, edges (voter, parent) and the tables P(vote | parent's vote, class)."""
    j = votes.shape[1]
    weight = np.stack([counts * (1 - post), counts * post])
    prior = (weight.sum(1) + 1) / (weight.sum() + 2)
    joint = np.empty((2, j, j, 2, 2))
    v = np.stack([1.0 - votes, votes.astype(float)])
    for y in range(2):
        for a in range(2):
            for b in range(2):
                joint[y, :, :, a, b] = (v[a] * weight[y][:, None]).T @ v[b]
    # one more document in either class, distributed as all are: a vote that tells nothing tilts to neither
    pooled = joint.sum(0) + 0.25
    joint += pooled / pooled.sum(axis=(-1, -2), keepdims=True)
    p = joint / joint.sum(axis=(-1, -2), keepdims=True)
    lone = p[:, np.arange(j), np.arange(j)][:, :, [0, 1], [0, 1]]
    lone = lone / lone.sum(-1, keepdims=True)
    info = (prior[:, None, None] * (p * np.log(p / (lone[:, :, None, :, None] * lone[:, None, :, None, :]))).sum((-1, -2))).sum(0)
    # the spanning tree of most mutual information, from voter 0
    parent = {0: None}
    while len(parent) < j:
        inside = list(parent)
        outside = [k for k in range(j) if k not in parent]
        sub = info[np.ix_(inside, outside)]
        i, k = np.unravel_index(sub.argmax(), sub.shape)
        parent[outside[k]] = inside[i]
    tables = {}
    for k, up in parent.items():
        tables[k] = lone[:, k] if up is None else p[:, up, k] / p[:, up, k].sum(-1, keepdims=True)
    return prior, parent, tables


def _posterior(votes: np.ndarray, model) -> np.ndarray:
    prior, parent, tables = model
    score = np.tile(np.log(prior), (len(votes), 1))
    for k, up in parent.items():
        for y in range(2):
            score[:, y] += np.log(tables[k][y][votes[:, k]] if up is None else tables[k][y][votes[:, up], votes[:, k]])
    return 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -700, 700)))


def posteriors(voted: DataFrame, known: DataFrame) -> DataFrame:
    """(votes, posterior) of every vote pattern among ``voted`` (doc_id, votes)."""
    rows = voted.select("doc_id", "votes").join(known, "doc_id", "left").groupBy("votes", "toxic").count().collect()
    # at most 3 * 2^16 rows
    votes = np.array([[r["votes"] >> k & 1 for k in range(len(VOTERS))] for r in rows], int).reshape(-1, len(VOTERS))
    known_ = np.array([-1 if r["toxic"] is None else r["toxic"] for r in rows], int)
    post = label_model(votes, known_, np.array([r["count"] for r in rows], float))
    by_votes = {r["votes"]: float(p) for r, p in zip(rows, post)}
    return voted.sparkSession.createDataFrame(list(by_votes.items()), "votes int, posterior double")


# --------------------------------------------------------------------------------------------------------- score

def score(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from THRESHOLD on)."""
    schema = "doc_id long, held_out boolean, score double, predicted int"
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    known = reliable_checkpoint(training_labels(labels, label_col))
    lexicons = learn_lexicons(source, known)
    voted = reliable_checkpoint(source.select(
        "doc_id", (id_crc32() % FOLDS == HELD_OUT).alias("held_out"), text_or_empty().alias("text")).mapInArrow(
        _voted(lexicons), "doc_id long, held_out boolean, votes int, x array<float>"))
    if voted.isEmpty():
        return docs.sparkSession.createDataFrame([], schema)
    weighted = voted.select("votes", "x").join(F.broadcast(posteriors(voted, known)), "votes").select(
        array_to_vector("x").alias("features"), F.explode(F.array(
            F.struct(F.lit(1.0).alias("label"), F.col("posterior").alias("weight")),
            F.struct(F.lit(0.0).alias("label"), (1 - F.col("posterior")).alias("weight")))).alias("r")).select("features", "r.*")
    model = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", regParam=1e-4, maxIter=50).fit(weighted)
    scored = model.transform(voted.withColumn("features", array_to_vector("x")))
    likely = vector_to_array("probability")[1]
    return scored.select("doc_id", "held_out", likely.alias("score"), (likely >= THRESHOLD).cast("int").alias("predicted"))
