"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (a fixed function of its code point). A trigram's vector binds
the vectors of its letters, each permuted (rotated) by its place, by multiplication; a text's vector is
the bundle (sum) of its trigrams; a language's prototype is the bundle of its training texts. The
prediction is the prototype with the largest cosine, which is also the score (negative: 0).

Training is one pass: tasks bundle trigram counts per language, and only (language, dimension) sums are
shuffled and brought to the driver: languages x 1024 numbers, whatever the corpus size.

Defined results: a text that is null or has no letters is ``und`` with score 0; so is every text when no
training row has a language. Ties go to the smallest language value. Letters of any script count.
Other columns are not read; repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import id_crc32

DIM = 1024
UNKNOWN = "und"
#: Documents bundled by one matrix product.
BATCH = 64
#: Letters of a text that are turned into trigrams at a time (whole texts are used, block by block).
BLOCK = 1 << 20
FOLDS = 5


class Space:
    """Letter vectors and trigram bundles; built in the task."""

    def __init__(self) -> None:
        self.letters: dict[int, np.ndarray] = {}
        self.is_letter = np.zeros(0x110000, bool)  # letters and the marks on them
        self.is_base = np.zeros(0x110000, bool)  # letters
        self.known = np.zeros(0x110000, bool)

    def _mask(self, codes: np.ndarray) -> np.ndarray:
        if not self.known[codes].all():
            for c in np.unique(codes[~self.known[codes]]).tolist():
                kind = unicodedata.category(chr(c))[0]
                self.is_letter[c], self.is_base[c] = kind in "LM", kind == "L"
                self.known[c] = True
        return self.is_letter[codes]

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = np.random.default_rng([77, code]).integers(0, 2, DIM, np.int8) * np.int8(2) - np.int8(1)
        return self.letters[code]

    def trigrams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Trigram keys and counts; runs of other characters are one blank, texts begin and end with one. A text
        without a letter (marks alone are none) has no trigrams."""
        if not text:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys, counts, base = [], [], False
        for at in range(0, len(text), BLOCK):
            codes = np.frombuffer(text[at:at + BLOCK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            letter = self._mask(codes)
            if not letter.any():
                continue
            base = base or bool(self.is_base[codes].any())
            codes = np.where(letter, codes, 32)
            keep = letter.copy()
            keep[1:] |= letter[:-1]
            c = np.concatenate([[32], codes[keep], [32]]).astype(np.int64)
            c = c[np.flatnonzero((c != 32) | (np.concatenate([[0], c[:-1]]) != 32))]
            k, n = np.unique((c[:-2] << 42) | (c[1:-1] << 21) | c[2:], return_counts=True)
            keys.append(k)
            counts.append(n)
        if not base:
            keys = []
        if len(keys) > 1:
            k, back = np.unique(np.concatenate(keys), return_inverse=True)
            return k, np.bincount(back, np.concatenate(counts)).astype(np.int64)
        return (keys[0], counts[0]) if keys else (np.empty(0, np.int64), np.empty(0, np.int64))

    def vectors(self, keys: np.ndarray) -> np.ndarray:
        """Bound vectors of trigram keys."""
        out = np.ones((len(keys), DIM), np.int8)
        for shift, turn in ((42, 2), (21, 1), (0, 0)):
            code, back = np.unique((keys >> shift) & 0x1FFFFF, return_inverse=True)
            out *= np.stack([np.roll(self._letter(c), turn) for c in code.tolist()])[back]
        return out.astype(np.float32)

    def bundles(self, grams: list[tuple[np.ndarray, np.ndarray]], group: np.ndarray, n: int) -> np.ndarray:
        """Sums of trigram vectors by group: ``group[i]`` in 0..n-1 is the row of text i."""
        sizes = [len(k) for k, _ in grams]
        if not sum(sizes):
            return np.zeros((n, DIM), np.float32)
        keys, back = np.unique(np.concatenate([k for k, _ in grams]), return_inverse=True)
        table = np.zeros((n, len(keys)), np.float32)
        np.add.at(table, (np.repeat(group, sizes), back), np.concatenate([c for _, c in grams]))
        out = np.zeros((n, DIM), np.float32)
        for at in range(0, len(keys), 4096):  # vectors of so many trigrams at a time
            out += table[:, at:at + 4096] @ self.vectors(keys[at:at + 4096])
        return out


def _bundle_languages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    space, sums = Space(), {}
    for b in batches:
        langs, texts = b.column(0).to_pylist(), b.column(1)
        for at in range(0, len(langs), BATCH):
            part = langs[at:at + BATCH]
            names = sorted(set(part))
            group = np.array([names.index(x) for x in part])
            out = space.bundles([space.trigrams(texts[at + i].as_py()) for i in range(len(part))], group, len(names))
            for name, v in zip(names, out):
                sums[name] = sums.get(name, 0) + v.astype(np.float64)
    for name, v in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([name] * DIM), pa.array(range(DIM), pa.int32()), pa.array(v)],
                                         names=["lang", "dim", "value"])


def learn(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Unit prototypes by language from the rows of ``train`` that have a text and a language."""
    src = train.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    sums = src.filter("lang is not null and text is not null").mapInArrow(
        _bundle_languages, "lang string, dim int, value double").groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    out: dict[str, np.ndarray] = {}
    for r in sums.collect():  # languages x DIM numbers
        out.setdefault(r.lang, np.zeros(DIM))[r.dim] = r.value
    return {k: v / np.linalg.norm(v) for k, v in sorted(out.items()) if v.any()}


def _predicted(names: list[str], protos: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space()
        for b in batches:
            texts, pred, score = b.column(width), [], []
            for at in range(0, b.num_rows, BATCH):
                n = min(BATCH, b.num_rows - at)
                out = space.bundles([space.trigrams(texts[at + i].as_py()) for i in range(n)], np.arange(n), n).astype(np.float64)
                norm = np.linalg.norm(out, axis=1)
                cos = out @ protos.T / np.maximum(norm, 1e-12)[:, None] if names else np.zeros((n, 1))
                best = cos.argmax(1)
                for i in range(n):
                    known = bool(names) and norm[i] > 0
                    pred.append(names[best[i]] if known else UNKNOWN)
                    score.append(float(min(1.0, max(0.0, cos[i, best[i]]))) if known else 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=[*b.schema.names[:width], "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text", keep: tuple[Column, ...] = ()) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: doc_id), lang_pred, score."""
    cols = docs.select(*(keep or (F.col("doc_id"),)), F.col(text_col).cast("string").alias("__text"))
    schema = cols.drop("__text").schema.add("lang_pred", "string").add("score", "double")
    names = list(model)
    protos = np.stack([model[k] for k in names]) if names else np.zeros((0, DIM))
    return cols.mapInArrow(_predicted(names, protos, len(cols.columns) - 1), schema)


def held_out(id_col: str = "doc_id") -> Column:
    return id_crc32(id_col) % FOLDS == 0


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learned from those that are not held out."""
    model = learn(docs.filter(~held_out()))
    return predict(docs, model, keep=(F.col("doc_id"), held_out().alias("held_out")))


def with_language(docs: DataFrame, min_score: float = 0.05, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language can be told: not ``und``, and a cosine of ``min_score`` or more
    with the nearest prototype. The prototypes are learned from the rows with a language."""
    model = learn(docs, text_col, lang_col)
    names = [f"__{i}" for i in range(len(docs.columns))]
    flat = docs.toDF(*names)
    kept = predict(flat, model, names[docs.columns.index(text_col)], tuple(flat[c] for c in names))
    return kept.filter((kept["lang_pred"] != UNKNOWN) & (kept["score"] >= min_score)).select(*names).toDF(*docs.columns)
