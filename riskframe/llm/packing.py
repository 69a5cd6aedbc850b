"""Packing token sequences into fixed windows by best-fit decreasing.

Texts become token ids in the tasks that read them (ids of the vocabulary file, then an end id). A document longer
than a window is first cut into full windows; its remainder, and every shorter document, is one piece.
Only piece descriptions (id, start, length, checksum) are shuffled, by a hash of the document id into groups of
about GROUP_DOCS documents. Each group is packed on its own: pieces in decreasing length go to the
open window with the least room that still holds them, found in a segment tree over remaining
capacities. So memory per task is bounded by the group, and groups become more with the input.

Defined results: a null text is the empty text (just the end id). Rows that repeat an id are packed
as separate documents of that id. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 2048
END_ID = 1
#: Documents packed together, about.
GROUP_DOCS = 20_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: Texts within Latin letters, without giant words, take the faster encoder of the same vocabulary.
_OTHER_TEXT = re.compile(r"[^\x00-ɏ‐-‧€]|\S{2000}|<\|")


class Encoder:
    """Token ids of a text, equal to those of the tokenizer file. Built in the task."""

    def __init__(self, tokenizer_file: str, ranks_file: str | None, pattern: str | None) -> None:
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(tokenizer_file)
        self.fast = None
        if ranks_file:
            import base64

            import tiktoken

            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.fast is None or _OTHER_TEXT.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def default_vocabulary() -> tuple[str, str, str]:
    """Files of the public byte-level BPE vocabulary (installed with the workers) and its word pattern."""
    import public_tokenizers as p

    return p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN


def _pieces(vocabulary, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*(vocabulary or default_vocabulary()))
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = array("I", encoder.ids(text.as_py()))
                ids.append(END_ID)
                raw = memoryview(np.asarray(ids).astype("<u4").tobytes())
                for s in range(0, len(ids), window):
                    n = min(window, len(ids) - s)
                    for col, v in zip(out, (doc_id, s, n, zlib.crc32(raw[4 * s:4 * (s + n)]), len(ids))):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return run


class OpenWindows:
    """Open windows by remaining capacity, with a segment tree that finds the tightest fit."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.used = [False] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(self.leaves)]

    def put(self, room: int, window: int) -> None:
        self.at[room].append(window)
        node = room + self.leaves
        while node and not self.used[node]:
            self.used[node] = True
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least room of at least ``need``, and that room."""
        node = need + self.leaves
        while not self.used[node]:
            while node & 1:  # a right child: nothing larger below its parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not self.used[node]:
                node += 1
        room = node - self.leaves
        window = self.at[room].pop()
        while node and not (self.at[room] if node >= self.leaves else self.used[2 * node] or self.used[2 * node + 1]):
            self.used[node] = False
            node >>= 1
        return window, room


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece; ``lengths`` are in decreasing order."""
    open_, n = OpenWindows(window), 0
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        found = open_.take(size) if size < window else None
        if found is None:
            found = (n, window)
            n += 1
        w, room = found
        where[i], offset[i] = w, window - room
        if room > size:
            open_.put(room - size, w)
    return where, offset


def _packed(window: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        where, offset = best_fit_decreasing(pdf["length"].to_numpy(), window)
        return pdf.drop(columns="part").assign(sequence_id=where + (int(key[0]) << 32), offset=offset)
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         vocabulary: tuple[str, str | None, str | None] | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``vocabulary``: tokenizer file, file of the same vocabulary as ranks (or None), its word pattern.
    """
    groups = max(1, -(-docs.count() // GROUP_DOCS))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = src.mapInArrow(_pieces(vocabulary, window), PIECES)
    part = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(groups))
    return pieces.withColumn("part", part).groupBy("part").applyInPandas(_packed(window), PACKED)
