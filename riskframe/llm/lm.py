"""Language-model scores from a hierarchical Pitman-Yor model.

Model. Every training word and the start of a text is a context with its own restaurant (words are told apart by 48 bits of
their hash there). The restaurants share the root as parent: a table opened in a context is a customer of the root,
whose own base is uniform over the V training words and one unknown word.

Sampling. Given the number of tables of each restaurant, words are independent of each other. So words are the unit of
distribution: a Gibbs step draws, word by word, the number of tables of each context that serves it (all seatings of its
customers at once, through generalised Stirling numbers up to EXACT customers, then by seating the rest in small steps),
then the root's tables; what is exchanged between steps are the table totals of the restaurants. Those of frequent words
(at least 1 in HEAVY of the training tokens, so at most HEAVY words) go through the driver, with the root customers of
frequent words; those of all other contexts are summed by hash range of the context and sent back to the
word buckets that hold it. Draws are seeded by word bucket and step, so a lost task is repeated identically. After BURN
steps the predictive probabilities of SAMPLES steps are averaged; a text's score is the sum of their logarithms.

Data flow. Tasks turn texts into chunks of token arrays, sorted by word and packed; their parts are shuffled once, to the
partition of a hash bucket of the words (buckets become more with the tokens), and counting and scoring both read them there:
counts and totals come to the partitions that hold the tokens. Frequent words, which would make hot keys, stay with their
chunk if their context is frequent too (they are counted by sums over (word, context) and scored from a table of at most
HEAVY^2 numbers), and else travel by the hash of the context. Contexts travel as two-byte numbers if they are among the KNOWN
most frequent words, which is a code only. Pairs of held-out texts alone are held with a count of 0, so that a bucket knows
the totals of their contexts. Buckets return one packed array of sums per chunk, not a row per token or document. A lost
executor's parts are made again from the texts, so ``docs`` must give its rows in the same order when it is read again, as
a table does; checkpoint it before if it does not.

Defined results: a null text is the empty text, whose only token is the end. A null id counts as the empty text in the
fold rule. Rows that repeat an id are scored one by one. Without training rows every token is unknown. Empty table: empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shingles import WordHasher
from riskframe.session import reliable_checkpoint

FOLDS = 10
#: A word is frequent if it makes up 1 in HEAVY of the training tokens.
HEAVY = 1000
#: Discount and strength of the context restaurants and of the root.
DISCOUNT, STRENGTH = 0.8, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.7, 10.0
BURN, SAMPLES = 1, 2
#: Customers of one dish whose tables are drawn from the exact distribution.
EXACT = 64
CHUNK_TOKENS = 1_000_000
BUCKET_TOKENS = 3_000_000
#: Postings of one bucket that one task scores, for the most frequent tail word (N / HEAVY of them).
PART_TOKENS = 4_000_000

END = np.uint64(0x5EED0FE2D0C0FFEE)
OTHER, START = 0, 1  # context numbers; frequent word i is context i + 2
#: Numbers from here on are hashes: contexts that are no frequent words.
TAIL = 1 << 16
#: Words whose contexts travel in two bytes, at most; the number of all others.
KNOWN, LISTED = 60_000, 0xFFFF

CHUNKS = "chunk long, bucket int, payload binary"
ASKS = "owner int, bucket int, payload binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed binary; the first bytes of an array's numbers come first, then the second ones."""
    head = np.array([len(arrays)] + [v for a in arrays for v in (np.dtype(a.dtype).num, len(a))], "<i8").tobytes()
    raw = head + b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(payload: bytes) -> list[np.ndarray]:
    raw = pa.decompress(payload[8:], int.from_bytes(payload[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    meta = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(n, 2).tolist()
    at, out = 8 + 16 * n, []
    for num, size in meta:
        kind = np.dtype([t for t in (np.uint64, np.int64, np.uint32, np.int32, np.uint16, np.float64) if np.dtype(t).num == num][0])
        planes = np.frombuffer(raw, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += size * kind.itemsize
    return out


def _thin(a: np.ndarray) -> np.ndarray:
    """The same numbers (0 or more) in as few bytes as they need."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


class Contexts:
    """Contexts (below 2^48) as numbers of two bytes: those below ``width`` are their own numbers, then come the KNOWN most frequent
    words; others have the number LISTED and are listed in order, as their lower 32 and upper 16 bits. It is a code only."""

    def __init__(self, width: int, words: np.ndarray) -> None:
        self.width = width
        self.values = np.concatenate([np.arange(width, dtype=np.uint64), _as_context(words)])
        self.order = width + np.argsort(self.values[width:], kind="stable")
        self.sorted = self.values[self.order]

    def split(self, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        number = np.minimum(ctx, np.uint64(LISTED)).astype(np.uint16)
        tail = np.flatnonzero(ctx >= TAIL)
        if len(self.order):
            at = self.order[np.minimum(np.searchsorted(self.sorted, ctx[tail]), len(self.order) - 1)]
            number[tail] = np.where(self.values[at] == ctx[tail], at, LISTED)
        return number, *_halves(ctx[number == LISTED])

    def whole(self, number: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = self.values[np.where(number == LISTED, 0, number)]
        out[number == LISTED] = _whole(low, high)
        return out


def _as_context(words: np.ndarray) -> np.ndarray:
    return np.maximum(words >> np.uint64(16), np.uint64(TAIL))


def _halves(ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (ctx & np.uint64(0xFFFFFFFF)).astype(np.uint32), (ctx >> np.uint64(32)).astype(np.uint16)


def _whole(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))


def _steps(words: np.ndarray) -> np.ndarray:
    """Sorted words as their differences."""
    return np.diff(words, prepend=np.uint64(0))


def _from_steps(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


def _in_training(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS != 0


def _local_heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: the more frequent words with their counts, and the number of tokens (word null)."""
    hasher, words, counts, total = WordHasher(), np.empty(0, np.uint64), np.empty(0, np.int64), 0

    def pieces() -> Iterator[list[np.ndarray]]:
        got, held = [], 0
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1)):
                if _in_training(d):
                    got.append(hasher.word_hashes(hasher.words(t.as_py())))
                    held += len(got[-1]) + 1
                    if held >= CHUNK_TOKENS:
                        yield got
                        got, held = [], 0
        if got:
            yield got

    for got in pieces():
        total += sum(map(len, got)) + len(got)
        words, back = np.unique(np.concatenate([words, *got, np.full(len(got), END)]), return_inverse=True)
        weight = np.ones(len(back), np.int64)
        weight[: len(counts)] = counts
        counts = np.bincount(back, weight, len(words)).astype(np.int64)
        keep = counts >= total / (8 * KNOWN) - 1  # what is rarer so far can't count much in the task's share
        words, counts = words[keep], counts[keep]
    keep = counts >= total / (4 * KNOWN)
    yield pa.RecordBatch.from_arrays([pa.array([None, *words[keep].view(np.int64).tolist()], pa.int64()),
                                      pa.array([total, *counts[keep].tolist()], pa.int64())], names=["word", "n"])


def _owner(ctx: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket that sums the totals of a context outside the frequent ones."""
    return ((ctx >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)


def _chunked(heavy: np.ndarray, known: np.ndarray, buckets: int):
    """Texts as chunks; ``heavy`` sorted, ``known`` the other words whose contexts have numbers."""
    listed = np.concatenate([heavy, known])
    order = np.argsort(listed)
    listed, number_of = listed[order], (order + 2).astype(np.uint16)
    width = len(heavy) + 2

    def flush(docs: list, chunk: int) -> Iterator[tuple]:
        docs = sorted(docs, key=lambda d: not d[1])  # training documents come first
        train = sum(d[1] for d in docs)
        sizes = np.array([len(d[2]) for d in docs])
        words = np.concatenate([d[2] for d in docs])
        doc = np.repeat(np.arange(len(docs), dtype=np.uint32), sizes)
        own = np.full(len(words), LISTED, np.uint16)  # the number that a word has as a context
        if len(listed):
            at = np.minimum(np.searchsorted(listed, words), len(listed) - 1)
            own = np.where(listed[at] == words, number_of[at], own)
        is_heavy = own < width
        number, ctx = np.empty(len(words), np.uint16), np.empty(len(words), np.uint64)
        number[1:], ctx[1:] = own[:-1], np.where(is_heavy[:-1], own[:-1].astype(np.uint64), _as_context(words[:-1]))
        starts = np.cumsum(sizes) - sizes
        number[starts], ctx[starts] = START, START
        ids = np.array([-(2**63) if d[0] is None else d[0] for d in docs], np.int64)
        yield chunk, -2, pack(ids, np.array([d[0] is None for d in docs], np.int32), sizes)
        head = np.array([train, len(docs)], np.int64)
        here = is_heavy & (ctx < TAIL)
        yield chunk, -1, pack(head, own[here] - np.uint16(2), ctx[here].astype(np.uint16), doc[here])
        bucket = np.where(is_heavy, _owner(ctx, buckets), ((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32))
        order = np.flatnonzero(~here)
        order = order[np.lexsort((words[order], bucket[order]))]
        words, number, ctx, doc, bucket = words[order], number[order], ctx[order], doc[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            part = slice(cuts[k], cuts[k + 1])
            first = np.flatnonzero(np.diff(words[part], prepend=~words[part][:1]))
            runs = np.diff(first, append=cuts[k + 1] - cuts[k]).astype(np.uint32)
            yield chunk, k, pack(head, _steps(words[part][first]), _thin(runs), number[part], *_halves(ctx[part][number[part] == LISTED]),
                                 _thin(doc[part]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, task = WordHasher(), TaskContext.get().partitionId()
        docs, held, n = [], 0, 0
        end = np.array([END])

        def rows(out):
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()),
                                               pa.array([r[2] for r in out], pa.binary())], names=["chunk", "bucket", "payload"])
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1)):
                docs.append((d, _in_training(d), np.concatenate([hasher.word_hashes(hasher.words(t.as_py())), end])))
                held += len(docs[-1][2])
                if held >= CHUNK_TOKENS:
                    yield rows(list(flush(docs, (task << 32) + n)))
                    docs, held, n = [], 0, n + 1
        if docs:
            yield rows(list(flush(docs, (task << 32) + n)))
    return run


def _summed(words: np.ndarray, ctx: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts by (word, context), sorted."""
    order = np.lexsort((ctx, words))
    words, ctx, n = words[order], ctx[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (ctx[1:] != ctx[:-1])])) if len(words) else np.empty(0, np.int64)
    return words[first], ctx[first], np.add.reduceat(n, first) if len(first) else n


def _bucket_counts(payloads: list[bytes], contexts: Contexts) -> bytes:
    """Training counts by (word, context) of one bucket, merged chunk by chunk; 0 for pairs of held-out texts alone."""
    held = [np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64)]
    waiting = [held]
    for payload in payloads:
        arrays = unpack(payload)
        if len(arrays) == 6:  # counts already
            waiting.append(list(_opened(payload, contexts)))
            continue
        head, words, runs, number, low, high, doc = arrays
        waiting.append(list(_summed(np.repeat(_from_steps(words), runs), contexts.whole(number, low, high), (doc < head[0]).astype(np.int64))))
        if sum(len(w[0]) for w in waiting[1:]) > 2_000_000:
            waiting = [list(_summed(*[np.concatenate(c) for c in zip(*waiting)]))]
    return _packed_counts(*_summed(*[np.concatenate(c) for c in zip(*waiting)]), contexts)


def _counts(contexts: Contexts):
    """Of the chunks' parts (or counts) of one task: counts by bucket; with bucket -1 those of frequent words in frequent contexts."""
    def run(rows) -> Iterator[tuple]:
        parts, keys, n = {}, np.empty(0, np.int64), np.empty(0, np.int64)
        for _, bucket, payload in rows:
            if bucket >= 0:
                parts.setdefault(bucket, []).append(payload)
            elif bucket == -1:
                arrays = unpack(payload)
                if len(arrays) == 4:
                    head, w, c, doc = arrays
                    arrays = (w.astype(np.int64) * 65_536 + c)[doc < head[0]], np.ones((doc < head[0]).sum(), np.int64)
                keys, at = np.unique(np.concatenate([keys, arrays[0]]), return_inverse=True)
                n = np.bincount(at, np.concatenate([n, arrays[1]]), len(keys)).astype(np.int64)
        if len(keys):
            yield 0, -1, pack(keys, n)
        for bucket, payloads in parts.items():
            yield 0, bucket, _bucket_counts(payloads, contexts)
    return run


def stirling(discount: float, top: int) -> np.ndarray:
    """log of the generalised Stirling numbers S(c, t), c and t up to ``top``."""
    out = np.full((top + 1, top + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(top + 1)
    for c in range(top):
        with np.errstate(divide="ignore"):
            stay = out[c] + np.log(np.maximum(c - discount * t, 0))
        out[c + 1] = stay
        out[c + 1, 1:] = np.logaddexp(stay[1:], out[c, :-1])
    return out


def draw_tables(c: np.ndarray, weight: np.ndarray, discount: float, logs: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Number of tables of dishes with ``c`` customers, where a new table weighs ``weight``."""
    t = np.minimum(c, 1)
    small = np.minimum(c, EXACT).astype(np.uint8)
    order = np.argsort(small, kind="stable")
    cuts = np.searchsorted(small[order], np.arange(2, EXACT + 2))
    del small
    for size in range(2, EXACT + 1):
        of = order[cuts[size - 2]:cuts[size - 1]]
        room = (1 << 18) // size
        for at in range(0, len(of), room):
            part = of[at:at + room]
            logp = logs[size, 1:size + 1] + np.arange(1, size + 1) * np.log(weight[part])[:, None]
            p = np.cumsum(np.exp(logp - logp.max(1, keepdims=True)), axis=1)
            t[part] = 1 + (p < rng.random(len(part))[:, None] * p[:, -1:]).sum(1)
    big = np.flatnonzero(c > EXACT)
    seated = np.full(len(big), EXACT, np.int64)
    while len(big):  # the rest sits down in steps of an eighth
        step = np.minimum(np.maximum(1, seated // 8), c[big] - seated)
        t[big] += rng.binomial(step, weight[big] / (weight[big] + seated - discount * t[big]))
        seated = seated + step
        more = seated < c[big]
        big, seated = big[more], seated[more]
    return t


class State:
    """Table totals after a step: of the contexts, of the root, and the root's customers; V and N of the corpus."""

    def __init__(self, tables: np.ndarray, root_tables: float, root_customers: float, contexts: np.ndarray, vocabulary: int, tokens: int,
                 heavy: np.ndarray = np.empty(0, np.uint64), counts: np.ndarray = np.empty(0, np.int64), p: np.ndarray = np.empty(0)):
        self.tables, self.root_tables, self.root_customers = tables, root_tables, root_customers
        self.contexts, self.vocabulary, self.tokens = contexts, vocabulary, tokens
        self.heavy, self.counts, self.p = heavy, counts, p  # frequent words: hashes, counts, root probabilities

    def wider(self, tables: np.ndarray, customers: np.ndarray) -> State:
        """With the contexts of a bucket that are no frequent words."""
        return State(np.concatenate([self.tables, tables]), self.root_tables, self.root_customers,
                     np.concatenate([self.contexts, customers]), self.vocabulary, self.tokens, self.heavy, self.counts, self.p)

    def frequent(self, words: np.ndarray, values: np.ndarray, other: np.ndarray) -> np.ndarray:
        """``values`` of frequent words, else ``other``."""
        if not len(self.heavy):
            return other
        at = self.number(words)
        return np.where(at >= 0, values[at], other)

    def number(self, words: np.ndarray) -> np.ndarray:
        """Numbers of frequent words; -1 for others."""
        if not len(self.heavy):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.heavy, words), len(self.heavy) - 1)
        return np.where(self.heavy[at] == words, at, -1)

    def new(self) -> np.ndarray:
        """Weight of the parent in each context."""
        return STRENGTH + DISCOUNT * self.tables

    def unknown(self) -> float:
        """Root probability of a word without customers."""
        return (ROOT_STRENGTH + ROOT_DISCOUNT * self.root_tables) / (self.vocabulary + 1) / (ROOT_STRENGTH + self.root_customers)


def seat(words: np.ndarray, ctx: np.ndarray, n: np.ndarray, state: State, seed: list[int]):
    """One Gibbs step over the words of a bucket: tables by entry; by word the root's customers and tables.
    Frequent words have their root probability from the former step; their customers here are part of all."""
    rng = np.random.default_rng(seed)
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.empty(0, np.int64)
    word = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(first, append=len(words)))
    total = np.add.reduceat(n, first) if len(first) else n
    base = (ROOT_STRENGTH + ROOT_DISCOUNT * state.root_tables) / (state.vocabulary + 1)
    p = (total + 0.1) / (state.tokens + 0.1 * (state.vocabulary + 1))
    own, root = stirling(DISCOUNT, EXACT), stirling(ROOT_DISCOUNT, EXACT)
    mine = ctx != OTHER
    t, s, r = np.where(mine, 0, n), total, total
    for _ in range(2):
        p = state.frequent(words[first], state.p, p)
        t = np.where(mine, 0, n)  # customers of the other contexts are the root's own
        t[mine] = draw_tables(n[mine], state.new()[ctx[mine]] * p[word[mine]], DISCOUNT, own, rng)
        r = np.bincount(word, t, len(first)).astype(np.int64)
        s = draw_tables(r, np.full(len(first), base), ROOT_DISCOUNT, root, rng)
        p = (r - ROOT_DISCOUNT * s + base) / (ROOT_STRENGTH + state.root_customers)
    return first, word, total, t, r, s


def _opened(payload: bytes, contexts: Contexts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, contexts and counts of a bucket."""
    words, runs, number, low, high, n = unpack(payload)
    return np.repeat(_from_steps(words), runs), contexts.whole(number, low, high), n.astype(np.int64)


def _numbers(ctx: np.ndarray, own: np.ndarray, width: int) -> np.ndarray:
    """Numbers of contexts; those of ``own`` have the numbers from ``width`` on."""
    return np.where(ctx < TAIL, ctx.astype(np.int32), (width + np.searchsorted(own, ctx)).astype(np.int32))


def _own(ctx: np.ndarray) -> np.ndarray:
    return np.unique(ctx[ctx >= TAIL])


def _asks(bucket: int, own: np.ndarray, buckets: int, *values: np.ndarray) -> Iterator[tuple]:
    """Rows (owner, bucket, payload): a bucket's part of the totals of its contexts."""
    cuts = np.searchsorted(_owner(own, buckets), np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        part = slice(cuts[k], cuts[k + 1])
        yield k, bucket, pack(own[part][:1], _thin(np.diff(own[part])), *[_thin(v[part]) for v in values])


def _asked(payload: bytes) -> list[np.ndarray]:
    first, steps, *values = unpack(payload)
    return [np.cumsum(np.concatenate([first, steps.astype(np.uint64)]), dtype=np.uint64), *[v.astype(np.int64) for v in values]]


def _answers(last: bool):
    """Answers of one owner to each bucket. After a step (0: before the first): its totals of the contexts whose tables vary
    there; at last, of all contexts: customers, then tables after the steps from BURN - 1 on."""
    def run(table: pa.Table) -> pa.Table:
        rows = [(k, b, _asked(x)) for k, b, x in zip(*[table.column(c).to_pylist() for c in ("step", "bucket", "payload")])]
        full = [(b, x) for k, b, x in rows if k == 0] if last else [(b, x) for _, b, x in rows]
        ids, at = np.unique(np.concatenate([x[0] for _, x in full]), return_inverse=True)
        out = []
        if not last:
            totals = np.bincount(at, np.concatenate([x[-1] for _, x in full]), len(ids)).astype(np.int64)
            totals = [totals]
        else:
            customers, dishes = [np.bincount(at, np.concatenate([x[i] for _, x in full]), len(ids)).astype(np.int64) for i in (1, 3)]
            totals = [customers]
            for step in range(BURN, BURN + SAMPLES + 1):
                got = [x for k, _, x in rows if k == step] if step else []
                more = np.zeros(len(ids), np.int64)
                for x in got:
                    more[np.searchsorted(ids, x[0])] += x[-1]
                totals.append(dishes + more)
        end = 0
        for b, x in full:
            part = at[end:end + len(x[0])]
            end += len(x[0])
            if not last and len(x) == 4:
                part = part[x[2] > 0]
            out.append((b, pack(*[_thin(v[part]) for v in totals])))
        return pa.table({"bucket": pa.array([x[0] for x in out], pa.int32()), "owner": pa.array([table.column("owner")[0].as_py()] * len(out), pa.int32()),
                         "payload": pa.array([x[1] for x in out], pa.binary())})
    return run


def _told(answers: list, bucket: int, step: int, arrays: int = 1) -> list[np.ndarray]:
    """Answers after a step, in the order of the bucket's contexts."""
    rows = sorted((o, x) for b, o, x, k in answers if (b, k) == (bucket, step))
    return [np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for x in zip(*[unpack(x) for _, x in rows])] or [np.empty(0, np.int64)] * arrays


def _step(state: State, step: int, buckets: int, contexts: Contexts):
    """A bucket's Gibbs step over what varies: rows for the owners of its contexts; for the driver (owner -1) the tables beyond the
    first of each dish in the first contexts, the root's tables and customers, and the root customers of the frequent words."""
    width = len(state.contexts)

    def run(both: tuple[list, list]) -> list[tuple]:
        out, (slim, told) = [], both
        for _, bucket, payload in slim:
            words, ctx, n = _opened(payload, contexts)
            own = _own(ctx)
            ctx = _numbers(ctx, own, width)
            tables = _told(told, bucket, 0)[0] + (_told(told, bucket, step)[0] if step else 0)
            first, _, _, t, r, s = seat(words, ctx, n, state.wider(tables, tables), [step, bucket + 5])
            more = np.bincount(ctx, np.where(ctx == OTHER, 0, t - 1), width + len(own)).astype(np.int64)
            at = state.number(words[first])
            often = np.bincount(at[at >= 0], r[at >= 0], len(state.heavy))
            out.append((-1, bucket, pack(np.concatenate([more[:width], [s[at < 0].sum(), r[at < 0].sum()], often]).astype(np.float64))))
            out += _asks(bucket, own, buckets, more[width:])
        return out
    return run


def _slim(words: np.ndarray, ctx: np.ndarray, n: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What varies in a Gibbs step: single customers, who have one table each, count as customers of the root (context OTHER), and words
    seen once are left out."""
    first = np.flatnonzero(np.diff(words, prepend=~words[:1]))
    ones = np.add.reduceat(n == 1, first, dtype=np.int64) if len(first) else np.empty(0, np.int64)
    total = np.add.reduceat(n, first) if len(first) else ones
    put = (ones > 0) & ((total > 1) | often[first])
    rest = n > 1
    return _summed(np.concatenate([words[rest], words[first][put]]), np.concatenate([ctx[rest], np.full(put.sum(), OTHER, np.uint64)]),
                   np.concatenate([n[rest], ones[put]]))


def _packed_counts(words: np.ndarray, ctx: np.ndarray, n: np.ndarray, contexts: Contexts) -> bytes:
    first = np.flatnonzero(np.diff(words, prepend=~words[:1]))
    return pack(_steps(words[first]), _thin(np.diff(first, append=len(words))), *contexts.split(ctx), _thin(n))


def _first_asks(heavy: np.ndarray, width: int, buckets: int, contexts: Contexts):
    """Before the first step: customers, whether the tables vary, and dishes of the contexts, for their owners; for the driver the
    customers and dishes of the first contexts, the number of other words, of those seen once, and of all dishes, and
    the counts of the frequent words; with owner -2 the counts that vary."""
    frequent = State(np.empty(0), 0, 0, np.empty(0), 0, 0, heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words, ctx, n = _opened(payload, contexts)
                at = frequent.number(words)
                slim = _slim(words, ctx, n, at >= 0)
                own = _own(ctx)
                number = _numbers(ctx, own, width)
                customers, dishes = [np.bincount(number, x, width + len(own)).astype(np.int64) for x in (n, n > 0)]
                varies = np.isin(own, _own(slim[1]), assume_unique=True)
                total = np.unique(words[(at < 0)], return_inverse=True)[1]
                total = np.bincount(total, n[at < 0])
                sums = np.concatenate([customers[:width], dishes[:width], [(total > 0).sum(), (total == 1).sum(), dishes.sum()],
                                       np.bincount(at[at >= 0], n[at >= 0], len(heavy))])
                out = [(-2, bucket, _packed_counts(*slim, contexts)), (-1, bucket, pack(sums.astype(np.float64))),
                       *_asks(bucket, own, buckets, customers[width:], varies, dishes[width:])]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()),
                                                  pa.array([x[2] for x in out], pa.binary())], names=["owner", "bucket", "payload"])
    return run


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = None
    for b in batches:
        for payload in b.column(0).to_pylist():
            got = unpack(payload)[0]
            sums = got if sums is None else sums + got
    if sums is not None:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums)], names=["at", "x"])


def _for_driver(asked: DataFrame, size: int) -> np.ndarray:
    rows = asked.filter("owner = -1").select("payload").mapInArrow(_sum_rows, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
    return np.bincount([r["at"] for r in rows], [r.x for r in rows], size) if rows else np.zeros(size)


def _exchanged(asked: DataFrame, step: int) -> DataFrame:
    return reliable_checkpoint(asked.filter("owner >= 0").withColumn("step", F.lit(step)).groupBy("owner").applyInArrow(
        _answers(False), "bucket int, owner int, payload binary").withColumn("step", F.lit(step)))


def predictive(words, ctx, n, states: list[tuple[State, State]], bucket: int):
    """Mean predictive probabilities: per word its count and root probability and per-context entries
    (word number, context, probability gain); per state the weight of the root in each context."""
    out = []
    for step, (before, after) in enumerate(states, BURN):
        first, word, total, t, r, s = seat(words, ctx, n, before, [step, bucket + 5])
        base = (ROOT_STRENGTH + ROOT_DISCOUNT * after.root_tables) / (after.vocabulary + 1)
        root = after.frequent(words[first], after.p, (r - ROOT_DISCOUNT * s + base) / (ROOT_STRENGTH + after.root_customers))
        gain = np.where(ctx == OTHER, 0.0, (n - DISCOUNT * t) / (STRENGTH + after.contexts[ctx]))
        out.append((root, gain))
    return first, word, total, out


def back_off(state: State) -> np.ndarray:
    """What a context leaves to the root; 1 for contexts without a restaurant."""
    out = state.new() / (STRENGTH + state.contexts)
    out[OTHER] = 1.0
    return out


def _scores(states: list[tuple[State, State]], contexts: Contexts, table: np.ndarray):
    """Of the chunks' parts of one task beside the model of their buckets: sums by chunk and document. ``table`` has the probabilities of
    frequent words in frequent contexts; the chunks' ids are passed on."""
    width, last = len(states[-1][1].contexts), states[-1][1]

    def tail(bucket: int, pieces: list, counts: bytes, answers: list) -> Iterator[tuple]:
        words, ctx, n = _opened(counts, contexts)
        own = _own(ctx)
        ctx = _numbers(ctx, own, width)
        customers, *tables = _told(answers, bucket, 0, SAMPLES + 2)
        wide = [(x.wider(before, customers), y.wider(after, customers)) for (x, y), before, after in zip(states, tables, tables[1:])]
        first, word, total, samples = predictive(words, ctx, n, wide, bucket)
        total = last.frequent(words[first], last.counts, total)
        known_words, key = words[first], (word.astype(np.int64) << 32) + ctx
        backs = [back_off(after) for _, after in wide]
        del words, ctx, n, word
        numbered = np.zeros(LISTED + 1, np.int64)
        numbered[:len(contexts.values)] = _numbers(contexts.values, own, width)
        for chunk, payload in pieces:
            head, w, runs, number, low, high, doc = unpack(payload)
            at = np.repeat(np.searchsorted(known_words, _from_steps(w)), runs)
            c = numbered[number]
            c[number == LISTED] = _numbers(_whole(low, high), own, width)
            entry = np.searchsorted(key, (at << 32) + c)
            p = np.zeros(len(at))
            for (root, gain), back in zip(samples, backs):
                p += root[at] * back[c] + gain[entry]
            yield chunk, 0, _sums(doc, int(head[1]), total[at], p / len(wide), last)

    def run(both: tuple[list, list]) -> Iterator[tuple]:
        pieces, model = both
        parts = {}
        for chunk, bucket, payload in pieces:
            if bucket >= 0:
                parts.setdefault(bucket, []).append((chunk, payload))
            elif bucket == -1:
                head, w, c, doc = unpack(payload)
                yield chunk, 0, _sums(doc, int(head[1]), last.counts[w], table[w, c], last) if len(w) else _sums(doc, int(head[1]), w, w, last)
            else:
                yield chunk, bucket, payload
        for bucket, mine in parts.items():
            [counts] = [x for b, _, x, k in model if (b, k) == (bucket, -1)]
            yield from tail(bucket, mine, counts, model)
    return run


def _sums(doc: np.ndarray, docs: int, count: np.ndarray, p: np.ndarray, state: State) -> bytes:
    """Sums of the documents that have tokens here: a bucket has few of them once there are many buckets."""
    base = np.log10((count + 0.1) / (state.tokens + 0.1 * (state.vocabulary + 1)))
    own = np.flatnonzero(np.bincount(doc, minlength=docs))
    return pack(_steps(own.astype(np.uint64)).astype(np.uint32), np.bincount(doc, base, docs)[own], np.bincount(doc, np.log10(p), docs)[own],
                _thin(np.bincount(doc, count > 0, docs)[own].astype(np.uint32)))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for payload in b.column(0).to_pylist():
            key, n = unpack(payload)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n, pa.int64())], names=["key", "n"])


def _documents(tokens: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("bucket").to_pylist(), table.column("payload").to_pylist()), key=lambda r: r[0])
        ids, no_id, sizes = unpack(rows[0][1])
        sums = np.zeros((3, len(ids)))
        for _, payload in rows[1:]:
            steps, *got = unpack(payload)
            sums[:, _from_steps(steps).astype(np.int64)] += got
        ids = [None if z else i for i, z in zip(ids.tolist(), no_id.tolist())]
        n = len(ids)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array([not _in_training(i) for i in ids], pa.bool_()),
                         "n_tokens": pa.array(sizes, pa.int64()), "n_known": pa.array(sums[2].astype(np.int64)),
                         "train_tokens": pa.array([tokens] * n, pa.int64()), "base_score": pa.array(sums[0]), "score": pa.array(sums[1])})
    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = src.mapInArrow(_local_heavy, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = reliable_checkpoint(found)
    tokens = int(found.filter("word is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    often = found.filter(F.col("word").isNotNull()).orderBy(F.desc("n"), "word").limit(KNOWN).toArrow()
    n, often = [often.column(c).to_numpy() for c in ("n", "word")]
    often = often.view(np.uint64)
    heavy, known = np.sort(often[n >= tokens / HEAVY]), often[n < tokens / HEAVY]  # at most HEAVY; the others by falling count
    buckets = max(1, math.ceil(tokens / BUCKET_TOKENS))
    parts = max(1, math.ceil(tokens / HEAVY / PART_TOKENS))
    width, often = len(heavy) + 2, len(heavy)
    code = Contexts(width, known)
    spark, slots = docs.sparkSession, buckets * parts

    def dealt(rows, slot):
        """Rows shuffled to the partitions of their slots: ``parts`` slots for each bucket."""
        return rows.map(lambda r: (slot(r), tuple(r))).partitionBy(slots, int).values()

    def home(r) -> int:
        return r[1] * parts if r[1] >= 0 else 0

    def spread(r) -> int:
        turn = r[0] + (r[0] >> 32)
        return r[1] * parts + turn % parts if r[1] >= 0 else turn % slots

    # The chunks' parts are shuffled once; counting and scoring read them where they lie.
    chunks = dealt(src.mapInArrow(_chunked(heavy, known, buckets), CHUNKS).rdd, spread)
    counted = chunks.mapPartitions(_counts(code))
    if parts > 1:
        counted = dealt(counted, home).mapPartitions(_counts(code))
    counted = reliable_checkpoint(spark.createDataFrame(counted, CHUNKS).drop("chunk"))
    pairs = np.array([(r.key, r.n) for r in counted.filter("bucket = -1").select("payload").mapInArrow(
        _pairs, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()], np.int64).reshape(-1, 2)
    counted = counted.filter("bucket >= 0")
    pairs = pairs[np.argsort(pairs[:, 0])]
    hw, hc, hn = heavy[pairs[:, 0] >> 16], (pairs[:, 0] & 65_535).astype(np.uint16), pairs[:, 1]

    # Customers of the contexts, V, and the first totals: one table per dish.
    asked = reliable_checkpoint(counted.mapInArrow(_first_asks(heavy, width, buckets, code), ASKS))
    slim, asks, told = asked.filter("owner = -2").rdd.map(tuple), [asked], [_exchanged(asked, 0)]
    start = _for_driver(asked, 2 * width + 3 + often)
    contexts, first_tables = np.bincount(hc, hn, width) + start[:width], start[width:2 * width]
    number = pairs[:, 0] >> 16
    count = (np.bincount(number, hn, often) + start[2 * width + 3:]).astype(np.int64)
    vocabulary, once = int(start[2 * width]) + int((count > 0).sum()), start[2 * width + 1]
    state = State(np.bincount(hc, minlength=width) + first_tables, vocabulary, start[2 * width + 2] + len(hn), contexts, vocabulary, tokens,
                  heavy, count, (count + 0.1) / (tokens + 0.1 * (vocabulary + 1)))
    kept = []
    for step in range(BURN + SAMPLES):
        answers = told[0].unionByName(told[step]) if step else told[0]
        beside = slim.glom().zip(dealt(answers.rdd, lambda r: r[0] * parts).glom())
        asked = reliable_checkpoint(spark.createDataFrame(beside.flatMap(_step(state, step, buckets, code)), ASKS))
        asks.append(asked)
        if step < BURN + SAMPLES - 1:
            told.append(_exchanged(asked, step + 1))
        sums = _for_driver(asked, width + 2 + often)
        t = seat(hw, hc, hn, state, [step, 4])[3]
        tables = np.bincount(hc, t, width) + first_tables + sums[:width]
        r = (np.bincount(number, t, often) + sums[width + 2:]).astype(np.int64)
        base = (ROOT_STRENGTH + ROOT_DISCOUNT * state.root_tables) / (vocabulary + 1)
        s = draw_tables(r, np.full(often, base), ROOT_DISCOUNT, stirling(ROOT_DISCOUNT, EXACT), np.random.default_rng([step, 3]))
        after = State(tables, once + sums[width] + s.sum(), once + sums[width + 1] + r.sum(), contexts, vocabulary, tokens, heavy, count)
        base = (ROOT_STRENGTH + ROOT_DISCOUNT * after.root_tables) / (vocabulary + 1)
        after.p = (r - ROOT_DISCOUNT * s + base) / (ROOT_STRENGTH + after.root_customers)
        if step >= BURN:
            kept.append((state, after))
        state = after

    table = np.zeros((max(1, often), width))
    if often:
        _, _, _, samples = predictive(hw, hc, hn, kept, -1)
        for (_, gain), (_, after) in zip(samples, kept):
            table += after.p[:, None] * back_off(after)
            table[number, hc] += gain
        table /= len(kept)
    asked = asks[0].withColumn("step", F.lit(0))
    for k in range(max(1, BURN), BURN + SAMPLES + 1):
        asked = asked.unionByName(asks[k].withColumn("step", F.lit(k)))
    answers = asked.filter("owner >= 0").groupBy("owner").applyInArrow(_answers(True), "bucket int, owner int, payload binary")
    model = counted.select("bucket", F.lit(-1).alias("owner"), "payload", F.lit(-1).alias("step")).unionByName(answers.withColumn("step", F.lit(0)))
    model = dealt(model.rdd.flatMap(lambda r: [(r[0], r[1], r[2], r[3], k) for k in range(parts)]), lambda r: r[0] * parts + r[4])
    pieces = chunks.glom().zip(model.map(lambda r: r[:4]).glom()).flatMap(_scores(kept, code, table))
    pieces = spark.createDataFrame(pieces, CHUNKS)
    return pieces.groupBy("chunk").applyInArrow(
        _documents(tokens), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
