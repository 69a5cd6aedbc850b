"""Near-duplicate classes by HyperMinHash sketches, banding and verification on full sets.

A document is the set of its distinct 5-word shingles (ASCII letters in lower case). Its sketch has
256 registers; each stores the leading-zero count and ten mantissa bits of the smallest hash dealt to
it (16 bits instead of 64). Bands of six registers are the join keys of candidates. A candidate's
Jaccard similarity is estimated from equal registers, corrected for chance collisions of compressed
registers; pairs far below the threshold go, the others are verified on their full shingle sets.

With 42 bands of six registers a pair at similarity 0.85 shares no band with probability
(1 - 0.85^6)^42 < 3e-9, at 0.8 with 3e-6; higher similarities less. The estimate drops a pair
only five standard errors below the threshold.

No bucket is expanded into all its pairs:
1. Documents with equal sets are one node (their smallest id) from the start.
2. Every bucket compares its members with one leader, the node with the smallest of LEADERS hashes, so that the 42 buckets
   of a group of copies have a few leaders between them. Links are joined into components, and members of one component
   are not compared again. This dissolves tight groups of any size in linear work.
3. What is left are buckets with several components. Those of up to FEW members list their pairs of
   different components that were not compared yet. The members of larger ones are matched by their rarest shingles
   (prefix filtering, exact): buckets of documents that share a passage but not the threshold make hardly any candidates.
   Where many share even such a shingle (edited copies of one text, near the threshold), blocks of nodes meet in a task,
   which links their components; rows are blocks and members, never pairs.
   So no link between components that share a band is lost, there is no cap, and pairs are rows only where few are candidates.
4. Verification groups pairs into cells (a node and its partners). A full set is formed once, from the whole
   text, and sent once to each cell that needs it.

Defined results: a null or blank text has no shingles, is linked with nothing and is its own component.
A row without an id has a null component and stays. Rows that repeat an id are one document:
equal sets give one row, different sets one row each in the same component. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import rows_with_ids, slim_checkpoint
from riskframe.llm.components import components
from riskframe.llm.shingles import WordHasher
from riskframe.session import reliable_checkpoint

REGISTERS, MANTISSA_BITS = 256, 10
BAND, BANDS = 6, 42
#: Orders by which leaders of buckets are chosen.
LEADERS = 4
#: Pairs verified together, about.
CELL = 128
#: Buckets of up to so many members list their pairs of different components; larger ones go by rare shingles.
FEW = 24
#: Members of a block of nodes that share a frequent shingle, and shingles of all of them, about.
BLOCK, BLOCK_SHINGLES = 256, 1_000_000
#: Standard errors below the threshold at which an estimate still goes on to verification.
SLACK = 5.0
#: Chance that two registers with different smallest hashes look equal, times (a+b)^2/(ab) for set sizes a, b:
#: mean width of a mantissa step (1 / (2 ln 2) of the hash, over 2^10).
COLLISION = 0.7213 / 2**MANTISSA_BITS

SKETCH_SCHEMA = "doc_id long, n_shingles long, set_hash binary, regs binary"


def registers(shingles: np.ndarray) -> np.ndarray:
    """256 registers from sorted distinct 64-bit hashes; 0 is an empty register."""
    out = np.zeros(REGISTERS, np.uint16)
    if len(shingles):
        bucket = (shingles >> np.uint64(56)).astype(np.int64)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))  # hashes are sorted: the first is the smallest
        rest = (shingles[first] << np.uint64(8)) | np.uint64(1 << 7)
        frac, exp = np.frexp(rest.astype(np.float64))
        zeros = 64 - np.minimum(exp, 64)
        mantissa = np.minimum((frac * 2 - 1) * 2**MANTISSA_BITS, 2**MANTISSA_BITS - 1).astype(np.int64)
        out[bucket[first]] = ((zeros + 1) << MANTISSA_BITS) | mantissa
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()
    for b in batches:
        n, sets, regs = [], [], []
        for t in b.column(1):
            s = hasher.shingles(t.as_py())
            n.append(len(s))
            sets.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            regs.append(registers(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(regs, pa.binary())],
            names=["doc_id", "n_shingles", "set_hash", "regs"])


def likely(equal: np.ndarray, filled: np.ndarray, na: np.ndarray, nb: np.ndarray, pct: int) -> np.ndarray:
    """Whether the collision-corrected Jaccard estimate is within SLACK standard errors of the threshold."""
    thr = pct / 100
    chance = COLLISION * na * nb / (na + nb) ** 2.0
    filled = np.maximum(filled, 1)
    est = (equal / filled - chance) / (1 - chance)
    return (est >= thr - SLACK * np.sqrt(thr * (1 - thr) / filled)) & (100 * np.minimum(na, nb) >= pct * np.maximum(na, nb))


def _estimated(pct: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ra, rb = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
                na, nb = (b.column(c).to_numpy() for c in ("na", "nb"))
                keep = likely(((ra == rb) & (ra > 0)).sum(1), ((ra > 0) | (rb > 0)).sum(1), na, nb, pct)
                b = b.filter(pa.array(keep))
            yield b.select(["a", "b"])
    return run


def reaches(x: np.ndarray, y: np.ndarray, pct: int) -> bool:
    """Whether two sorted sets have a Jaccard similarity of pct / 100 or more."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or 100 * len(x) < pct * len(y):
        return False
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= pct * (len(x) + len(y) - both)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full shingle sets, as sorted 64-bit hashes."""
    hasher = WordHasher()
    for b in batches:
        for at in range(b.num_rows):
            yield pa.RecordBatch.from_arrays([b.column("node").slice(at, 1), pa.array(
                [hasher.shingles(b.column("text")[at].as_py()).tobytes()], pa.binary())], names=["node", "full"])


def _verified(pct: int):
    """Pairs of one cell whose full shingle sets reach the threshold."""
    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        full = {node: np.frombuffer(s.as_buffer(), np.uint64) for node, s in zip(sets.column("node").to_pylist(), sets.column("full"))}
        keep = [reaches(full[a], full[b], pct) for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist())]
        return pairs.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; documents whose shingle sets have a
    Jaccard similarity of ``percent`` / 100 or more are linked."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sk = reliable_checkpoint(src.mapInArrow(_sketch, SKETCH_SCHEMA))
    filled = sk.filter("n_shingles > 0 and doc_id is not null")
    sets = filled.groupBy("set_hash").agg(F.min("doc_id").alias("node"))
    nodes = filled.withColumnRenamed("doc_id", "node").join(sets, ["set_hash", "node"]).dropDuplicates(["set_hash", "node"])
    nodes = nodes.select("node", F.col("n_shingles").alias("n"), "regs")

    comps = _linked(src, nodes, percent)
    rows = sk.select("doc_id", "n_shingles", "set_hash").distinct()
    rows = rows.join(sets, "set_hash", "left").join(comps, "node", "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "node", "doc_id"))
    return rows.select("doc_id", "n_shingles", comp.alias("component_id"),
                       F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))


def _linked(src: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Components (node, comp) of the links between nodes."""
    width = BAND * 2
    chunk = lambda b: F.substring("regs", b * width + 1, F.lit(width))
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.when(
        chunk(b) != F.lit(bytes(width)), F.xxhash64(b, chunk(b))))
    bands = nodes.select("node", F.explode(keys).alias("key")).filter("key is not null")
    sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    open_ = slim_checkpoint(bands.join(sizes, "key").select("key", "node"))
    # sketches of the nodes that share a bucket with another one
    nodes = reliable_checkpoint(nodes.join(open_.select("node").distinct(), "node"))

    # the same few leaders in nearly all buckets of a group of copies, so that a member is paired with few
    order = F.xxhash64("node", F.pmod("key", F.lit(LEADERS)))
    lead = open_.groupBy("key").agg(F.min_by("node", order).alias("lead"))
    first = slim_checkpoint(open_.join(lead, "key").filter("node <> lead").select(
        F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct())
    links = slim_checkpoint(_verify(src, _likely_pairs(nodes, first, percent), percent))
    comps = components(links)

    # members of the buckets of three and more that still hold several components
    known = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    members = known.select("node", "comp", F.explode(keys).alias("key")).filter("key is not null")
    several = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter(
        "size > 2 and lo <> hi").select("key", "size")
    members = slim_checkpoint(members.join(several, "key").select("key", "node", "size", "comp"))
    if members.isEmpty():
        return comps
    x, y = members.filter(F.col("size") <= FEW).alias("x"), members.alias("y")
    small = x.join(y, "key").filter("x.node < y.node and x.comp <> y.comp").select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    more = slim_checkpoint(_verify(src, _likely_pairs(nodes, small, percent), percent).union(
        _large(src, nodes, members.filter(F.col("size") > FEW), percent)))
    return comps if more.isEmpty() else components(links.union(more))


def _likely_pairs(nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs that pass the estimate."""
    one = pairs.join(nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra")), "a")
    two = one.join(nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb")), "b")
    return two.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_estimated(percent), "a long, b long")


def _verify(src: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Links among ``pairs``. The pairs of a node are one cell, that of the node with more pairs; a cell of more than
    CELL pairs is split. Sets are formed once."""
    pairs = slim_checkpoint(pairs)
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    ids = slim_checkpoint(ends.groupBy("node").agg(F.count(F.lit(1)).alias("pairs")))
    count = lambda c: ids.select(F.col("node").alias(c), F.col("pairs").alias(f"p{c}"))
    known = pairs.join(count("a"), "a").join(count("b"), "b")
    hub, other = (F.when(F.col("pa") >= F.col("pb"), F.col(x)).otherwise(F.col(y)) for x, y in ("ab", "ba"))
    salt = F.pmod(F.xxhash64(other), F.ceil(F.greatest("pa", "pb") / CELL))
    pairs = slim_checkpoint(known.select("a", "b", F.xxhash64(hub, salt).alias("cell")))
    need = pairs.select(F.col("cell").alias("of_cell"), F.col("a").alias("node")).union(pairs.select("cell", "b")).distinct()
    texts = rows_with_ids(src.withColumnRenamed("doc_id", "node"), ids, "node", ids.count())
    sent = need.join(texts.mapInArrow(_sets, "node long, full binary"), "node").select("of_cell", "node", "full")
    return pairs.groupBy("cell").cogroup(sent.groupBy("of_cell")).applyInArrow(_verified(percent), "a long, b long").distinct()


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node and distinct shingle."""
    hasher = WordHasher()
    for b in batches:
        for node, text in zip(b.column("node").to_pylist(), b.column("text")):
            s = hasher.shingles(text.as_py()).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), node, np.int64)), pa.array(s)], names=["node", "s"])


def _large(src: DataFrame, nodes: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links between different components among the nodes of large buckets.

    Such buckets come from passages that many documents share: their members are alike without reaching the threshold.
    So the members' shingles are ordered from rare to frequent, and two of them are candidates only if they share
    one of the rarest of either: sets with a similarity of p percent must share one of the first n - ceil(p n / 100) + 1, at
    places that leave room for the overlap they need. This loses nothing. Candidates by a shingle of few nodes are estimated
    and verified as others are; those by a shingle of more than FEW are found block by block."""
    held = slim_checkpoint(members.select("node", "comp").distinct().join(nodes.select("node", "n"), "node"))
    texts = rows_with_ids(src.withColumnRenamed("doc_id", "node"), held, "node", held.count())
    shingles = reliable_checkpoint(texts.mapInArrow(_shingle_rows, "node long, s long").distinct())
    common = reliable_checkpoint(shingles.groupBy("s").agg(F.count(F.lit(1)).alias("f")).filter("f > 1"))
    rarest = Window.partitionBy("node").orderBy("f", "s")
    ranked = (shingles.join(common, "s").withColumn("rank", F.row_number().over(rarest))
              .withColumn("shared", F.count(F.lit(1)).over(Window.partitionBy("node"))).join(held, "node")
              .withColumn("place", F.col("n") - F.col("shared") + F.col("rank"))
              .filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1))
    ranked = reliable_checkpoint(ranked.select("s", "node", "comp", "n", "place"))
    posted = ranked.groupBy("s").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    ranked = reliable_checkpoint(ranked.join(posted.select("s", "size"), "s"))
    x, y = ranked.filter(F.col("size") <= FEW).alias("x"), ranked.alias("y")
    room = 1 + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    pairs = x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.comp") != F.col("y.comp"))
                   & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
                   & ((100 + percent) * room >= percent * (F.col("x.n") + F.col("y.n")))).select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    return _verify(src, _likely_pairs(nodes, pairs, percent), percent).union(
        _by_blocks(src, ranked.filter(F.col("size") > FEW), percent))


def _by_blocks(src: DataFrame, many: DataFrame, percent: int) -> DataFrame:
    """Links that join the components of nodes sharing a shingle ``s`` with more than FEW others.

    Nodes with the same rarest such shingle are dealt to blocks of about BLOCK nodes and BLOCK_SHINGLES shingles, and two
    blocks meet in one task if they share one of these shingles. So rows are blocks and their members, not pairs, and a task holds two blocks."""
    home = many.groupBy("node").agg(F.min_by("s", F.struct("size", "s")).alias("s"), F.first("n").alias("n"), F.first("comp").alias("comp"))
    home = slim_checkpoint(home)
    sizes = home.groupBy("s").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).alias("parts"))
    home = slim_checkpoint(home.join(sizes, "s").select(
        "node", "comp", F.xxhash64("s", F.pmod(F.xxhash64("node"), "parts")).alias("block")))
    held = home.count()
    if not held:
        return home.select(F.col("node").alias("a"), F.col("node").alias("b"))
    at = many.select("node", "s").join(home, "node").select("s", "block").distinct()
    x, y = at.alias("x"), at.alias("y")
    meet = slim_checkpoint(x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.block") <= F.col("y.block"))).select(
        F.col("x.block").alias("ba"), F.col("y.block").alias("bb")).distinct())
    sides = meet.select("ba", "bb", F.lit(0).alias("side"), F.col("ba").alias("block")).union(
        meet.filter("ba <> bb").select("ba", "bb", F.lit(1), "bb"))
    texts = rows_with_ids(src.withColumnRenamed("doc_id", "node"), home, "node", held)
    sets = texts.mapInArrow(_sets, "node long, full binary").dropDuplicates(["node", "full"])
    sent = sides.join(home, "block").join(sets, "node").select("ba", "bb", "side", "node", "comp", "full")
    return sent.groupBy("ba", "bb").applyInArrow(_joined(percent), "a long, b long")


def _joined(pct: int):
    """Links that join the components of one block, or of two blocks with each other. Nodes joined by links of this
    task count as one component, and are not compared again."""
    def run(rows: pa.Table) -> pa.Table:
        side, node = rows.column("side").to_numpy(), rows.column("node").to_numpy()
        own = np.unique(rows.column("comp").to_numpy(), return_inverse=True)[1]
        full = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column("full")]
        n, regs = np.array([len(f) for f in full]), np.stack([registers(f) for f in full])
        across, out = side.any(), []
        for i in np.flatnonzero(side == 0).tolist() if across else range(len(node)):
            other = np.flatnonzero((own != own[i]) & ((side == 1) if across else (np.arange(len(node)) > i)))
            same = ((regs[other] == regs[i]) & (regs[i] > 0)).sum(1)
            other = other[likely(same, ((regs[other] > 0) | (regs[i] > 0)).sum(1), n[other], n[i], pct)]
            for j in other.tolist():
                if own[j] != own[i] and reaches(full[i], full[j], pct):
                    out.append((node[i], node[j]))
                    own[own == own[j]] = own[i]
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})
    return run


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document stays (one of each component), with all their columns."""
    found = near_duplicates(docs, id_col, text_col, percent)
    gone = reliable_checkpoint(found.filter("not kept").select(F.col("doc_id").alias(id_col)).distinct())
    return rows_with_ids(docs, gone, id_col, gone.count(), "left_anti").select(*docs.columns)
