"""Prefix trie of conversations by fixed-length block hashing.

A conversation is a sequence of turns, each known by a 128-bit digest of role and text. Turns are taken in blocks of BLOCK. A
block's hash covers its number and its turn digests, and the running XOR of block hashes names the prefix that ends with
the block (128 bits, from SHA-256). Then:

1. Conversations are grouped by successive block prefixes: one row per distinct block, with its number of members and smallest
   member. A prefix that thousands share is one row from here on, combined before the shuffle.
2. Where a prefix is followed by one block only, all turns of this block have the block's members: nodes come straight from the
   group. Only where siblings diverge (two blocks or more follow the same prefix, a cut-off last block included) turn
   boundaries are refined: the groups' turn prefixes are hashed and grouped, over distinct blocks instead of conversations.
3. Sums over subtrees need no walk of the tree. A node belongs to its smallest member, so a conversation owns the nodes from
   some depth down to its end. The subtree of a node holds all that its members own, but for what its own
   smallest member owns above it: one sum over members, by the same two groupings, less a running sum.

Long conversations are split: turns are numbered within ranges of the sorted table, running values are formed within spans of
SPAN turns and carried over by one row per span. Groups of copies are combined where they are read. The ids
that end at one node are joined to strings in range order, so that what one task hashes last is a few strings.

Defined results: a null role or text is empty. Turns are ordered by turn (null first), equal ones by the digest of role and text; a
repeated row is a turn of its own. A row without conversation id belongs to no conversation. A conversation
without turns ends at the root. An empty table gives no node. Other columns are not read, whatever their names. A very long text
counts by its digest and length only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import slim_checkpoint, text_or_empty
from riskframe.session import reliable_checkpoint

#: Turns of a block; turns of a span (a multiple); bytes of a turn digest.
BLOCK, SPAN, DIGEST = 4, 1024, 16
#: Ids joined to one string on the way to the hash of a node's ends.
IDS_A_STRING = 32_768
# Fixed values of the contract: conversations in families of FAMILY share the start of the first, up to HEAD - 1 turns.
FAMILY, HEAD = 5, 9

NODE = ["depth", "d1", "d2"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# ----------------------------------------------------------------------------------------------------- sequences

def sequences(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id, pos, digest, bytes): turns numbered from 0 within their conversation; bytes are those of the text in UTF-8."""
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    slim = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.unhex(F.substring(F.sha2(named.cast("binary"), 256), 1, 2 * DIGEST)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes")).filter("conv_id is not null")
    order = [F.col("turn").asc_nulls_first(), F.col("digest").asc()]
    ranged = reliable_checkpoint(slim.repartitionByRange(F.col("conv_id"), *order))
    ranged = ranged.withColumn("part", F.spark_partition_id())
    local = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)) - 1
    ahead = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # conversations that go on from an earlier range: at most one a range
    carried = (ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("ahead", F.sum("n").over(ahead)).filter("ahead > 0").select("conv_id", "part", "ahead"))
    rows = ranged.withColumn("pos", local).join(F.broadcast(carried), ["conv_id", "part"], "left")
    return rows.select("conv_id", (F.col("pos") + F.coalesce("ahead", F.lit(0))).cast("long").alias("pos"), "digest", "bytes")


def with_shared_starts(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations: (conv_id, pos, digest, bytes) and all conv_id, turnless ones included.

    Conversation c starts with the first h turns of c - c % 5 and goes on with its own after its first h,
    h = crc32(c as text) % 9.
    """
    turns = reliable_checkpoint(turns)
    convs = turns.select("conv_id").distinct().withColumn(
        "h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD)
    heads = (turns.filter((F.col("pos") < HEAD - 1) & (F.col("conv_id") % FAMILY == 0))
             .groupBy(F.col("conv_id").alias("donor"))
             .agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("head")))  # HEAD - 1 at most
    joined = convs.withColumn("donor", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "donor", "left")
    convs = slim_checkpoint(joined.select("conv_id", "h", F.when(F.col("head").isNotNull(), F.slice(
        "head", F.lit(1), F.col("h").cast("int"))).alias("head")).withColumn("taken", F.greatest(F.size("head"), F.lit(0))))
    given = convs.filter("taken > 0").select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").filter("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "bytes")
    return given.unionByName(own), convs.select("conv_id")


# -------------------------------------------------------------------------------------------------------- blocks

def _hash(block: int, digests: bytes) -> np.ndarray:
    """128 bits for the turns at the start of block number ``block``, as two longs."""
    return np.frombuffer(hashlib.sha256(block.to_bytes(8, "little") + digests).digest()[:16], np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of spans (conv_id, span, sorted turns): hash, XOR of the span's hashes before it, turn digests, text bytes."""
    for batch in batches:
        turns = batch.column("turns")
        flat = turns.flatten()
        digests, sizes = flat.field("digest").to_pylist(), flat.field("bytes").to_pylist()
        ends = np.cumsum(turns.value_lengths().to_numpy(zero_copy_only=False))
        convs, spans = batch.column("conv_id").to_pylist(), batch.column("span").to_pylist()
        out: list[list] = [[] for _ in range(9)]
        at = 0
        for conv, span, end in zip(convs, spans, ends.tolist()):
            before = np.zeros(2, np.int64)
            for k, lo in enumerate(range(at, end, BLOCK)):
                hi = min(lo + BLOCK, end)
                number = span * (SPAN // BLOCK) + k
                joined = b"".join(digests[lo:hi])
                own = _hash(number, joined)
                for column, value in zip(out, (conv, span, number, int(before[0]), int(before[1]), int(own[0]), int(own[1]),
                                               joined, sizes[lo:hi])):
                    column.append(value)
                before = before ^ own
            at = end
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in out[:7]] + [pa.array(out[7], pa.binary()), pa.array(out[8], pa.list_(pa.int64()))],
            names=["conv_id", "span", "b", "x1", "x2", "h1", "h2", "turns", "sizes"])


def blocks_of(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: number b, prefix before it (q1, q2), prefix with it (p1, p2), turns and sizes."""
    spans = turns.groupBy("conv_id", F.floor(F.col("pos") / SPAN).alias("span")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("turns"))  # SPAN at most
    rows = reliable_checkpoint(spans.mapInArrow(
        _blocks, "conv_id long, span long, b long, x1 long, x2 long, h1 long, h2 long, turns binary, sizes array<long>"))
    ahead = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    later = rows.filter("span > 0")
    spanned = rows.join(later.select("conv_id").distinct(), "conv_id", "left_semi")
    carry = (spanned.groupBy("conv_id", "span").agg(F.bit_xor("h1").alias("t1"), F.bit_xor("h2").alias("t2"))
             .withColumn("c1", F.bit_xor("t1").over(ahead)).withColumn("c2", F.bit_xor("t2").over(ahead))
             .filter("span > 0").select("conv_id", "span", "c1", "c2"))
    whole = rows.filter("span = 0").unionByName(later.join(carry, ["conv_id", "span"]).select(
        "conv_id", "span", "b", F.col("x1").bitwiseXOR(F.col("c1")).alias("x1"), F.col("x2").bitwiseXOR(F.col("c2")).alias("x2"),
        "h1", "h2", "turns", "sizes"))
    return whole.select("conv_id", "b", F.col("x1").alias("q1"), F.col("x2").alias("q2"),
                        F.col("x1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("h2")).alias("p2"),
                        "turns", "sizes")


def _turn_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turn prefixes of distinct blocks: depth, digest, parent's digest and text bytes; group and counts are carried along."""
    for batch in batches:
        out: list[list] = [[] for _ in range(8)]
        which = []
        numbers, q1, q2 = (batch.column(c).to_pylist() for c in ("b", "q1", "q2"))
        for row, (b, x1, x2, turns, sizes) in enumerate(zip(
                numbers, q1, q2, batch.column("turns").to_pylist(), batch.column("sizes").to_pylist())):
            before = np.array([x1, x2], np.int64)
            last = before
            for j, size in enumerate(sizes, 1):
                here = before ^ _hash(b, turns[: j * DIGEST])
                for column, value in zip(out, (b * BLOCK + j, *here.tolist(), *last.tolist(), size)):
                    column.append(value)
                last = here
                which.append(row)
        pick = pa.array(which, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).take(pick) for c in ("b", "p1", "p2", "n", "first", "diverges")]
            + [pa.array(c, pa.int64()) for c in out[:6]],
            names=["b", "p1", "p2", "n", "first", "diverges", *NODE, "u1", "u2", "size"])


TURN_NODES = ("b long, p1 long, p2 long, n long, first long, diverges boolean, depth long, d1 long, d2 long, "
              "u1 long, u2 long, size long")


# ---------------------------------------------------------------------------------------------------------- ends

def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal nodes in sorted rows (depth, d1, d2, conv_id) as strings of ids, IDS_A_STRING at most."""
    def packed(key, ids):
        return pa.RecordBatch.from_arrays(
            [pa.array([v], pa.int64()) for v in (*key, ids[0])] + [pa.array([",".join(map(str, ids))])],
            names=[*NODE, "first", "ids"])
    key, ids = None, []
    for batch in batches:
        for *node, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
            if key is not None and (node != key or len(ids) == IDS_A_STRING):
                yield packed(key, ids)
                ids = []
            key = node
            ids.append(conv)
    if ids:
        yield packed(key, ids)


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of a node's strings in order, kept as a running hash."""
    key, state = None, None
    done: list[tuple] = []
    names = [*NODE, "ends_sha256"]

    def flush():
        rows = pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in done], pa.int64()) for k in range(3)] + [pa.array([r[3] for r in done], pa.string())], names=names)
        done.clear()
        return rows
    for batch in batches:
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if node == key:
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                done.append((*key, state.hexdigest()))
            key, state = node, hashlib.sha256(ids.encode())
        if done:
            yield flush()
    if key is not None:
        done.append((*key, state.hexdigest()))
        yield flush()


def ends_of(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, d1, d2, ends_sha256) of nodes at which conversations end."""
    last = blocks.groupBy("conv_id").agg(F.max(F.struct("b", F.size("sizes").alias("m"), "p1", "p2")).alias("l"))
    at = convs.join(last, "conv_id", "left").select(
        F.coalesce(F.col("l.b") * BLOCK + F.col("l.m"), F.lit(0)).cast("long").alias("depth"),
        F.coalesce("l.p1", F.lit(0)).cast("long").alias("d1"), F.coalesce("l.p2", F.lit(0)).cast("long").alias("d2"), "conv_id")
    keys = [*NODE, "conv_id"]
    strings = at.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
        _joined_ids, "depth long, d1 long, d2 long, first long, ids string")
    return strings.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(
        _hashed_ids, "depth long, d1 long, d2 long, ends_sha256 string")


# ---------------------------------------------------------------------------------------------------------- trie

def _by_node(exploded: DataFrame, refined_aggs: list, plain: list) -> DataFrame:
    """Nodes from the turn prefixes of distinct blocks: grouped where blocks diverge, as they are elsewhere."""
    return exploded.filter("diverges").groupBy(*NODE).agg(*refined_aggs).unionByName(
        exploded.filter("not diverges").select(*NODE, *plain))


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations in ``turns`` (conv_id, pos, digest, bytes; pos without gaps) and ``convs``
    (conv_id, one row each): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    blocks = reliable_checkpoint(blocks_of(turns))
    groups = reliable_checkpoint(blocks.groupBy("b", "p1", "p2").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"), F.min("q1").alias("q1"), F.min("q2").alias("q2"),
        F.min("turns").alias("turns"), F.first("sizes").alias("sizes")))
    forks = slim_checkpoint(groups.groupBy("b", "q1", "q2").agg(F.count(F.lit(1)).alias("blocks")).filter("blocks > 1"))
    marked = groups.join(forks, ["b", "q1", "q2"], "left").withColumn("diverges", F.col("blocks").isNotNull())
    exploded = reliable_checkpoint(marked.select(
        "b", "p1", "p2", "n", "first", "diverges", "q1", "q2", "turns", "sizes").mapInArrow(_turn_nodes, TURN_NODES))

    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")).filter("n > 0").select(
        *(F.lit(0).cast("long").alias(c) for c in (*NODE, "u1", "u2", "size")), "n", "conv_id")
    nodes = reliable_checkpoint(_by_node(
        exploded,
        [F.min("u1").alias("u1"), F.min("u2").alias("u2"), F.min("size").alias("size"), F.sum("n").alias("n"), F.min("first").alias("conv_id")],
        ["u1", "u2", "size", "n", F.col("first").alias("conv_id")]).unionByName(root))

    kids = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("u1").alias("d1"), F.col("u2").alias("d2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    valued = reliable_checkpoint(nodes.join(kids, NODE, "left").select(
        *NODE, "u1", "u2", "n", "conv_id", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        ((F.col("n") - 1) * F.col("size")).alias("saved"), F.col("n_children").isNull().cast("long").alias("leaf")))

    # what a conversation owns, in all and above a depth
    span = F.floor(F.col("depth") / SPAN)
    above = Window.partitionBy("conv_id", "span").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    spans = valued.groupBy("conv_id", span.alias("span")).agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    ahead = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carry = spans.select("conv_id", "span", F.sum("saved").over(ahead).alias("carried_saved"), F.sum("leaf").over(ahead).alias("carried_leaf"))
    zero = lambda *cols: sum(F.coalesce(c, F.lit(0)) for c in cols)
    owned = valued.withColumn("span", span).withColumn("up_saved", F.sum("saved").over(above)).withColumn(
        "up_leaf", F.sum("leaf").over(above)).join(carry, ["conv_id", "span"]).select(
        *NODE, "u1", "u2", "n", "conv_id", "n_children", zero("up_saved", "carried_saved").alias("up_saved"),
        zero("up_leaf", "carried_leaf").alias("up_leaf"))
    totals = slim_checkpoint(spans.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf")))

    # sums over members, by block groups and then by node
    by_group = blocks.select("conv_id", "b", "p1", "p2").join(totals, "conv_id").groupBy("b", "p1", "p2").agg(
        F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    held = exploded.select("b", "p1", "p2", "diverges", *NODE).join(by_group, ["b", "p1", "p2"])
    sums = _by_node(held, [F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf")], ["saved", "leaf"]).unionByName(
        totals.agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf")).filter("leaf is not null").select(
            *(F.lit(0).cast("long").alias(c) for c in NODE), "saved", "leaf"))

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("u1"), F.col("d2").alias("u2"),
                           F.col("conv_id").alias("parent_conv_id"))
    rows = owned.join(parents, ["depth", "u1", "u2"], "left").join(sums, NODE).join(ends_of(blocks, convs), NODE, "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        (F.col("leaf") - F.col("up_leaf")).alias("n_leaves"), (F.col("saved") - F.col("up_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """Trie of the contract's rebuilt conversations."""
    return trie(*with_shared_starts(sequences(conversations)))
