"""Document fingerprints by one-permutation MinHash, in DataFrame expressions only.

The 5-word shingles of a text are hashed once to 64 bits. The top eight bits deal a hash into one of 256
bins, the smallest hash of each bin counts. An empty bin copies the bin that its own probe sequence
(pseudo-random bins, the same in every document) meets first among the filled ones: optimal
densification. Of each value four bits are stored, as one hexadecimal digit per bin.

The likeness of two fingerprints is the share of equal digits, corrected for digits that agree by
chance (1 in 16): an estimate of the Jaccard similarity of the shingle sets, standard error about 0.03.

Smallest hashes per bin come from one sort of the hashes together with one sentinel per bin.

Defined results: a null text is the empty text; a text without words has the empty fingerprint, whose
likeness is 1 with itself and 0 with any other. A text of fewer than five words is one shingle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import WHITE, text_or_empty
from riskframe.session import reliable_checkpoint

SHINGLE_WORDS = 5
BINS = 256
BITS = 4
#: Probes of an empty bin before the filled bin with the smallest hash of (bin, filled bin) is taken.
PROBES = 24
#: Rows whose neighbours one window finds, about.
RANGE_ROWS = 100_000

_LOW56 = (1 << 56) - 1


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the column ``out``: the fingerprint of the text column ``text``."""
    w, h, first, dense, filled = (f"__{out}_{x}" for x in ("words", "hashes", "first", "dense", "filled"))
    tokens = F.split(F.btrim(text_or_empty(text), F.lit(WHITE)), r"[\x20\x09-\x0D]+")
    df = df.withColumn(w, F.filter(tokens, lambda x: x != ""))
    shingle = lambda i: F.xxhash64(*[F.get(F.col(w), i + k) for k in range(SHINGLE_WORDS)])
    count = F.greatest(F.lit(0), F.size(w) - SHINGLE_WORDS)
    sentinels = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.shiftleft(b.cast("long"), 56).bitwiseOR(F.lit(_LOW56)))
    df = df.withColumn(h, F.transform(F.sequence(F.lit(0), count), shingle))
    df = df.withColumn(h, F.sort_array(F.concat(F.col(h), sentinels)))
    bin_of = lambda x: F.shiftrightunsigned(x, 56)
    df = df.withColumn(first, F.filter(h, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(F.col(h), i - 1)))))
    df = df.withColumn(dense, F.transform(first, lambda x: F.when(
        x.bitwiseAND(F.lit(_LOW56)) != F.lit(_LOW56), x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))))
    every = F.sequence(F.lit(0), F.lit(BINS - 1))
    df = df.withColumn(filled, F.filter(every, lambda j: F.get(F.col(dense), j).isNotNull()))

    def value(i: Column) -> Column:
        probes = [F.get(F.col(dense), F.pmod(F.xxhash64(i, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(PROBES)]
        nearest = F.array_min(F.transform(filled, lambda j: F.struct(F.xxhash64(i, j, F.lit(PROBES)).alias("d"), j.alias("j"))))
        return F.coalesce(F.get(F.col(dense), i), *probes, F.get(F.col(dense), nearest["j"]))

    digit = lambda v: F.substring(F.lit("0123456789abcdef"), v + 1, F.lit(1))
    packed = F.array_join(F.transform(every, lambda i: digit(value(i))), "")
    return df.withColumn(out, F.when(F.size(w) == 0, F.lit("")).otherwise(packed)).drop(w, h, first, dense, filled)


def likeness(a: str, b: str) -> Column:
    """Bias-corrected share of equal digits of two fingerprint columns, 0 to 1."""
    pairs = F.zip_with(F.split(F.col(a), ""), F.split(F.col(b), ""), lambda x, y: x == y)
    equal = F.size(F.filter(pairs, lambda x: x)) / F.lit(float(BINS))
    chance = 1.0 / (1 << BITS)
    est = F.greatest(F.lit(0.0), (equal - chance) / (1 - chance))
    return F.when((F.col(a) == "") | (F.col(b) == ""), (F.col(a) == F.col(b)).cast("double")).otherwise(est)


def neighbours(keys: DataFrame, order: list[str], carry: str) -> DataFrame:
    """``keys`` (distinct rows) with columns next_*, and prev_* (also ``prev_<carry>``) of the rows that follow and
    precede in the given order; the ends meet. Rows are range-partitioned; only the ends of each range
    are brought together."""
    ranges = max(1, -(-keys.count() // RANGE_ROWS))
    dealt = reliable_checkpoint(keys.repartitionByRange(ranges, *order).withColumn("__part", F.spark_partition_id()))
    item = F.struct(*order, carry)
    ends = dealt.groupBy("__part").agg(F.min(item).alias("lo"), F.max(item).alias("hi"))
    by_part, every = Window.orderBy("__part"), Window.partitionBy()
    ends = ends.select("__part", F.coalesce(F.lead("lo").over(by_part), F.min("lo").over(every)).alias("after"),
                       F.coalesce(F.lag("hi").over(by_part), F.max("hi").over(every)).alias("before"))
    inside = Window.partitionBy("__part").orderBy(*order)
    rows = dealt.withColumn("__next", F.lead(item).over(inside)).withColumn("__prev", F.lag(item).over(inside)).join(ends, "__part")
    nxt, prev = F.coalesce("__next", "after"), F.coalesce("__prev", "before")
    return rows.select(*keys.columns, *[nxt[c].alias(f"next_{c}") for c in order],
                       *[prev[c].alias(f"prev_{c}") for c in [*order, carry]])


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text replaces the last quarter of the code points by as many of the next document
    (ascending id, nulls first; the first follows the last). Rows that repeat an id and text are one
    document; different texts of one id follow each other by length, then hash.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("tag", F.xxhash64("text"))
    slim = reliable_checkpoint(base.select("doc_id", F.length("text").alias("n"), "tag"))
    keys = slim.distinct()
    if keys.count() < slim.count():
        base = base.dropDuplicates(["doc_id", "tag", "text"])
    near = reliable_checkpoint(neighbours(keys, ["doc_id", "tag"], "n"))

    same = lambda a, b: F.col(f"{a}doc_id").eqNullSafe(F.col(f"{b}doc_id")) & (F.col(f"{a}tag") == F.col(f"{b}tag"))
    rows = base.join(near.withColumnRenamed("doc_id", "k_doc_id").withColumnRenamed("tag", "k_tag"), same("", "k_"))
    given = rows.select(F.col("prev_doc_id").alias("to_doc_id"), F.col("prev_tag").alias("to_tag"),
                        F.substring("text", F.lit(1), F.floor(F.col("prev_n") / 4).cast("int")).alias("tail"))
    edits = rows.select("doc_id", "tag", "text", "n", "next_doc_id", "next_tag").join(given, same("", "to_"))
    kept = F.substring("text", F.lit(1), F.col("n") - F.floor(F.col("n") / 4).cast("int"))
    edits = edits.select("doc_id", "tag", "n", "next_doc_id", "next_tag", "text", F.concat(kept, "tail").alias("edited"))
    done = with_fingerprint(with_fingerprint(edits, "text", "fingerprint"), "edited", "edited_fingerprint")
    done = reliable_checkpoint(done.select(
        "doc_id", "tag", "n", "next_doc_id", "next_tag", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint"))
    other = done.select(F.col("doc_id").alias("o_doc_id"), F.col("tag").alias("o_tag"), F.col("fingerprint").alias("next_fingerprint"))
    return done.join(other, same("next_", "o_")).select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "next_fingerprint").alias("near_next"))
