"""WARC archives: writing pages as records, reading them back with boundary-chain verification.

Writing: each page is one record; of records with equal payloads that with the smallest id is a response and the
others are revisits that refer to it. Spark's text writer puts record after record into part files
(a record ends with two line ends, which is the writer's separator), so archives go through Spark's output
commit to any file system Spark knows.

Reading: files are cut by Spark into ranges and read with the version line as separator, so every task emits
the pieces between two occurrences of the version line. Lengths of pieces, summed by range and then within the
range, give each piece its offset in the file. Every piece is a candidate record; its header's
Content-Length gives the offset of its successor. Pointer jumping from offset 0 keeps the candidates that can
be reached (doubling the reach each round, slim rows only), so version lines inside payloads, even whole
records, are not taken for records. The pieces from one kept offset to the next are one record.

Defined results: null html is the empty payload. A null id sorts last among equal payloads. Rows that repeat an
id are records of their own; equal (id, payload) rows are of the same type. An empty table gives an empty archive
and no records. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import rows_with_ids, slim_checkpoint
from riskframe.session import ensure_checkpoint_dir, reliable_checkpoint

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
#: Rows that repeat a payload (about 200 bytes each) are broadcast up to this number, else joined by a shuffle.
BROADCAST_ROWS = 50_000
EPOCH = "1970-01-01T00:00:00Z"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _base32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = b.schema.get_field_index("sha")
        digest = pa.array([base64.b32encode(bytes.fromhex(x)).decode() for x in b.column(at).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*b.columns, digest], names=[*b.schema.names, "digest"])


def _header(kind: str, *more: Column) -> Column:
    """Header lines and the empty line after them."""
    lines = [F.lit(f"{MAGIC}WARC-Type: {kind}\r\nWARC-Date: {EPOCH}\r\n"), *more]
    return F.concat(*lines, F.lit("\r\n"))


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_revisit_bytes: int = 0) -> None:
    """Writes a record per row to part files under ``path``. Payloads under ``min_revisit_bytes`` are never revisits."""
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.regexp_replace(F.col(url_col), r"[\r\n]", " ").alias("url"),
                       F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    src = src.withColumn("sha_own", F.sha1("payload"))
    slim = reliable_checkpoint(src.select("page_id", F.col("sha_own").alias("sha"), F.octet_length("payload").cast("long").alias("bytes")))
    first = slim.groupBy("sha").agg(
        F.min_by("page_id", F.struct(F.col("page_id").isNull(), "page_id")).alias("first"), F.count(F.lit(1)).alias("n"))
    # only the rows that repeat a payload need to know their response
    again = slim.filter(F.col("bytes") >= min_revisit_bytes).join(first.filter("n > 1"), "sha")
    again = again.filter(~F.col("page_id").eqNullSafe(F.col("first"))).select(
        F.col("page_id").alias("dup"), F.col("first").alias("refers_to"), "sha", F.col("bytes").alias("full_bytes")).distinct()
    again = reliable_checkpoint(again.mapInArrow(
        _base32, "dup long, refers_to long, sha string, full_bytes long, digest string"))
    side = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again.hint("shuffle_merge")
    rows = src.join(side, F.col("page_id").eqNullSafe(F.col("dup")) & (F.col("sha_own") == F.col("sha")), "left")

    digest = _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    who = [_line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
           _line("WARC-Target-URI", F.col("url"))]
    body = F.col("payload")
    response = F.concat(_header("response", *who, _line("Content-Length", F.octet_length(body).cast("string"))).cast("binary"), body)
    revisit = _header("revisit", *who, digest, _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
                      _line("X-Payload-Length", F.col("full_bytes").cast("string")), _line("Content-Length", F.lit("0"))).cast("binary")
    record = F.when(F.col("refers_to").isNotNull(), revisit).otherwise(response)
    rows.select(record.cast("string").alias("value")).write.option("lineSep", RECORD_END).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: file, header (text), payload (binary)."""
    raw = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").cast("binary").alias("piece"))
    # slim rows: length of the piece, and of its header (up to the empty line), and the announced length
    head_end = F.instr(F.col("value"), RECORD_END)
    slim = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.octet_length("value").cast("long").alias("bytes"),
        F.when(head_end > 0, F.substring("value", F.lit(1), head_end - 1)).alias("header"))
    slim = slim_checkpoint(slim.withColumn("content", _content_length("header")))
    pieces = _with_offsets(slim)
    size = len(MAGIC)
    follows = F.when(F.col("content").isNotNull(), F.col("offset") + size + F.octet_length("header") + 2 * len(RECORD_END) + F.col("content"))
    pieces = slim_checkpoint(pieces.select("file", "block", "seq", "offset", "bytes", "header", follows.alias("next")))
    starts = _reachable(pieces.select("file", "offset", "next"))

    at = pieces.join(starts.withColumn("start", F.col("offset")), ["file", "offset"], "left")
    upto = Window.partitionBy("file", "block").orderBy("offset")
    at = at.withColumn("within", F.last("start", True).over(upto))
    # records that began in an earlier range of the file: the last start before this range
    last = at.groupBy("file", "block").agg(F.max("start").alias("last"))
    last = last.withColumn("open", F.last("last", True).over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))).drop("last")
    at = at.join(last, ["file", "block"]).select("seq", "file", "offset", F.coalesce("within", "open").alias("record"))
    owned = slim_checkpoint(at.filter("record is not null"))

    # Nearly all records are one piece and pass where they are read; only the pieces of others are grouped.
    many = owned.groupBy("file", "record").agg(F.count(F.lit(1)).alias("pieces")).filter("pieces > 1")
    parts = slim_checkpoint(owned.join(many, ["file", "record"]).select("seq", "record", "offset"))
    skip = slim_checkpoint(slim.select("seq").join(owned.select("seq"), "seq", "left_anti").union(parts.select("seq")))
    single = rows_with_ids(raw, skip, "seq", skip.count(), "left_anti").select("file", F.col("piece").alias("raw"))
    some = rows_with_ids(raw, parts, "seq", parts.count())
    joined = some.join(parts, "seq").groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("offset", "piece"))).alias("p"))
    glue = lambda acc, x: F.concat(acc, F.lit(MAGIC).cast("binary"), x["piece"])
    rest = F.slice("p", F.lit(2), F.size("p"))
    whole = single.unionByName(joined.select("file", F.aggregate(rest, F.element_at("p", 1)["piece"], glue).alias("raw")))
    text = F.col("raw").cast("string")
    whole = whole.withColumn("header", F.substring(text, F.lit(1), F.instr(text, RECORD_END) - 1))
    return whole.select("file", "header", F.substring(
        "raw", F.octet_length("header") + len(RECORD_END) + 1, _content_length("header").cast("int")).alias("payload"))


def _content_length(header: str) -> Column:
    found = F.regexp_extract(header, r"(?i)(?:^|\r\n)Content-Length:[ \t]*(\d{1,18})[ \t]*(?:\r\n|$)", 1)
    return F.when(found != "", found.cast("long"))


def _with_offsets(slim: DataFrame) -> DataFrame:
    """Adds each piece's offset; the first piece of a file, before its first version line, is left out."""
    own = F.col("bytes") + len(MAGIC)
    blocks = slim.groupBy("file", "block").agg(F.sum(own).alias("total"))
    blocks = blocks.withColumn("base", F.coalesce(F.sum("total").over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("total")
    before = F.sum(own).over(Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    placed = slim.withColumn("ahead", F.coalesce(before, F.lit(0))).join(blocks, ["file", "block"])
    # a piece starts after its version line, whose first byte is the candidate's offset
    return placed.withColumn("offset", F.col("base") + F.col("ahead") - len(MAGIC)).filter("offset >= 0").drop("base", "ahead")


def _reachable(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the candidates on the chain of successors that starts at offset 0 of each file."""
    known = candidates.select("file", "offset")
    jump = slim_checkpoint(candidates.filter("next is not null").join(
        known.withColumnRenamed("offset", "next"), ["file", "next"]).select("file", "offset", "next"))
    reached = slim_checkpoint(known.filter("offset = 0"))
    n = reached.count()
    while True:
        further = reached.join(jump, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        reached = slim_checkpoint(reached.union(further).distinct())
        total = reached.count()
        if total == n:
            return reached
        n = total
        to = jump.select("file", F.col("offset").alias("next"), F.col("next").alias("far"))
        jump = slim_checkpoint(jump.join(to, ["file", "next"]).select("file", "offset", F.col("far").alias("next")))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw = b.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([_digest(x) for x in raw]), pa.array([len(x) for x in raw], pa.int64())],
            names=["header", "digest", "bytes"])


def describe(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of records; revisits name their response's payload."""
    known = records.select("header", "payload").mapInArrow(_digests, "header string, digest string, bytes long")
    field = lambda name, what: F.nullif(F.regexp_extract("header", rf"(?i)(?:^|\r\n){name}:[ \t]*{what}", 1), F.lit(""))
    kind = field("WARC-Type", r"(\w+)")
    revisit = kind == "revisit"
    return known.select(
        field("WARC-Record-ID", r"<urn:page:(-?\d+)>").cast("long").alias("page_id"),
        F.when(revisit, field("X-Payload-Length", r"(\d+)").cast("long")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(revisit, field("WARC-Payload-Digest", r"sha1:(\w+)")).otherwise(F.col("digest")).alias("payload_digest"),
        kind.alias("record_type"), field("WARC-Refers-To", r"<urn:page:(-?\d+)>").cast("long").alias("refers_to"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to a new archive in the shared folder and describes what is read back."""
    path = f"{ensure_checkpoint_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, path)
    return describe(read_records(pages.sparkSession, path))
