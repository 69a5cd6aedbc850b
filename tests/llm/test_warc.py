import base64
import hashlib
import random

from riskframe.llm import warc

SCHEMA = "page_id long, url string, html string, header string, seq long"


def trap(payload):
    """A whole record inside a payload."""
    return f"x{warc.RECORD_END}{warc.MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: {len(payload)}\r\n\r\n{payload}\r\n\r\n"


def pages():
    rng = random.Random(1)
    html = [None, "", "a", "é" * 50, warc.MAGIC, warc.MAGIC * 3 + "tail", trap("hello"), trap(trap("deep")), "WARC/1.0", "WARC/1.0\r",
            "\r\n\r\n", "line\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n", "z" * 300_000 + warc.MAGIC + "z" * 100]
    html += ["".join(rng.choice(["<p>", "ü", "WARC/1.0\r\n", "\r\n", "text "]) for _ in range(rng.randint(0, 400))) for _ in range(60)]
    rows = [(i * 2, f"http://x/{i}", h, "h", 1) for i, h in enumerate(html)]
    rows += [(1000 + i, None if i % 2 else "u\r\nWARC-Type: x", h, None, None) for i, h in enumerate(html[::-1])]
    return rows + [(None, "n", "a", None, None), (None, "n", "only here", None, None), (4, "again", "a", None, None), (5, "v", "a", None, None)]


def expected(rows, least=0):
    first = {}
    for d, _, h, *_ in rows:
        if d is not None:
            first[h or ""] = min(d, first.get(h or "", d))
    out = []
    for d, _, h, *_ in rows:
        raw = (h or "").encode()
        f = first.get(h or "")
        again = f is not None and d != f and len(raw) >= least
        out.append((d, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", f if again else None))
    return sorted(map(str, out))


def test_round_trip_with_traps_small_ranges_and_clashing_columns(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "777")  # records span ranges, version lines span their ends
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = spark.createDataFrame(pages(), SCHEMA).coalesce(2)
        assert sorted(str(tuple(r)) for r in warc.round_trip(df).collect()) == expected(pages())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_payloads_come_back_exactly_and_short_ones_need_no_revisit(spark, tmp_path):
    rows = [(1, "u", "ab", "", 1), (2, "u", "ab", "", 1), (3, "u", trap("x" * 99), "", 1), (4, "u", trap("x" * 99), "", 1)]
    path = str(tmp_path / "w")
    warc.write_archive(spark.createDataFrame(rows, SCHEMA), path, min_revisit_bytes=3)
    got = warc.read_records(spark, path)
    assert sorted(bytes(r.payload) for r in got.collect()) == sorted([b"ab", b"ab", trap("x" * 99).encode(), b""])
    assert sorted(str(tuple(r)) for r in warc.describe(got).collect()) == expected(rows, 3)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
