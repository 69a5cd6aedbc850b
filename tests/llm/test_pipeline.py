"""Each stage on its own input, against brute force on a small table."""

from collections import defaultdict

import corpus_pipeline
from riskframe.llm import mixing, packing
from riskframe.llm.common import table
from tests.llm.test_near_dedup import brute as near_classes

SF = "/root/testdata/sf0.001"


def squeezed(t):
    return "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    cols, rows = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        old, new = before.collect(), docs.collect()
        rows[name] = new
        if name != "packing":
            assert docs.columns == cols and {tuple(r) for r in new} <= {tuple(r) for r in old}
        if name == "language ID":
            assert len(new) >= 0.98 * len(old)
        if name == "exact dedup":
            best = {}
            for r in old:
                key = (-len(r.text), r.doc_id)
                best[squeezed(r.text)] = min(key, best.get(squeezed(r.text), key))
            assert sorted(r.doc_id for r in new) == sorted(d for _, d in best.values())
        if name == "MinHash near-dedup":
            kept = sorted(d for d, _, _, stays in near_classes([(r.doc_id, r.text) for r in old], 80) if stays)
            assert sorted(r.doc_id for r in new) == kept and len(kept) < len(old)
        if name == "mixing sources":
            taken = {r.doc_id: (r.taken, r.size) for r in mixing.fair_queue(before).collect()}
            uses = defaultdict(int)
            for r in new:
                uses[r.doc_id] += 1
            assert all(abs(uses[d] * size - t) <= size / 2 for d, (t, size) in taken.items())
        if name == "packing":
            assert sum(r.length for r in new) == sum(
                len(packing.Encoder(*packing.default_vocabulary()).exact.encode(r.text, add_special_tokens=False).ids) + 1 for r in old)
