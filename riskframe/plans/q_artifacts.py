"""Registered queries: artefacts written, committed, loaded and used."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskframe.operators.drift import psi_buckets
from riskframe.operators.metrics import threshold_table
from riskframe.operators.woe import WoeModel
from riskframe.plans import q_drift, q_policy, q_woe  # noqa: F401  (their oracles are reused)
from riskframe.plans.common import out
from riskframe.plans.registry import ORACLES, register
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.bundle import load_bundle, write_bundle
from riskframe.sources.io import load_data, load_json_table, save_json_table, save_table
from riskframe.sources.tables import LOAN_KEY, loans, loans_with_gaps, split_filter


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex[:12]}"


@register("artifact_roundtrip", ORACLES["woe_transform"])
def q_artifact_roundtrip(spark, sf):
    """The WOE transform of every loan by an encoder that went through a committed bundle. A second write dies half-way
    and must not be seen."""
    root, encoder = _folder(spark, "artifact_roundtrip"), q_woe.fitted(spark, sf)
    committed = write_bundle(spark, root, {"woe_encoder": encoder.save, "bins": encoder.bins})

    def dies(path):
        raise OSError("write ended half-way")
    try:
        write_bundle(spark, root, {"bins": encoder.bins.limit(1), "woe_encoder": dies})
    except OSError:
        pass
    bundle = load_bundle(spark, root)
    if bundle.version != committed.version or bundle.table(spark, "bins").count() != bundle.parts["bins"]["rows"]:
        raise ValueError("the loaded bundle is not the committed one")
    rows = loans_with_gaps(spark, sf).select(*LOAN_KEY, "y", *q_woe.NUM, *q_woe.CAT)
    return out(WoeModel.load(spark, bundle.path("woe_encoder")).transform(rows))


@register("psi_json_roundtrip", ORACLES["psi_buckets"])
def q_psi_json_roundtrip(spark, sf):
    """The PSI bucket report through JSON."""
    l, path = loans(spark, sf), _folder(spark, "psi_json_roundtrip")
    report = psi_buckets(l.where(split_filter("train")), l.where(split_filter("oot")), "p")
    save_json_table(report, path)
    return out(load_json_table(spark, path, report.schema))


@register("threshold_csv_roundtrip", ORACLES["threshold_table"])
def q_threshold_csv_roundtrip(spark, sf):
    """The threshold table through one CSV file and the reader with a schema (no inference pass)."""
    path = _folder(spark, "threshold_csv_roundtrip")
    table = threshold_table(loans(spark, sf), "y", "p")
    save_table(table.orderBy(F.col("threshold")), path, fmt="csv", single_file=True)
    return out(load_data(spark, path, fmt="csv", schema=table.schema))
