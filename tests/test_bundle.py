"""Artefact bundles: one commit, old version after a failed write, files checked against the manifest."""

import os

import pytest

from riskframe.sources.bundle import load_bundle, write_bundle


def _files_of(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def test_commit_failed_write_and_next_version(spark, tmp_path):
    root = str(tmp_path / "b")
    with pytest.raises(FileNotFoundError):
        load_bundle(spark, root)
    one = spark.createDataFrame([(1, "a", 0.1), (2, None, None)], "id long, `odd name` string, x double")
    text = lambda path: spark.createDataFrame([("hello",)], "t string").write.text(path)
    first = write_bundle(spark, root, {"rows": one, "note": text})
    got = load_bundle(spark, root)
    assert got.version == first.version and got.parts["rows"]["rows"] == 2 and got.parts["note"]["schema"] is None
    table = got.table(spark, "rows")
    assert table.schema == one.schema and sorted(map(str, table.collect())) == sorted(map(str, one.collect()))
    assert spark.read.text(got.path("note")).first()[0] == "hello"
    with pytest.raises(ValueError):
        got.table(spark, "note")

    def dies(path):
        text(path)
        raise OSError("disk")
    with pytest.raises(OSError):
        write_bundle(spark, root, {"rows": one.limit(1), "note": dies})
    assert load_bundle(spark, root) == got

    # A manifest without its success marker is no commit either.
    other = write_bundle(spark, root, {"rows": one.limit(1)})
    assert load_bundle(spark, root).version == other.version
    os.rename(f"{root}/manifests/{other.version}/_SUCCESS", str(tmp_path / "marker"))
    assert load_bundle(spark, root) == got


def test_changed_and_foreign_files(spark, tmp_path):
    root = str(tmp_path / "b")
    df = spark.range(100).repartition(2)
    b = write_bundle(spark, root, {"rows": df, "empty": df.limit(0)})
    assert load_bundle(spark, root).table(spark, "empty").count() == 0
    # A file that no manifest names is not read.
    spark.range(5).coalesce(1).write.mode("append").parquet(b.path("rows"))
    assert load_bundle(spark, root).table(spark, "rows").count() == 100
    named = {f for f, _ in b.parts["rows"]["files"] if f.endswith(".parquet")}
    victim = next(f for f in _files_of(b.path("rows")) if os.path.basename(f) in named)
    with open(victim, "ab") as f:
        f.write(b"x")
    with pytest.raises(ValueError, match="incomplete or changed"):
        load_bundle(spark, root)
