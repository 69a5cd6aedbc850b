"""Artefact bundles with one commit.

A bundle is a folder with ``versions/<version>/<part>`` and ``manifests/<version>``. Every part is written under a version
of its own first; the manifest (part, schema, rows, files with their sizes) is the last thing written and its success
marker is the commit. A write that dies before leaves a version that no manifest names, which no reader sees; the bundle
as it was stays loadable. Readers take the newest committed manifest, refuse it if a named file is missing or has another
size, and read only named files. Versions start with the time of writing in milliseconds, so the newest name is the last write.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFEST = "part string, schema string, rows long, files array<struct<name: string, bytes: long>>"

Part = DataFrame | Callable[[str], None]


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name below ``path``, bytes) of all files."""
    fs, hpath = _fs(spark, path)
    base = fs.makeQualified(hpath).toString().rstrip("/") + "/"
    out, it = [], fs.listFiles(hpath, True)
    while it.hasNext():
        f = it.next()
        out.append((f.getPath().toString()[len(base):], int(f.getLen())))
    return sorted(out)


@dataclass(frozen=True)
class Bundle:
    """A committed version: its parts with schema (tables only), rows and files."""

    root: str
    version: str
    parts: dict[str, dict]

    def path(self, part: str) -> str:
        return f"{self.root}/versions/{self.version}/{part}"

    def table(self, spark: SparkSession, part: str) -> DataFrame:
        """A part that was given as a table, from the files named in the manifest."""
        entry = self.parts[part]
        if entry["schema"] is None:
            raise ValueError(f"{part} is not a table")
        schema = StructType.fromJson(json.loads(entry["schema"]))
        data = [f"{self.path(part)}/{name}" for name, _ in entry["files"] if name.endswith(".parquet")]
        return spark.read.schema(schema).parquet(*data)


def write_bundle(spark: SparkSession, root: str, parts: Mapping[str, Part]) -> Bundle:
    """Write all parts as a new version and commit it. A part is a table or a function that writes to the path it gets;
    if one fails, nothing is committed."""
    version = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    bundle = Bundle(root.rstrip("/"), version, {})
    rows = []
    for name, part in parts.items():
        schema = count = None
        if isinstance(part, DataFrame):
            part.write.parquet(bundle.path(name))
            written = spark.read.parquet(bundle.path(name))
            schema, count = written.schema.json(), written.count()
        else:
            part(bundle.path(name))
        files = _files(spark, bundle.path(name))
        bundle.parts[name] = {"schema": schema, "rows": count, "files": files}
        rows.append((name, schema, count, files))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(f"{bundle.root}/manifests/{version}")
    return bundle


def load_bundle(spark: SparkSession, root: str) -> Bundle:
    """The newest committed version, checked against its manifest."""
    root = root.rstrip("/")
    fs, found = _fs(spark, f"{root}/manifests/*/_SUCCESS")
    done = sorted(s.getPath().getParent().getName() for s in fs.globStatus(found) or [])
    if not done:
        raise FileNotFoundError(f"no committed bundle in {root}")
    rows = spark.read.schema(MANIFEST).json(f"{root}/manifests/{done[-1]}").collect()  # one row a part
    bundle = Bundle(root, done[-1], {r.part: {"schema": r.schema, "rows": r.rows, "files": [(f.name, f.bytes) for f in r.files]}
                                     for r in rows})
    for part, entry in bundle.parts.items():
        there = dict(_files(spark, bundle.path(part)))
        broken = [name for name, size in entry["files"] if there.get(name) != size]
        if broken:
            raise ValueError(f"bundle {bundle.version}: {part} is incomplete or changed: {broken[:3]}")
    return bundle
