"""Published sets of result files: one folder for each version, complete when its manifest is there.

A version's parts (tables as Parquet or JSON records, name lists as text, fitted pipelines) are written first;
the manifest, written last, names each part with its kind, columns and rows. Readers take the latest version that
has a manifest and check every part against it, so a half-written or damaged set is an error and never a result.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

KINDS = ("parquet", "json", "text", "pipeline")


class IncompleteSet(ValueError):
    """A part of a published set is missing or differs from the manifest."""


def publish(spark: SparkSession, folder: str, parts: dict[str, tuple[str, object]]) -> str:
    """Writes ``parts`` (name -> (kind, DataFrame, list of names or PipelineModel)) as a new version; returns its name.

    Versions sort by the time of publishing. A version is never changed.
    """
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    manifest = []
    for name, (kind, content) in parts.items():
        path = f"{folder.rstrip('/')}/{version}/{name}"
        if kind not in KINDS:
            raise ValueError(f"{name}: unknown kind {kind}")
        if kind == "pipeline":
            content.write().save(path)
            manifest.append({"name": name, "kind": kind, "schema": None, "rows": len(content.stages)})
            continue
        df = spark.createDataFrame([(v,) for v in content], "value string").coalesce(1) if kind == "text" else content
        getattr(df.write, kind)(path)
        manifest.append({"name": name, "kind": kind, "schema": df.schema.json(), "rows": _read(spark, path, kind, df.schema.json()).count()})
    spark.createDataFrame([(json.dumps(m),) for m in manifest], "value string").coalesce(1).write.text(f"{folder.rstrip('/')}/{version}/_manifest")
    return version


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Names of the complete versions, oldest first."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted(n for n in names if fs.exists(done(f"{folder.rstrip('/')}/{n}/_manifest/_SUCCESS")))


def _read(spark: SparkSession, path: str, kind: str, schema: str | None) -> DataFrame:
    from pyspark.sql import types as T
    if kind == "text":
        return spark.read.text(path)
    return getattr(spark.read.schema(T.StructType.fromJson(json.loads(schema))), kind)(path)


def load(spark: SparkSession, folder: str, version: str | None = None) -> dict[str, object]:
    """Parts of the latest (or the named) version by name, checked against its manifest."""
    known = versions(spark, folder)
    if not known or (version is not None and version not in known):
        raise IncompleteSet(f"{folder}: no complete version {version or ''}".rstrip())
    root = f"{folder.rstrip('/')}/{version or known[-1]}"
    out: dict[str, object] = {}
    for row in spark.read.text(f"{root}/_manifest").collect():  # one row for each part
        part = json.loads(row["value"])
        path = f"{root}/{part['name']}"
        try:
            if part["kind"] == "pipeline":
                held = PipelineModel.load(path)
                n = len(held.stages)
            else:
                held = _read(spark, path, part["kind"], part["schema"])
                n = held.count()
                if part["kind"] == "text":
                    held = [r["value"] for r in held.collect()] if n == part["rows"] else []
        except Exception as e:  # noqa: BLE001 - whatever keeps a part from being read
            raise IncompleteSet(f"{path}: cannot be read") from e
        if n != part["rows"]:
            raise IncompleteSet(f"{path}: {n} rows, the manifest says {part['rows']}")
        out[part["name"]] = held
    return out
