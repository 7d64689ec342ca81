"""Versioned model store.

``<path>/versions/<n>/`` holds one model and its manifest, ``<path>/current/<n>``
is an empty pointer file.  Saving writes the model, then the manifest, then the
pointer; a reader takes the highest pointer.  A writer that stops at any step
leaves the version before it in place, and files are only ever added, so this
works on any Hadoop filesystem.  Two writers at once get versions of their own.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from matchstats.operators.trees import Forest, TreeModel

FORESTS_DDL = ("forest int, root array<long>, feature array<int>, threshold array<double>, left array<long>, "
               "value array<array<double>>, gain array<double>, classes array<int>")


class Folder:
    """A folder of any Hadoop filesystem."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def create(self, name: str, data: bytes = b"") -> bool:
        """Write a new file; False if there is one already."""
        if self.fs.exists(self._at(name)):
            return False
        try:
            out = self.fs.create(self._at(name), False)
        except Exception:
            if self.fs.exists(self._at(name)):  # another writer was first
                return False
            raise
        out.write(bytearray(data))
        out.close()
        return True

    def remove(self, name: str) -> None:
        self.fs.delete(self._at(name), True)

    def reserve(self, name: str) -> bool:
        """Make a new folder by a marker file in it; False if it is taken."""
        return self.create(f"{name}/_taken")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, ascending."""
    return [int(n) for n in Folder(spark, path).names("current")]


def save(spark: SparkSession, model: PipelineModel | TreeModel, path: str, name: str, metrics: DataFrame | None = None) -> int:
    """Add ``model`` as the newest version; returns its number."""
    store = Folder(spark, path)
    number = max([0, *map(int, store.names("versions"))]) + 1
    while not store.reserve(f"versions/{number:08d}"):
        number += 1
    at = f"{path.rstrip('/')}/versions/{number:08d}"
    manifest = {"version": number, "model_name": name}
    if isinstance(model, TreeModel):
        manifest |= {"kind": model.kind, "feats": model.feats, "start": model.start, "rate": model.rate, "estimator": "TreeModel"}
        rows = [(i, f.root.tolist(), f.feature.tolist(), f.threshold.tolist(), f.left.tolist(), f.value.tolist(),
                 f.gain.tolist(), list(c)) for i, (f, c) in enumerate(zip(model.forests, model.classes))]
        spark.createDataFrame(rows, FORESTS_DDL).write.parquet(f"{at}/model")
    else:
        manifest |= {"estimator": model.stages[-1].__class__.__name__}
        model.write().save(f"{at}/model")
    if metrics is not None:
        manifest["metrics"] = [r.asDict() for r in metrics.collect()]  # a row per model or fold
    store.create(f"versions/{number:08d}/manifest.json", json.dumps(manifest).encode())
    store.create(f"current/{number:08d}")
    return number


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """Of the given or newest version; None where there is none."""
    found = versions(spark, path)
    if not found:
        return None
    number = found[-1] if version is None else version
    lines = spark.read.text(f"{path.rstrip('/')}/versions/{number:08d}/manifest.json", wholetext=True).collect()
    return json.loads(lines[0]["value"])


def load(spark: SparkSession, path: str, version: int | None = None) -> PipelineModel | TreeModel:
    found = manifest(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"no model in {path}")
    at = f"{path.rstrip('/')}/versions/{found['version']:08d}/model"
    if found["estimator"] != "TreeModel":
        return PipelineModel.load(at)
    rows = spark.read.parquet(at).orderBy("forest").collect()
    forests = [Forest(np.array(r["root"], np.int64), np.array(r["feature"], np.int16), np.array(r["threshold"], float),
                      np.array(r["left"], np.int64), np.array(r["value"], float), np.array(r["gain"], float)) for r in rows]
    return TreeModel(found["kind"], found["feats"], forests, [list(r["classes"]) for r in rows], found["start"], found["rate"])
