"""Versioned model artefacts: folders that are never changed once written, and a pointer that is replaced as a whole.

``save`` writes a new version (a fitted pipeline, a table, or text such as a model's JSON) with a manifest: name, kind, schema, settings, metrics. The pointer moves only when
everything is in place, by a rename that replaces it, so a reader sees the old version or the new one. Files are reached by Spark's own file systems.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        jvm = spark._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(f"{self.base}/{p}")
        root = self._path(".")
        conf = spark._jsc.hadoopConfiguration()
        self._fs = root.getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(root.toUri(), conf) if root.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf)
        self._overwrite = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE

    def _put(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def _get(self, path: str) -> str | None:
        at = self._path(path)
        if not self._fs.exists(at):
            return None
        stream = self._fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def save(self, name: str, model: MLWritable | DataFrame | str, settings: dict[str, Any] | None = None, metrics: dict[str, float] | None = None, activate: bool = True) -> str:
        """The new version's name. What is written stays unseen until it is complete."""
        version = f"v{len(self.versions(name)) + 1:06d}-{uuid.uuid4().hex[:8]}"
        at = f"{name}/{version}"
        manifest: dict[str, Any] = {"name": name, "version": version, "settings": settings or {}, "metrics": metrics or {}}
        if isinstance(model, str):
            manifest |= {"kind": "text"}
            self._put(f"{at}/model.txt", model)
        elif isinstance(model, DataFrame):
            manifest |= {"kind": "table", "schema": json.loads(model.schema.json())}
            model.write.parquet(f"{self.base}/{at}/model")
        else:
            manifest |= {"kind": "pipeline", "stages": [type(s).__name__ for s in getattr(model, "stages", [model])]}
            model.write().save(f"{self.base}/{at}/model")
        self._put(f"{at}/manifest.json", json.dumps(manifest))
        if activate:
            self.activate(name, version)
        return version

    def versions(self, name: str) -> list[str]:
        """Complete versions, oldest first."""
        if not self._fs.exists(self._path(name)):
            return []
        found = [str(s.getPath().getName()) for s in self._fs.listStatus(self._path(name)) if s.isDirectory()]
        return sorted(v for v in found if self._fs.exists(self._path(f"{name}/{v}/manifest.json")))

    def current(self, name: str) -> str | None:
        return self._get(f"{name}/CURRENT")

    def activate(self, name: str, version: str) -> None:
        """Points to a version, also an earlier one."""
        if version not in self.versions(name):
            raise KeyError(f"{name} has no version {version}")
        fresh = f"{name}/.{uuid.uuid4().hex}"
        self._put(fresh, version)
        rename = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        rename[0] = self._overwrite
        self._context.rename(self._path(fresh), self._path(f"{name}/CURRENT"), rename)

    def manifest(self, name: str, version: str | None = None) -> dict[str, Any]:
        version = version or self.current(name)
        text = self._get(f"{name}/{version}/manifest.json") if version else None
        if text is None:
            raise KeyError(f"{name} has no version {version}")
        return json.loads(text)

    def load(self, name: str, version: str | None = None) -> PipelineModel | DataFrame | str:
        m = self.manifest(name, version)
        at = f"{name}/{m['version']}"
        if m["kind"] == "text":
            return self._get(f"{at}/model.txt") or ""
        if m["kind"] == "table":
            return self.spark.read.parquet(f"{self.base}/{at}/model")
        return PipelineModel.load(f"{self.base}/{at}/model")
