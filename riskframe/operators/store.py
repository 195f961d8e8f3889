"""Versions of a stored object, of which a reader sees only whole ones."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

MANIFEST = "number long, version string, kind string, settings string"


class ModelStore:
    """Folders of tables below one path, and a manifest that names those that were finished.

    A version gets a folder of its own and becomes visible by its row in the manifest, which is
    written last. A writer that stops halfway leaves a folder that nobody reads; readers of an older
    version are not disturbed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, path: str) -> bool:
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(found)

    def begin(self) -> str:
        """The folder of a new version."""
        return f"{self.path}/versions/{uuid.uuid4().hex}"

    def commit(self, folder: str, kind: str, settings: dict) -> None:
        row = (self._last_number() + 1, folder.rsplit("/", 1)[1], kind, json.dumps(settings))
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def _manifest(self):
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")

    def _last_number(self) -> int:
        if not self._exists(f"{self.path}/manifest/_SUCCESS"):
            return 0
        return self._manifest().agg(F.max("number")).first()[0] or 0

    def latest(self, kind: str) -> tuple[str, dict]:
        """(folder, settings) of the newest finished version."""
        if not self._last_number():
            raise ValueError(f"nothing finished is stored at {self.path}")
        row = self._manifest().orderBy(F.desc("number"), "version").first()
        if row["kind"] != kind:
            raise ValueError(f"{self.path} holds a {row['kind']}, not a {kind}")
        return f"{self.path}/versions/{row['version']}", json.loads(row["settings"])
