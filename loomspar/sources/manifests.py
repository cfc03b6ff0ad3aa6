"""A store of manifests: one Parquet row a version, the last within its time to live counts."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TTL_MS = 86_400_000
SCHEMA = "id string, written bigint, body string"


def new_id() -> str:
    return f"bulk-{uuid.uuid4()}"


class ManifestStore:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def put(self, manifest: dict, now: int | None = None) -> None:
        row = (manifest["id"], now if now is not None else int(time.time() * 1000), json.dumps(manifest, sort_keys=True))
        self.spark.createDataFrame([row], SCHEMA).write.mode("append").parquet(self.folder)

    def get(self, manifest_id: str, now: int | None = None) -> dict | None:
        """None if there is none, it is too old, or it can't be read."""
        now = now if now is not None else int(time.time() * 1000)
        try:
            rows = self.versions().where((F.col("id") == manifest_id) & (F.col("written") > now - TTL_MS)).agg(F.max_by("body", "written").alias("body")).collect()
            return json.loads(rows[0].body) if rows and rows[0].body else None
        except Exception:
            return None

    def versions(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.folder)

    def update(self, manifest_id: str, data: dict, now: int | None = None) -> dict:
        """succeeded grows; failed is replaced; created gains; old errors stay for rows that still fail."""
        old = self.get(manifest_id, now) or {"id": manifest_id, "succeeded": [], "failed": [], "created": {}, "errors": {}}
        failed = sorted(set(data.get("failed", old["failed"])))
        new = old | {
            "succeeded": sorted(set(old["succeeded"]) | set(data.get("succeeded", []))),
            "failed": failed,
            "created": old["created"] | {str(k): v for k, v in data.get("created", {}).items()},
            "uid_map": old.get("uid_map", {}) | data.get("uid_map", {}),
            "errors": {k: v for k, v in old["errors"].items() if int(k) in failed} | {str(k): v for k, v in data.get("errors", {}).items()},
        }
        self.put(new, now)
        return new
