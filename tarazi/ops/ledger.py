"""Runs, steps, checks and alerts as append-only tables; the state is the latest event."""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarazi.operators.upserts import latest_of_each

EVENTS = "run_id string, at timestamp, kind string, name string, status string, attempts int, detail string"


class JsonFormatter(logging.Formatter):
    """One JSON object a log line, with the run it belongs to."""

    def __init__(self, run_id: str):
        super().__init__()
        self.run_id = run_id

    def format(self, record: logging.LogRecord) -> str:
        return json.dumps({"at": record.created, "level": record.levelname, "run_id": self.run_id, "event": record.getMessage()}, ensure_ascii=False)


class Ledger:
    """Events of runs below ``path``; each append writes its own files."""

    def __init__(self, spark: SparkSession, path: str, run_id: str | None = None):
        self.spark, self.path, self.run_id = spark, path, run_id or uuid.uuid4().hex

    def record(self, kind: str, name: str, status: str, attempts: int = 1, **detail) -> None:
        row = (self.run_id, datetime.now(timezone.utc), kind, name, status, attempts, json.dumps(detail, default=str, ensure_ascii=False))
        self.spark.createDataFrame([row], EVENTS).coalesce(1).write.mode("append").parquet(self.path)

    def step(self, name: str, run: Callable[[], dict | None], attempts: int = 1, wait: float = 0.0) -> dict:
        """Run a step, again after a failure up to ``attempts`` times; its end is recorded either way."""
        for attempt in range(1, attempts + 1):
            try:
                stats = run() or {}
            except Exception as e:
                if attempt == attempts:
                    self.record("step", name, "failed", attempt, error=f"{type(e).__name__}: {e}")
                    raise
                time.sleep(wait)
            else:
                self.record("step", name, "succeeded", attempt, **stats)
                return stats
        return {}

    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENTS).parquet(self.path)

    def latest(self) -> DataFrame:
        return latest_of_each(self.events(), ["run_id", "kind", "name"], ["at"])

    def status(self) -> str:
        """failed if a step failed last, degraded with an alert or a failed check, else succeeded."""
        own = self.latest().where(F.col("run_id") == self.run_id)
        bad = own.groupBy("kind").agg(F.count(F.when(F.col("status") == "failed", 1)).alias("failed"), F.count(F.lit(1)).alias("n")).collect()  # a row a kind of event
        by = {r["kind"]: r for r in bad}
        if "step" in by and by["step"]["failed"]:
            return "failed"
        return "degraded" if "alert" in by or "check" in by and by["check"]["failed"] else "succeeded"
