"""Append-only run log."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from typing import Any
from uuid import uuid4

from pyspark.sql import types as T

TABLE = "pipeline_runs"
#: Fixed names and types of the log's columns.
RUN_SCHEMA = T.StructType(
    [
        T.StructField("task_name", T.StringType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("finished_at", T.TimestampType(), False),
        T.StructField("duration_seconds", T.DoubleType(), False),
        T.StructField("output_summary", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)


class RunRecorder:
    """Times one run and appends a row when it closes; used as ``with track_run(...) as run``.

    ``output`` goes into the summary of a run that ends well, ``status`` names how it ended. An
    exception is recorded as failed, with its whole text and without a summary, and goes on.
    """

    def __init__(self, store, task_name: str, run_id: str | None = None, status: str = "succeeded") -> None:
        self.store, self.task_name = store, task_name
        self.run_id = run_id or uuid4().hex[:12]
        self.status, self.output, self.error = status, {}, ""
        self.started_at = self.finished_at = datetime.now(timezone.utc)

    def __enter__(self) -> RunRecorder:
        self.started_at = datetime.now(timezone.utc)
        return self

    def __exit__(self, kind, problem, trace) -> None:
        self.finished_at = datetime.now(timezone.utc)
        if isinstance(problem, Exception):
            self.status, self.output, self.error = "failed", {}, str(problem)
        if problem is None or isinstance(problem, Exception):
            self.append()

    def cells(self) -> dict[str, Any]:
        return {
            "task_name": self.task_name,
            "run_id": self.run_id,
            "status": self.status,
            "started_at": self.started_at,
            "finished_at": self.finished_at,
            "duration_seconds": round((self.finished_at - self.started_at) / timedelta(seconds=1), 2),
            "output_summary": json.dumps(self.output, sort_keys=True, default=str),
            "error_message": self.error,
        }

    def append(self) -> None:
        cells = self.cells()
        row = tuple(cells[c] for c in RUN_SCHEMA.names)
        self.store.append(TABLE, self.store.spark.createDataFrame([row], RUN_SCHEMA))


def track_run(store, task_name: str, run_id: str | None = None) -> RunRecorder:
    return RunRecorder(store, task_name, run_id)
