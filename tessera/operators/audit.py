"""Run and audit tables as append-only event frames.

A run is an append of a 'RUNNING' event and later a terminal event; the
current state of a run is its latest event (one row per run), so nothing is
ever updated in place. Step and DQ logs are plain appends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.dedupe import pick_one

RUN_COLS = ["run_id", "as_of", "status", "event_time", "counts_json", "error"]
STEP_COLS = ["run_id", "step", "status", "rows", "message", "event_time"]


def run_event(run_id: Column, as_of: Column, status: str, event_time: Column,
              counts: Column | None = None, error: Column | None = None) -> list[Column]:
    """AUD-1 / AUD-2: columns of one run event (counts as JSON text)."""
    return [run_id.alias("run_id"), as_of.alias("as_of"), F.lit(status).alias("status"),
            event_time.alias("event_time"),
            (F.to_json(counts) if counts is not None else F.lit(None).cast("string")).alias("counts_json"),
            (error if error is not None else F.lit(None).cast("string")).alias("error")]


def runs_latest(events: DataFrame) -> DataFrame:
    """Latest event per run (start and finish merged by time)."""
    started = events.where(F.col("status") == "RUNNING").select(
        "run_id", F.col("event_time").alias("started_at"))
    last = pick_one(events, ["run_id"], [("event_time", "desc"), ("status", "desc")],
                    ["as_of", "status", "event_time", "counts_json", "error"])
    return last.join(started, "run_id", "left").withColumnRenamed("event_time", "finished_at")


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """RPT-2: the last ``n`` runs with their duration in minutes."""
    mins = (F.unix_seconds(F.col("finished_at").cast("timestamp"))
            - F.unix_seconds(F.col("started_at").cast("timestamp"))) / 60
    return (runs.select("run_id", "as_of", "status", "started_at", "finished_at",
                        F.round(mins, 2).alias("duration_minutes"))
                .orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n))


def backfill_result(dq_log: DataFrame) -> DataFrame:
    """AUD-7: old log rows carry only ``status``; ``result`` falls back to it."""
    return dq_log.withColumn("result", F.coalesce(F.col("result"), F.col("status")))
