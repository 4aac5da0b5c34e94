"""The stored run log: an append-only Parquet table of training runs, idempotent by run id.

Each run is a partition of its own, written in one commit after the run's model is saved, so a reader sees a run whole or
not at all, and a run that is written again (a job that was started twice) replaces itself.  The gate of a new run, the current
model and the history are all resolved from the stored rows; no state is kept in the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlens.ml import lifecycle as LC
from revlens.sources.schemas import MODEL_RUNS


class RunLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        spark.createDataFrame([], MODEL_RUNS).write.mode("append").partitionBy("run_id").parquet(f"{self.path}/runs")

    def read(self) -> DataFrame:
        """All stored runs."""
        return self.spark.read.schema(MODEL_RUNS).parquet(f"{self.path}/runs").select(*MODEL_RUNS.names)

    def others(self, run_id: str) -> DataFrame:
        """The runs that the run ``run_id`` is gated against: all but itself."""
        runs = self.read()
        return runs.where(runs["run_id"] != run_id)

    def append(self, run: DataFrame) -> None:
        """Store one run (``MODEL_RUNS``); a stored run of that id is replaced."""
        (run.select(*MODEL_RUNS.names).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id").parquet(f"{self.path}/runs"))

    def current(self) -> DataFrame:
        """The run whose model is in use: the latest promoted one, else the latest."""
        return LC.latest_model(self.read())

    def model_path(self, run_id: str) -> str:
        return f"{self.path}/models/{run_id}"


def record_scores(log: RunLog, run_id: str, run_name: str, start_time, scores: dict, params: dict) -> bool:
    """Gate a scored run against the stored ones and store it; whether it was promoted.  ``scores`` has ``f1_weighted``."""
    d = LC.promotion_decision(log.others(run_id), float(scores["f1_weighted"])).collect()[0]
    row = (run_id, run_name, start_time, {k: str(v) for k, v in params.items()},
           {**{k: float(v) for k, v in scores.items()}, "previous_f1": float(d.previous_f1 or 0.0)},
           {"promoted": str(bool(d.promoted)), "decision": "PROMOTED" if d.promoted else "REJECTED", "status": "TRAINED"}, f"models/{run_id}")
    log.append(log.spark.createDataFrame([row], MODEL_RUNS))
    return bool(d.promoted)


def nightly(log: RunLog, rows: DataFrame, featurizer, run_id: str, run_name: str, max_iter: int = 60, reg: float = 0.05) -> DataFrame:
    """One nightly retraining against the stored log; the ``type = retraining`` record.

    Below the sample gate nothing is stored."""
    before = log.others(run_id)
    runs, record = LC.retrain_run(rows, featurizer, before, f"{log.path}/models", run_name, max_iter, reg, run_id=run_id)
    log.append(runs.where(runs["run_id"] == run_id))
    return record
