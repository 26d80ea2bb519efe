"""Jobs as an append-only log of events, and their latest state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.schemas import COUNTERS, JOB_EVENT, STATUSES


def latest(events: DataFrame, key: str = "job_id", order: str = "seq") -> DataFrame:
    """One row for each job: of every column the last value that isn't null. Earlier stages stay in the log."""
    rest = [c for c in events.columns if c not in (key, order)]
    return events.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in rest], F.max(order).alias(order))


def job(events: DataFrame, job_id: str) -> DataFrame:
    """Latest state of one job; no rows if there is none. The filter reaches the scan."""
    return latest(events.where(F.col("job_id") == job_id))


class JobLog:
    """Events in a Parquet folder; a job's state is what its events add up to."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def append(self, job_id: str, seq: int, at=None, **fields) -> None:
        """Add one event; fields that aren't named keep their value."""
        if "status" in fields and fields["status"] not in STATUSES:
            raise ValueError(f"unknown status {fields['status']!r}")
        unknown = set(fields) - set(JOB_EVENT.names)
        if unknown:
            raise ValueError(f"unknown fields {sorted(unknown)}")
        row = {"job_id": job_id, "seq": seq, "at": at} | fields
        self.spark.createDataFrame([tuple(row.get(c) for c in JOB_EVENT.names)], JOB_EVENT).coalesce(1).write.mode("append").parquet(self.folder)

    def create(self, job_id: str, url: str, at=None) -> None:
        self.append(job_id, 0, at, url=url, status="pending", **dict.fromkeys(COUNTERS, 0))

    def finish(self, job_id: str, seq: int, status: str, at=None, error: str | None = None, **counters: int) -> None:
        self.append(job_id, seq, at, status=status, error=error, finished_at=at, **counters)

    def events(self) -> DataFrame:
        try:
            return self.spark.read.schema(JOB_EVENT).parquet(self.folder)
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], JOB_EVENT)
            raise

    def get(self, job_id: str) -> DataFrame:
        return job(self.events(), job_id)
