"""Stored runs: each in a folder of its own, and a manifest that says which run of a date counts.

A run becomes visible by one row appended to the manifest, a file of its own, as its last act. A run that is killed at
any point before leaves a folder that nobody reads, and readers go on with the complete run before it. Runs of other
dates stay; a date's later run replaces its earlier one as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from threading import Lock
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridwarden.operators.findings import COLUMNS, findings_schema

MANIFEST = "run_date date, sequence bigint, run string, parts array<string>, alone array<string>, audit_date string"


def new_run(run_date: date) -> str:
    return f"{run_date:%Y%m%d}-{uuid4().hex}"


class ShufflesFreed:
    """While a part is written or a question is asked, Spark drops a job's shuffle files as soon as the job has ended.

    Otherwise they stay until the driver collects garbage, those of all parts together. Several threads may be within at
    a time: the last one puts the session's setting back.
    """

    KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    lock, writers, before = Lock(), 0, None

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def __enter__(self) -> None:
        kind = type(self)
        with kind.lock:
            if not kind.writers:
                kind.before = self.conf.get(self.KEY)
            kind.writers += 1
            self.conf.set(self.KEY, "true")

    def __exit__(self, *error: object) -> None:
        kind = type(self)
        with kind.lock:
            kind.writers -= 1
            if not kind.writers:
                self.conf.set(self.KEY, kind.before)


def write_part(rows: DataFrame, path: str, run: str, part: str) -> str:
    """Writes one part of a run, rows with `rule_id`, and returns its name."""
    # Findings go from the task that makes them to its files: gathered by rule they would all be shuffled once more.
    with ShufflesFreed(rows.sparkSession):
        rows.write.option("compression", "zstd").partitionBy("rule_id").parquet(f"{path}/runs/{run}/part={part}")
    return part


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per complete run; raises if there never was one."""
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def next_sequence(spark: SparkSession, path: str) -> int:
    try:
        return (manifest(spark, path).agg(F.max("sequence")).first()[0] or 0) + 1
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 1
        raise


def commit(
    spark: SparkSession, path: str, run: str, run_date: date, parts: Sequence[str], alone: Sequence[str] = (), audit_date: str = "date"
) -> None:
    """Makes the run with these parts the one that counts; `alone` names the rules that had to run by themselves."""
    sequence = next_sequence(spark, path)
    row = spark.createDataFrame([(run_date, sequence, run, list(parts), list(alone), audit_date)], MANIFEST)
    row.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def newest(spark: SparkSession, path: str, run_date: date | None = None) -> Row:
    """The manifest's row of the last run, of one date if given."""
    runs = manifest(spark, path)
    runs = runs if run_date is None else runs.where(F.col("run_date") == F.lit(run_date))
    found = runs.orderBy(F.desc("sequence"), F.desc("run")).first()
    if found is None:
        raise ValueError(f"no run of {run_date} is stored")
    return found


def kept_runs(spark: SparkSession, path: str) -> DataFrame:
    """The manifest's row of the last run of each date."""
    last = F.max(F.struct("sequence", "run", "parts", "alone", "audit_date")).alias("last")
    return manifest(spark, path).groupBy("run_date").agg(last).select("run_date", "last.*")


def superseded_runs(spark: SparkSession, path: str) -> DataFrame:
    """Complete runs that a later run of their date has replaced: their folders can go."""
    return manifest(spark, path).join(kept_runs(spark, path).select("run"), "run", "left_anti").select("run_date", "run")


def findings_of(spark: SparkSession, path: str, run: Row) -> DataFrame:
    """The findings of one stored run. Its schema is known, so no job infers it."""
    folder = f"{path}/runs/{run['run']}"
    stored = T.StructType([*findings_schema(run["audit_date"]), T.StructField("part", T.StringType()), T.StructField("rule_id", T.StringType())])
    parts = [f"{folder}/part={part}" for part in run["parts"]]
    return spark.read.schema(stored).option("basePath", folder).parquet(*parts).select(COLUMNS)


def history(spark: SparkSession, path: str) -> DataFrame:
    """The findings of the last run of every date. Only the manifest's rows, one per date, come to the driver."""
    runs = kept_runs(spark, path).orderBy("run_date").collect()
    return reduce(DataFrame.unionByName, [findings_of(spark, path, run) for run in runs])
