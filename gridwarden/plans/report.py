"""Reading back the findings of stored runs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwarden.functions import values
from gridwarden.plans.runs import ShufflesFreed, findings_of, newest


@dataclass(frozen=True)
class Report:
    """The findings, and a message if there are none or they cannot be read."""

    findings: DataFrame | None
    message: str | None


def read_findings(spark: SparkSession, path: str, run_date: date | None = None) -> DataFrame:
    """The findings of the last complete run under `path`, or of the last one of a date."""
    return findings_of(spark, path, newest(spark, path, run_date))


def report(spark: SparkSession, path: str, run_date: date | None = None) -> Report:
    """The findings under `path` with the message that a caller should show."""
    try:
        findings = read_findings(spark, path, run_date)
        return Report(findings, values.NO_FINDINGS if findings.isEmpty() else None)
    except Exception as error:
        return Report(None, values.READ_FAILURE + str(error))


def run_dates(findings: DataFrame) -> DataFrame:
    """The distinct run dates of the findings."""
    return findings.select("run_date").distinct()


def run_date_of(findings: DataFrame) -> date:
    """The one run date of the findings; raises if there is none or more than one."""
    with ShufflesFreed(findings.sparkSession):
        dates = [row["run_date"] for row in run_dates(findings).take(2)]
    if len(dates) != 1:
        raise ValueError(f"expected one run date, found {'several' if dates else 'none'}")
    return dates[0]


def findings_by_category(findings: DataFrame) -> DataFrame:
    """Number of findings per category and rule title."""
    return findings.groupBy("category", "rule").agg(F.count(F.lit(1)).alias("findings"))
