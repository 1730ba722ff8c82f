"""The batch run: all scheduled rules into one set of findings, with failures kept apart by rule."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwarden.functions import values
from gridwarden.operators.findings import COLUMNS, findings_schema
from gridwarden.plans import runs
from gridwarden.plans.rules import BATCH, Rule, findings_with_rule, shared_sources
from gridwarden.sources.network import Network

log = logging.getLogger(__name__)

#: So many groups of rules are written at the same time; Spark deals its cores to their jobs.
JOBS_AT_ONCE = 4


def all_findings(network: Network, run_date: date, rules: Sequence[Rule] = BATCH) -> DataFrame:
    """Findings of all rules as one lazy plan that reads each view once for all of its checks."""
    return findings_with_rule(network, rules, run_date).select(COLUMNS)


def message_row(
    spark: SparkSession,
    rule_id: str,
    category: str,
    rule: str,
    detail_1: str,
    detail_2: str | None,
    run_date: date,
    audit_date: str = "date",
) -> DataFrame:
    """One row about the run itself: object 0, a blank element, no feeder and no audit values."""
    texts = {"category": category, "rule": rule, "element": " ", "detail_1": detail_1, "detail_2": detail_2}
    known = {**texts, "object_id": 0, "run_date": run_date}
    return spark.range(1).select(
        F.lit(rule_id).alias("rule_id"),
        *[F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) for f in findings_schema(audit_date)],
    )


def failure_row(spark: SparkSession, rule: Rule, error: Exception, run_date: date, audit_date: str) -> DataFrame:
    text, procedure = values.FAILURE_TEXT + error_text(error), values.FAILED_PROCEDURE + rule.name
    return message_row(spark, rule.rule_id, "ERROR", text, procedure, rule.title[1], run_date, audit_date)


def error_text(error: Exception) -> str:
    """The first line of what went wrong at the root; stack traces are left to the log."""
    return str(error).strip().split("\n")[0]


def rule_groups(network: Network, rules: Sequence[Rule]) -> list[list[Rule]]:
    """The rules in groups that share what they read; rules of different groups share nothing.

    A rule whose needs can't be told, such as for a missing table, is a group of its own.
    """
    groups: list[tuple[set[str], list[Rule]]] = []
    for rule in rules:
        try:
            needs = shared_sources(network, rule)
        except Exception:
            needs = set()
        touching = [group for group in groups if group[0] & needs]
        members = [r for group in touching for r in group[1]] + [rule]
        groups = [group for group in groups if group not in touching]
        groups.append((needs.union(*[group[0] for group in touching]), members))
    return [members for _, members in groups]


class Run:
    """One run while it is written: its parts so far, and what failed."""

    def __init__(self, spark: SparkSession, network: Network, path: str, run_date: date):
        self.spark, self.network, self.path, self.run_date = spark, network.traced(), path, run_date
        self.name = runs.new_run(run_date)
        self.parts: list[str] = []
        self.alone: list[str] = []

    def write(self, rows: DataFrame, part: str) -> None:
        self.parts.append(runs.write_part(rows, self.path, self.name, part))

    def message(self, part: str, text: str, at: datetime) -> None:
        clock = at.strftime(values.RUN_CLOCK)
        self.write(message_row(self.spark, "RUN", "INFO", text, clock, None, self.run_date, self.network.audit_date), part)

    def group(self, number: int, rules: Sequence[Rule]) -> None:
        """Writes a group's findings by one job. If it fails, its rules, and no others, are written one by one."""
        try:
            self.write(findings_with_rule(self.network, rules, self.run_date), f"group-{number}")
            return
        except Exception as error:
            if len(rules) == 1:
                self.failed(rules[0], error)
                return
            log.exception("a job failed; running its %d rules one by one", len(rules))
        for rule in rules:
            self.alone.append(rule.rule_id)
            try:
                self.write(findings_with_rule(self.network, [rule], self.run_date), f"rule-{rule.rule_id}")
            except Exception as error:
                self.failed(rule, error)

    def failed(self, rule: Rule, error: Exception) -> None:
        log.error("rule %s failed: %s", rule.rule_id, error_text(error))
        row = failure_row(self.spark, rule, error, self.run_date, self.network.audit_date)
        self.write(row, f"failure-{rule.rule_id}")

    def report_unreadable(self) -> None:
        """One ERROR row per column with values that could not be read, and so were judged as missing."""
        for number, (table, column, rows) in enumerate(self.network.unreadable()):
            texts = values.UNREADABLE_VALUES + str(rows), values.UNREADABLE_TABLE + table, values.UNREADABLE_COLUMN + column
            row = message_row(self.spark, "READ", "ERROR", *texts, self.run_date, self.network.audit_date)
            self.write(row, f"unreadable-{number}")

    def commit(self) -> None:
        runs.commit(self.spark, self.path, self.name, self.run_date, sorted(self.parts), sorted(self.alone), self.network.audit_date)


def run_validation(
    spark: SparkSession,
    network: Network,
    path: str,
    run_date: date,
    rules: Sequence[Rule] = BATCH,
    clock: Callable[[], datetime] = datetime.now,
    log_path: str | None = None,
) -> DataFrame:
    """Runs the rules, makes the findings under `path` those of this run, and returns them.

    Rules that share views are one job and one part of the run. Where a job fails, its rules are written one by one: a
    rule that fails leaves one ERROR row, the others their findings. Until the run is complete, `path` gives the run
    before it. Findings of other run dates are kept (`history`). Values that cannot be read, such as a code `2.5`, are
    counted while the rules scan the tables; each column that has some leaves an ERROR row.

    A failure of the run as a whole, such as of its storage, leaves an ERROR row under `log_path`, a second place that
    should not share the first one's fate (`<path>-failures` if not given), and is raised.
    """
    try:
        run = Run(spark, network, path, run_date)
        run.message("start", values.RUN_STARTED, clock())
        groups = rule_groups(run.network, rules)
        with ThreadPoolExecutor(JOBS_AT_ONCE) as jobs:
            list(jobs.map(run.group, range(len(groups)), groups))
        run.report_unreadable()
        run.message("finish", values.RUN_FINISHED, clock())
        run.commit()
    except Exception as error:
        record_failure(spark, log_path or f"{path}-failures", run_date, error, network.audit_date)
        raise
    return runs.findings_of(spark, path, runs.newest(spark, path, run_date))


def record_failure(spark: SparkSession, log_path: str, run_date: date, error: Exception, audit_date: str = "date") -> None:
    """Appends one ERROR row about a whole run to the log of failures; never hides the failure itself."""
    text = values.FAILURE_TEXT + error_text(error)
    try:
        row = message_row(spark, "RUN", "ERROR", text, values.FAILED_PROCEDURE + "run_validation", None, run_date, audit_date)
        row.select(COLUMNS).write.mode("append").parquet(log_path)
    except Exception:
        log.exception("the failure of the run could not be recorded under %s", log_path)


def run_failures(spark: SparkSession, log_path: str, audit_date: str = "date") -> DataFrame:
    """The ERROR rows of runs that failed as a whole."""
    return spark.read.schema(findings_schema(audit_date)).parquet(log_path)
