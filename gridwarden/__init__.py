"""Validation of electric-distribution network tables as Spark jobs."""

from gridwarden.operators.census import lasting_census, non_null_census, select_layers
from gridwarden.operators.findings import enrich_feeder
from gridwarden.plans.batch import all_findings, run_failures, run_validation
from gridwarden.plans.report import read_findings, report, run_date_of
from gridwarden.plans.rules import BATCH, RULES, rule_findings
from gridwarden.plans.runs import history, superseded_runs
from gridwarden.sources.catalog import catalog_frames, footer_session, registered_layers
from gridwarden.sources.network import Network, network_of, read_network, read_network_tables

__all__ = [
    "BATCH",
    "RULES",
    "Network",
    "all_findings",
    "catalog_frames",
    "enrich_feeder",
    "footer_session",
    "history",
    "lasting_census",
    "network_of",
    "non_null_census",
    "read_findings",
    "read_network",
    "read_network_tables",
    "registered_layers",
    "report",
    "rule_findings",
    "run_date_of",
    "run_failures",
    "run_validation",
    "select_layers",
    "superseded_runs",
]
