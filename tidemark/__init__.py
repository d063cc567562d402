"""Data quality on Spark: profiles of tables and verification against rule tables."""

from tidemark.operators.frequency import histogram
from tidemark.operators.rules import (
    active_rules,
    rejected_rules,
    rules_for,
    typed_rules,
    unpivot_rules,
)
from tidemark.operators.scan import Request
from tidemark.plans.job import run
from tidemark.plans.metrics import metrics
from tidemark.plans.profile import column_profiles, profile
from tidemark.plans.verify import verify, verify_detailed
from tidemark.sources.files import landed_files, read_interface, read_rules, write_single_csv

__all__ = [
    "Request",
    "active_rules",
    "column_profiles",
    "histogram",
    "landed_files",
    "metrics",
    "profile",
    "read_interface",
    "read_rules",
    "rejected_rules",
    "rules_for",
    "run",
    "typed_rules",
    "unpivot_rules",
    "verify",
    "verify_detailed",
    "write_single_csv",
]
