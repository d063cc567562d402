"""Verification of one table against its rules."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.constraints import RESULT_COLUMNS, RESULT_SCHEMA, evaluate
from tidemark.operators.rules import (
    active_rules,
    collect_rules,
    rules_for,
    typed_rules,
    unpivot_rules,
)
from tidemark.operators.scan import Request
from tidemark.plans.metrics import compute

_RULE_FIELDS = [
    (name, pa.float64() if name == "threshold" else pa.string())
    for name in (
        "source", "field", "rule", "arg", "metric", "params", "comparison", "threshold", "problem"
    )
]


def verify(df: DataFrame, rules: DataFrame, source: str | None = None) -> DataFrame:
    """One pass/fail row per rule of the wide rule table; lazily, but for reading the rules.

    `source` picks the rules of one table; without it every rule is checked against `df`.
    """
    return verify_detailed(df, rules, source).select(*RESULT_COLUMNS)


def verify_detailed(df: DataFrame, rules: DataFrame, source: str | None = None) -> DataFrame:
    """As `verify`, with the rule's cell and the value of its metric."""
    rows = read_rules_of(rules, source)
    if not rows:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA + ", arg string, value double")
    metrics, problems = compute(df, requests_of(rows))
    return evaluate(local_rules(df.sparkSession, rows, problems), metrics)


def read_rules_of(rules: DataFrame, source: str | None = None) -> list:
    """The typed, active rules of one table as rows."""
    if source is not None:
        rules = rules_for(rules, source)
    return collect_rules(typed_rules(active_rules(unpivot_rules(rules))))


def requests_of(rows: list) -> list[Request]:
    """The metrics the rules need, each once however many rules need it."""
    return list(dict.fromkeys(_request(row) for row in rows if row["problem"] is None))


def local_rules(spark: SparkSession, rows: list, problems: dict[Request, str]) -> DataFrame:
    """The rules as a local relation, with the reason where a metric cannot be computed."""
    columns = {name: [row[name] for row in rows] for name, _ in _RULE_FIELDS}
    columns["problem"] = [row["problem"] or problems.get(_request(row)) for row in rows]
    return spark.createDataFrame(pa.table(columns, schema=pa.schema(_RULE_FIELDS)))


def _request(row) -> Request:
    return Request(row["metric"], row["field"], row["params"])
