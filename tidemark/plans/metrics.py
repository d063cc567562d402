"""Any set of metrics of one table as one long DataFrame."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import columns as C
from tidemark.operators import frequency, scan
from tidemark.operators.scan import Request

SCHEMA = (
    "metric string, column string, params string,"
    " entity string, instance string, name string, value double, failed long, slack double"
)


def compute(df: DataFrame, requests: Iterable[Request]) -> tuple[DataFrame, dict[Request, str]]:
    """The requested metrics, lazily, and the reason for each request that has none.

    The table is scanned once for all row-wise metrics and once more if any metric needs
    value frequencies.
    """
    requests = list(dict.fromkeys(requests))
    by_row = [r for r in requests if r.metric in scan.METRICS]
    by_value = [r for r in requests if r.metric in frequency.METRICS]
    problems = {
        r: f"unknown metric {r.metric}"
        for r in requests
        if r.metric not in scan.METRICS and r.metric not in frequency.METRICS
    }
    row_frames, row_problems = scan.scan_metrics(df, by_row)
    value_frames, value_problems = frequency.frequency_metrics(df, by_value)
    problems |= row_problems | value_problems
    frames = row_frames + value_frames
    if not frames:
        return df.sparkSession.createDataFrame([], SCHEMA), problems
    return reduce(DataFrame.unionByName, frames), problems


def metrics(df: DataFrame, requests: Iterable[Request]) -> DataFrame:
    """(entity, instance, name, value) of the requested metrics that have a value."""
    requests = list(dict.fromkeys(requests))
    table, problems = compute(df, requests)
    if problems:
        raise ValueError("; ".join(f"{r.metric}({r.column}): {why}" for r, why in problems.items()))
    return successful(table.where(requested(requests)))


def requested(requests: Iterable[Request]) -> Column:
    """True on the metric rows that answer one of the requests."""
    keys = ", ".join(f"({', '.join(C.text(part) for part in r)})" for r in requests)
    return F.expr(f"(metric, `column`, params) IN ({keys})")


def successful(table: DataFrame) -> DataFrame:
    return table.where("value IS NOT NULL").select("entity", "instance", "name", "value")
