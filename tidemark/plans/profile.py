"""The profile of a table: every metric of every column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions import columns as C
from tidemark.operators.scan import Request, column_type
from tidemark.plans.metrics import compute, requested, successful

ATOMIC_METRICS = ("ApproxCountDistinct", "Completeness", "DataType")
FREQUENCY_METRICS = ("Distinctness", "Entropy", "Uniqueness", "UniqueValueRatio")
NUMERIC_METRICS = ("Maximum", "Minimum", "Mean", "Sum")


def profile_requests(schema: T.StructType, exact: bool = True) -> list[Request]:
    """Size, and per column what its type allows.

    Value frequencies need a shuffle of the distinct values; if not `exact`, an estimate of
    the distinctness from the one scan stands in for them.

    Text columns ask for the numeric metrics too: whether a text column holds numbers is
    known only after the scan, which then leaves them null if it does not.
    """
    requests = [Request("Size", "*")]
    metrics = ATOMIC_METRICS + (FREQUENCY_METRICS if exact else ("ApproxDistinctness",))
    for field in schema.fields:
        if C.is_nested(field.dataType):
            requests.append(Request("Completeness", field.name))
            continue
        requests += [Request(metric, field.name) for metric in metrics]
        if C.is_numeric(field.dataType) or C.is_text(field.dataType):
            requests.append(Request("ApproxQuantile", field.name, "0.5"))
            requests.append(Request("ApproxQuantiles", field.name))
            requests += [Request(metric, field.name) for metric in NUMERIC_METRICS]
    return requests


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """(entity, instance, name, value): the metrics of a table that have a value."""
    requests = profile_requests(df.schema, exact)
    table, _ = compute(df, requests)
    return profile_rows(table, requests)


def profile_rows(table: DataFrame, requests: list[Request]) -> DataFrame:
    """The profile out of a metrics table that may hold more than the profile."""
    return successful(table.where(requested(requests)))


def column_profiles(df: DataFrame) -> DataFrame:
    """(column, completeness, approx_distinct, data_type) per column, from one scan.

    Of a nested column (array, map, struct, variant) only the completeness is known.
    """
    requests = [
        Request(metric, field.name)
        for field in df.schema.fields
        for metric in ("Completeness", *(() if C.is_nested(field.dataType) else ("ApproxCountDistinct", "DataType")))
    ]
    table, _ = compute(df, requests)

    def value(name: str) -> str:
        return f"max(value) FILTER (WHERE name = '{name}')"

    counts = [value(f"Histogram.abs.{t}") for t in ("Integral", "Fractional", "Boolean", "String")]
    return table.groupBy(F.col("instance").alias("column")).agg(
        F.expr(value("Completeness")).alias("completeness"),
        F.expr(value("ApproxCountDistinct")).alias("approx_distinct"),
        F.expr(f"if(count_if(metric = 'DataType') > 0, {column_type(*counts)}, NULL)").alias("data_type"),
    )
