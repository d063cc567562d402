"""Pieces shared by the registered queries and their reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Large sums differ in their last digits with the order of addition.  Means of amounts in
# cents over the row counts at hand have no ties at these places.
ROUNDED = (
    "CASE WHEN abs(value) >= 1e6 THEN round(value, 2)"
    " WHEN abs(value) >= 1e3 THEN round(value, 7) ELSE round(value, 8) END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str, replace: dict[str, str]) -> DataFrame:
    """A table with some columns replaced, as `SELECT * REPLACE` does in the reference SQL."""
    df = table(spark, sf_dir, name)
    return df.selectExpr(*[f"{replace[c]} AS {c}" if c in replace else c for c in df.columns])


def derived_sql(name: str, replace: dict[str, str]) -> str:
    if not replace:
        return f"SELECT * FROM {name}"
    return f"SELECT * REPLACE ({', '.join(f'{sql} AS {c}' for c, sql in replace.items())}) FROM {name}"


def rounded(metrics: DataFrame) -> DataFrame:
    """Metrics without the approximate ones, rounded for comparison."""
    return metrics.where(~F.col("name").startswith("Approx")).select(
        "instance", "name", F.expr(ROUNDED).alias("value")
    )


# Exact metric of column {c} over a relation t, in plain SQL.
_FREQUENCIES = "(SELECT count(*) AS n FROM t WHERE {c} IS NOT NULL GROUP BY {c})"
METRIC_SQL = {
    "Completeness": "SELECT count({c})::double / count(*) FROM t",
    "Distinctness": "SELECT count(DISTINCT {c})::double / count(*) FROM t",
    "CountDistinct": "SELECT count(DISTINCT {c})::double FROM t",
    "Uniqueness": "SELECT count(*) FILTER (WHERE n = 1)::double / (SELECT count(*) FROM t)"
    " FROM " + _FREQUENCIES,
    "UniqueValueRatio": "SELECT count(*) FILTER (WHERE n = 1)::double / count(*) FROM "
    + _FREQUENCIES,
    "Entropy": "SELECT -sum(n / total * ln(n / total)) FROM "
    "(SELECT n::double AS n, (SELECT count(*) FROM t)::double AS total FROM "
    + _FREQUENCIES + ")",
    "Minimum": "SELECT min({c}::double) + 0.0 FROM t",
    "Maximum": "SELECT max({c}::double) + 0.0 FROM t",
    "Mean": "SELECT avg({c}::double) FROM t",
    "Sum": "SELECT sum({c}::double) FROM t",
    "StandardDeviation": "SELECT stddev_pop({c}::double) FROM t",
    "MinLength": "SELECT min(length({c}))::double FROM t",
    "MaxLength": "SELECT max(length({c}))::double FROM t",
}


def metric_sql(metric: str, column: str) -> str:
    return METRIC_SQL[metric].replace("{c}", column)


def rows_sql(name: str, replace: dict[str, str], rows: list[tuple[str, str, str]]) -> str:
    """(instance, name, value) rows, each value a scalar query over t."""
    union = " UNION ALL ".join(
        f"SELECT '{instance}' AS instance, '{metric}' AS name, ({sql}) AS value"
        for instance, metric, sql in rows
    )
    return (
        f"WITH t AS ({derived_sql(name, replace)}), m AS ({union})"
        f" SELECT instance, name, {ROUNDED} AS value FROM m WHERE value IS NOT NULL"
    )
