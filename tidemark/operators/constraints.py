"""Rules meet metrics: one join, one verdict per rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Means and sums are equal up to this share of them, for numbers written with fewer digits, and up
# to what the rounding of the values to doubles may add up to (their slack).
RELATIVE_TOLERANCE = 1e-9

RESULT_SCHEMA = (
    "source string, field string, rule string, check string, check_level string,"
    " check_status string, constraint string, constraint_status string,"
    " constraint_message string"
)
RESULT_COLUMNS = [column.split()[0] for column in RESULT_SCHEMA.split(",")]


def evaluate(rules: DataFrame, metrics: DataFrame) -> DataFrame:
    """Every rule with the value of its metric and the verdict.

    A left join: a rule whose metric does not exist fails.  The metrics are one row per
    rule at most (plus a fixed number per counted column), so they are broadcast.
    """
    values = metrics.select("metric", F.col("column").alias("field"), "params", "value", "failed", "slack")
    on = ["metric", "field", "params"]
    holds = (
        "CASE comparison WHEN '=' THEN value = threshold WHEN '>=' THEN value >= threshold"
        " WHEN '<=' THEN value <= threshold"
        " WHEN '~' THEN value = threshold OR abs(value) < CAST('Infinity' AS double)"
        f"   AND abs(value - threshold) <= {RELATIVE_TOLERANCE}d"
        "   * greatest(abs(value), abs(threshold)) + slack END"
    )
    judged = rules.join(F.broadcast(values), on, "left").withColumn(
        "holds", F.expr(f"problem IS NULL AND coalesce(NOT isnan(value) AND {holds}, false)")
    )
    sign = "if(comparison = '~', '=', comparison)"
    return judged.selectExpr(
        "source", "field", "rule", "arg", "if(problem IS NULL, value, NULL) AS value",
        "concat(rule, ': ', coalesce(field, ''), ' checks') AS check",
        "'Error' AS check_level",
        "if(holds, 'Success', 'Error') AS check_status",
        "if(metric IS NULL, rule, concat(metric, '(', coalesce(field, ''),"
        f" if(params = '', '', concat(', ', params)), ') ', {sign}, ' ',"
        " coalesce(CAST(threshold AS string), '?'))) AS constraint",
        "if(holds, 'Success', 'Failure') AS constraint_status",
        "CASE WHEN holds THEN '' WHEN problem IS NOT NULL THEN problem"
        " WHEN failed > 0 THEN concat('predicate fails on the data, in ', failed, ' rows')"
        " WHEN value IS NULL THEN 'the metric has no value'"
        f" ELSE concat('value ', value, ' is not ', {sign}, ' ', threshold)"
        " END AS constraint_message",
    )
