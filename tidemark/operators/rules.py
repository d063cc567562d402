"""The rule table: from one wide row per field to one typed rule per filled cell."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import columns as C, patterns

KEYS = ("source", "field")
# A rules file is configuration; beyond this many rules for one table it is taken for data
# passed in by mistake and refused with an error, never cut.
MAX_RULES = 50_000


class Rule(NamedTuple):
    """What a rule column asks: how to read its cell, which metric it bounds, and how."""

    cell: str  # flag, number, quantile, keyed, column, list, pattern, type or predicate
    metric: str
    comparison: str  # = >= <= or ~ (equal up to rounding)
    params: str = ""


# The rule columns, in their order in the rules file.
RULES: dict[str, Rule] = {
    "isComplete": Rule("flag", "Completeness", "="),
    "hasCompleteness": Rule("number", "Completeness", ">="),
    "isUnique": Rule("flag", "Uniqueness", "="),
    "isPrimaryKey": Rule("flag", "Uniqueness", "="),
    "hasUniqueness": Rule("number", "Uniqueness", ">="),
    "hasDistinctness": Rule("number", "Distinctness", ">="),
    "hasUniqueValueRatio": Rule("number", "UniqueValueRatio", ">="),
    "hasNumberOfDistinctValues": Rule("number", "CountDistinct", ">="),
    "hasHistogramValues": Rule("keyed", "HistogramRatio", ">="),
    "hasEntropy": Rule("number", "Entropy", ">="),
    "hasApproxQuantile": Rule("quantile", "ApproxQuantile", ">="),
    "hasMinLength": Rule("number", "MinLength", "="),
    "hasMaxLength": Rule("number", "MaxLength", "="),
    "hasMin": Rule("number", "Minimum", "="),
    "hasMax": Rule("number", "Maximum", "="),
    "hasMean": Rule("number", "Mean", "~"),
    "hasSum": Rule("number", "Sum", "~"),
    "hasStandardDeviation": Rule("number", "StandardDeviation", "<="),
    "hasApproxCountDistinct": Rule("number", "ApproxCountDistinct", "<="),
    "hasCorrelation": Rule("keyed", "Correlation", ">="),
    "satisfies": Rule("predicate", "Satisfies", "="),
    "hasPattern": Rule("pattern", "PatternMatch", "="),
    "containsCreditCardNumber": Rule("flag", "PatternMatch", "=", patterns.CREDIT_CARD),
    "containsEmail": Rule("flag", "PatternMatch", "=", patterns.EMAIL),
    "containsURL": Rule("flag", "PatternMatch", "=", patterns.URL),
    "containsSocialSecurityNumber": Rule(
        "flag", "PatternMatch", "=", patterns.SOCIAL_SECURITY_NUMBER
    ),
    "hasDataType": Rule("type", "TypeRatio", "="),
    "isNonNegative": Rule("flag", "NonNegative", "="),
    "isPositive": Rule("flag", "Positive", "="),
    "isLessThan": Rule("column", "LessThan", "="),
    "isLessThanOrEqualTo": Rule("column", "LessThanOrEqualTo", "="),
    "isGreaterThan": Rule("column", "GreaterThan", "="),
    "isGreaterThanOrEqualTo": Rule("column", "GreaterThanOrEqualTo", "="),
    "isContainedIn": Rule("list", "ContainedIn", "="),
}

# The names a hasDataType cell may hold.
TYPE_NAMES = ("Null", "Fractional", "Integral", "Boolean", "String", "Numeric")


def unpivot_rules(rules: DataFrame) -> DataFrame:
    """(source, field, rule, arg): one row per filled cell, whatever the cell's column."""
    cells = [c for c in rules.columns if c not in KEYS]
    if not cells:
        return rules.sparkSession.createDataFrame(
            [], "source string, field string, rule string, arg string"
        )
    as_text = rules.selectExpr(
        *KEYS, *[f"CAST({C.name(c)} AS string) AS {C.name(c)}" for c in cells]
    )
    return as_text.unpivot(list(KEYS), cells, "rule", "arg").where("arg IS NOT NULL")


def active_rules(long: DataFrame) -> DataFrame:
    """Drops the flag rules that are not switched on with an "s"."""
    flags = C.any_of(name for name, rule in RULES.items() if rule.cell == "flag")
    return long.where(f"rule NOT IN {flags} OR lower(trim(arg)) = 's'")


def typed_rules(active: DataFrame) -> DataFrame:
    """(source, field, rule, arg, metric, params, comparison, threshold, problem).

    The metric, its parameter and the bound a rule puts on it; `problem` says why a rule
    cannot be checked.  A rule never fails the job, whatever its cell holds.
    """

    # the rule vocabulary: as many rows as RULES has entries
    vocabulary = ", ".join(
        f"({', '.join(C.text(cell) for cell in (name, *rule))})" for name, rule in RULES.items()
    )
    kinds = active.sparkSession.sql(
        f"VALUES {vocabulary} AS kinds(rule, cell, metric, comparison, fixed_params)"
    )
    # name=bound cells: everything before the last = is the name
    parts = active.join(F.broadcast(kinds), "rule", "left").selectExpr(
        "source", "trim(field) AS field", "rule", "arg",
        "cell", "metric", "comparison", "fixed_params",
        "cell = 'keyed' OR cell = 'quantile' AND contains(arg, '=') AS two_part",
    ).selectExpr(
        "*",
        "if(two_part, trim(regexp_extract(arg, '(?s)^(.*)=', 1)), NULL) AS key",
        "CASE WHEN two_part THEN try_cast(trim(substring_index(arg, '=', -1)) AS double)"
        " WHEN cell IN ('number', 'quantile') THEN try_cast(trim(arg) AS double)"
        " ELSE 1.0d END AS threshold",
        "if(cell = 'type', initcap(trim(arg)), NULL) AS type_name",
    )
    return parts.selectExpr(
        "source", "field", "rule", "arg", "metric",
        "CASE cell WHEN 'quantile' THEN CAST(coalesce(try_cast(key AS double), 0.5d) AS string)"
        " WHEN 'keyed' THEN key"
        " WHEN 'column' THEN trim(arg)"
        r" WHEN 'list' THEN array_join(transform(split(arg, ','), x -> trim(x)), ',')"
        " WHEN 'type' THEN type_name"
        " WHEN 'pattern' THEN arg WHEN 'predicate' THEN arg"
        " ELSE coalesce(fixed_params, '') END AS params",
        "comparison",
        "threshold",
        "CASE WHEN cell IS NULL THEN 'unknown rule'"
        " WHEN field IS NULL OR field = '' THEN 'rule without a field'"
        " WHEN threshold IS NULL OR isnan(threshold) THEN concat('no number in ', arg)"
        " WHEN cell = 'quantile' AND key IS NOT NULL"
        "   AND NOT coalesce(try_cast(key AS double) >= 0 AND try_cast(key AS double) <= 1, false)"
        "   THEN concat('no quantile in ', arg)"
        " WHEN cell = 'keyed' AND key = '' THEN concat('nothing named in ', arg)"
        f" WHEN cell = 'type' AND type_name NOT IN {C.any_of(TYPE_NAMES)}"
        "   THEN concat('unknown type ', arg) END AS problem",
    )


def rules_for(rules: DataFrame, source: str) -> DataFrame:
    """The rules of one table; blanks around its name in a rule do not count."""
    return rules.where(F.trim("source") == source).withColumn("source", F.lit(source))


def rejected_rules(rules: DataFrame) -> DataFrame:
    """Rule rows that belong to no table or no field."""
    return rules.where("source IS NULL OR trim(source) = '' OR field IS NULL OR trim(field) = ''")


def collect_rules(typed: DataFrame) -> list:
    """The rules as rows on the driver, which plans the metrics from them."""
    rows = typed.limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules; a rules table holds configuration only")
    return rows
