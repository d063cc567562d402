"""One query per rule: the rules, the value each one bounds, and the verdict."""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import tidemark as tm
from tidemark.functions import patterns
from workload.common import ROUNDED, derived, derived_sql, metric_sql


class Case(NamedTuple):
    """A rule, and in plain SQL over t the value it bounds and when that is good."""

    field: str
    rule: str
    arg: str
    value: str
    good: str
    # the value of a sketch is not compared, its verdict is
    exact: bool = True


def _exact(metric: str, field: str, rule: str, arg: str, good: str) -> Case:
    return Case(field, rule, arg, metric_sql(metric, field), good)


def _share(field: str, rule: str, arg: str, holds: str, good: str = "= 1") -> Case:
    return Case(
        field, rule, arg, f"SELECT count(*) FILTER (WHERE {holds})::double / count(*) FROM t", good
    )


def _matches(field: str, rule: str, arg: str, pattern: str) -> Case:
    return _share(field, rule, arg, f"regexp_matches({field}, '{pattern}')")


_NULLED_PRIORITY = {"o_orderpriority": "nullif(o_orderpriority, '5-LOW')"}
_NULLED_NAME = {"p_name": "nullif(p_name, 'small ring')"}
_NULLED_BALANCE = {"c_acctbal": "CASE WHEN c_acctbal >= 0 THEN c_acctbal END"}
_SSN = {"c_name": "concat('ssn 123-45-678', CAST(c_custkey % 10 AS varchar(20)))"}
_CARD = {"c_name": "concat('card 4111 1111 1111 111', CAST(c_custkey % 10 AS varchar(20)))"}
_EMAIL = {"c_name": "concat('to: user', CAST(c_custkey AS varchar(20)), '@example.com')"}
# 0.1, 0.2 and -0.3 as often as each other: there are three times as many customers as any.
_THIRDS = {"c_acctbal": "CAST(CASE c_custkey % 3 WHEN 0 THEN 0.1 WHEN 1 THEN 0.2 ELSE -0.3 END AS double)"}
_NUMERIC_TEXT = {
    "o_custkey": "CAST(o_custkey AS varchar(20))",
    "o_totalprice": "CAST(CAST(o_totalprice AS decimal(12,2)) AS varchar(20))",
    "o_orderpriority": "nullif(o_orderpriority, '5-LOW')",
}

# No value if there is a line of the first order, on which the predicate fails.
_FAILS_ON_FIRST = "SELECT CASE WHEN count(*) FILTER (WHERE l_orderkey = 1) = 0 THEN 1.0 END FROM t"

# query -> (table, replaced columns, cases)
CASES: dict[str, tuple[str, dict[str, str], list[Case]]] = {
    "verify_is_complete": ("orders", _NULLED_PRIORITY, [
        _exact("Completeness", "o_orderkey", "isComplete", "s", "= 1"),
        _exact("Completeness", "o_orderpriority", "isComplete", " S ", "= 1"),
    ]),
    "verify_has_completeness": ("orders", _NULLED_PRIORITY, [
        _exact("Completeness", "o_orderpriority", "hasCompleteness", "0.75", ">= 0.75"),
        _exact("Completeness", "o_orderpriority", "hasCompleteness", "0.85", ">= 0.85"),
    ]),
    "verify_is_unique": ("orders", _NULLED_PRIORITY, [
        _exact("Uniqueness", "o_orderkey", "isUnique", "s", "= 1"),
        _exact("Uniqueness", "o_orderpriority", "isUnique", "s", "= 1"),
    ]),
    "verify_is_unique_lineitem": ("lineitem", {}, [
        _exact("Uniqueness", "l_orderkey", "isUnique", "s", "= 1"),
    ]),
    "verify_is_primary_key": ("customer", {}, [
        _exact("Uniqueness", "c_custkey", "isPrimaryKey", "s", "= 1"),
        _exact("Uniqueness", "c_nationkey", "isPrimaryKey", "s", "= 1"),
    ]),
    "verify_has_uniqueness": ("lineitem", {}, [
        _exact("Uniqueness", "l_orderkey", "hasUniqueness", "0.01", ">= 0.01"),
        _exact("Uniqueness", "l_orderkey", "hasUniqueness", "0.02", ">= 0.02"),
    ]),
    "verify_has_distinctness": ("lineitem", {}, [
        _exact("Distinctness", "l_orderkey", "hasDistinctness", "0.24", ">= 0.24"),
        _exact("Distinctness", "l_orderkey", "hasDistinctness", "0.25", ">= 0.25"),
    ]),
    "verify_has_unique_value_ratio": ("lineitem", {}, [
        _exact("UniqueValueRatio", "l_orderkey", "hasUniqueValueRatio", "0.07", ">= 0.07"),
        _exact("UniqueValueRatio", "l_orderkey", "hasUniqueValueRatio", "0.08", ">= 0.08"),
    ]),
    "verify_has_number_of_distinct_values": ("part", {}, [
        _exact("CountDistinct", "p_brand", "hasNumberOfDistinctValues", "25", ">= 25"),
        _exact("CountDistinct", "p_brand", "hasNumberOfDistinctValues", "26", ">= 26"),
    ]),
    "verify_has_histogram_values": ("orders", {}, [
        _share("o_orderstatus", "hasHistogramValues", "P=0.33", "o_orderstatus = 'P'", ">= 0.33"),
        _share("o_orderstatus", "hasHistogramValues", "P = 0.34", "o_orderstatus = 'P'", ">= 0.34"),
    ]),
    "verify_has_entropy": ("part", _NULLED_NAME, [
        _exact("Entropy", "p_name", "hasEntropy", "4.0", ">= 4.0"),
        _exact("Entropy", "p_name", "hasEntropy", "4.1", ">= 4.1"),
    ]),
    "verify_has_approx_quantile": ("lineitem", {}, [
        Case("l_quantity", "hasApproxQuantile", "24",
             "SELECT quantile_disc(l_quantity, 0.5) FROM t", ">= 24", False),
        Case("l_quantity", "hasApproxQuantile", "28",
             "SELECT quantile_disc(l_quantity, 0.5) FROM t", ">= 28", False),
        Case("l_extendedprice", "hasApproxQuantile", "0.9=90000",
             "SELECT quantile_disc(l_extendedprice, 0.9) FROM t", ">= 90000", False),
        Case("l_extendedprice", "hasApproxQuantile", "0.1=15000",
             "SELECT quantile_disc(l_extendedprice, 0.1) FROM t", ">= 15000", False),
    ]),
    "verify_has_approx_count_distinct": ("lineitem", {}, [
        Case("l_orderkey", "hasApproxCountDistinct", "1000000",
             "SELECT count(DISTINCT l_orderkey) FROM t", "<= 1000000", False),
        Case("l_orderkey", "hasApproxCountDistinct", "1000",
             "SELECT count(DISTINCT l_orderkey) FROM t", "<= 1000", False),
    ]),
    "verify_has_min_length": ("customer", {}, [
        _exact("MinLength", "c_name", "hasMinLength", "18", "= 18"),
        _exact("MinLength", "c_mktsegment", "hasMinLength", "18", "= 18"),
    ]),
    "verify_has_max_length": ("customer", {}, [
        _exact("MaxLength", "c_name", "hasMaxLength", "18", "= 18"),
        _exact("MaxLength", "c_mktsegment", "hasMaxLength", "18.5", "= 18.5"),
    ]),
    "verify_has_min": ("lineitem", {}, [
        _exact("Minimum", "l_quantity", "hasMin", "1", "= 1"),
        _exact("Minimum", "l_quantity", "hasMin", "1.5", "= 1.5"),
    ]),
    "verify_has_max": ("lineitem", {}, [
        _exact("Maximum", "l_quantity", "hasMax", "50", "= 50"),
        _exact("Maximum", "l_quantity", "hasMax", "49", "= 49"),
    ]),
    "verify_has_mean": ("lineitem", {}, [
        _exact("Mean", "l_quantity", "hasMean", "25.40225", "BETWEEN 25.40224999 AND 25.40225001"),
        _exact("Mean", "l_quantity", "hasMean", "25", "= 25"),
    ]),
    "verify_has_sum": ("lineitem", {}, [
        _exact("Sum", "l_quantity", "hasSum", "1524135", "= 1524135"),
        _exact("Sum", "l_quantity", "hasSum", "1524136", "= 1524136"),
    ]),
    "verify_has_standard_deviation": ("lineitem", {}, [
        _exact("StandardDeviation", "l_quantity", "hasStandardDeviation", "14.5", "<= 14.5"),
        _exact("StandardDeviation", "l_quantity", "hasStandardDeviation", "14.4", "<= 14.4"),
    ]),
    "verify_has_pattern": ("orders", _NULLED_PRIORITY, [
        _matches("o_orderstatus", "hasPattern", "^[FOP]", "^[FOP]"),
        _matches("o_orderpriority", "hasPattern", "^[1-5]-", "^[1-5]-"),
    ]),
    "verify_contains_email": ("documents", {}, [
        _matches("text", "containsEmail", "s", patterns.EMAIL),
    ]),
    "verify_contains_email_everywhere": ("customer", _EMAIL, [
        _matches("c_name", "containsEmail", "s", patterns.EMAIL),
    ]),
    "verify_contains_credit_card": ("documents", {}, [
        _matches("text", "containsCreditCardNumber", "s", patterns.CREDIT_CARD),
    ]),
    "verify_contains_credit_card_everywhere": ("customer", _CARD, [
        _matches("c_name", "containsCreditCardNumber", "s", patterns.CREDIT_CARD),
    ]),
    "verify_contains_ssn": ("documents", {}, [
        _matches("text", "containsSocialSecurityNumber", "s", patterns.SOCIAL_SECURITY_NUMBER),
    ]),
    "verify_contains_ssn_everywhere": ("customer", _SSN, [
        _matches("c_name", "containsSocialSecurityNumber", "s", patterns.SOCIAL_SECURITY_NUMBER),
    ]),
    "verify_contains_url": ("pages", {}, [
        _matches("url", "containsURL", "s", patterns.URL),
        _matches("html", "containsURL", "s", patterns.URL),
    ]),
    "verify_has_data_type": ("orders", _NUMERIC_TEXT, [
        Case("o_orderkey", "hasDataType", "Integral", "SELECT 1.0::double", "= 1"),
        Case("o_orderkey", "hasDataType", "String", "SELECT 0.0::double", "= 1"),
        Case("o_custkey", "hasDataType", "integral", "SELECT 1.0::double", "= 1"),
        Case("o_totalprice", "hasDataType", "Fractional", "SELECT 1.0::double", "= 1"),
        Case("o_totalprice", "hasDataType", "Numeric", "SELECT 1.0::double", "= 1"),
        Case("o_orderpriority", "hasDataType", "String", "SELECT 1.0::double", "= 1"),
        _share("o_orderpriority", "hasDataType", "Null", "o_orderpriority IS NULL"),
    ]),
    "verify_is_non_negative": ("customer", {}, [
        _share("c_acctbal", "isNonNegative", "s", "c_acctbal >= 0"),
        _share("c_nationkey", "isNonNegative", "s", "c_nationkey >= 0"),
    ]),
    "verify_is_non_negative_with_nulls": ("customer", _NULLED_BALANCE, [
        _share("c_acctbal", "isNonNegative", "s", "coalesce(c_acctbal, 0) >= 0"),
    ]),
    "verify_is_positive": ("events", {}, [
        _share("value", "isPositive", "s", "value > 0"),
        _share("event_id", "isPositive", "s", "event_id > 0"),
    ]),
    "verify_is_less_than": ("lineitem", {}, [
        _share("l_tax", "isLessThan", "l_discount", "l_tax < l_discount"),
        _share("l_tax", "isLessThan", "l_quantity", "l_tax < l_quantity"),
    ]),
    "verify_is_less_than_or_equal_to": ("lineitem", {}, [
        _share("l_tax", "isLessThanOrEqualTo", "l_discount", "l_tax <= l_discount"),
        _share("l_tax", "isLessThanOrEqualTo", "l_tax", "l_tax <= l_tax"),
    ]),
    "verify_is_greater_than": ("lineitem", {}, [
        _share("l_tax", "isGreaterThan", "l_discount", "l_tax > l_discount"),
        _share("l_extendedprice", "isGreaterThan", "l_quantity", "l_extendedprice > l_quantity"),
    ]),
    "verify_is_greater_than_or_equal_to": ("lineitem", {}, [
        _share("l_quantity", "isGreaterThanOrEqualTo", "l_quantity", "l_quantity >= l_quantity"),
        _share("l_tax", "isGreaterThanOrEqualTo", "l_discount", "l_tax >= l_discount"),
    ]),
    "verify_is_contained_in": ("events", {}, [
        _share("event_type", "isContainedIn", "click, error,purchase,signup ,view",
               "event_type IN ('click', 'error', 'purchase', 'signup', 'view')"),
        _share("event_type", "isContainedIn", "click,view", "event_type IN ('click', 'view')"),
    ]),
    "verify_is_contained_in_numbers": ("lineitem", {}, [
        _share("l_linenumber", "isContainedIn", "1,2,3,4,5,6,7", "l_linenumber BETWEEN 1 AND 7"),
        _share("l_linenumber", "isContainedIn", "1,2,x", "l_linenumber IN (1, 2)"),
    ]),
    "verify_has_correlation": ("lineitem", {}, [
        Case("l_quantity", "hasCorrelation", "l_extendedprice=0.5",
             "SELECT corr(l_quantity, l_extendedprice) FROM t", ">= 0.5"),
        Case("l_quantity", "hasCorrelation", "l_extendedprice=-0.5",
             "SELECT corr(l_quantity, l_extendedprice) FROM t", ">= -0.5"),
    ]),
    "verify_satisfies": ("documents", {}, [
        _share("text", "satisfies", "length(text) = n_chars", "length(text) = n_chars"),
        _share("lang", "satisfies", "lang = 'en' AND n_chars > 0", "lang = 'en' AND n_chars > 0"),
    ]),
    "verify_predicate_fails_on_row": ("lineitem", {}, [
        Case("l_quantity", "satisfies", "1 / (l_orderkey - 1) < 9", _FAILS_ON_FIRST, "= 1"),
        Case("l_returnflag", "satisfies", "CAST(if(l_orderkey = 1, l_returnflag, '1') AS int) > 0", _FAILS_ON_FIRST, "= 1"),
        _share("l_quantity", "satisfies", "l_orderkey = 1 OR 1 / (l_orderkey - 1) < 9",
               "l_orderkey = 1 OR 1.0 / (l_orderkey - 1) < 9"),
        _exact("Completeness", "l_quantity", "isComplete", "s", "= 1"),
    ]),
    "verify_has_sum_zero": ("customer", _THIRDS, [
        Case("c_acctbal", "hasSum", "0", metric_sql("Sum", "c_acctbal"), "BETWEEN -1e-9 AND 1e-9", False),
        Case("c_acctbal", "hasMean", "0", metric_sql("Mean", "c_acctbal"), "BETWEEN -1e-9 AND 1e-9", False),
        Case("c_acctbal", "hasSum", "0.001", metric_sql("Sum", "c_acctbal"), "> 0.0009", False),
    ]),
    "verify_is_contained_in_decimal": ("lineitem", {"l_tax": "CAST(l_tax AS decimal(6,2))"}, [
        _share("l_tax", "isContainedIn", "0, 0.01,0.02,0.03,0.04,0.05,0.060,0.07,0.08",
               "l_tax IN (0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.07, 0.08)"),
        _share("l_tax", "isContainedIn", "0.011,0.02", "l_tax = 0.02"),
    ]),
    "verify_histogram_value_decimal": ("lineitem", {"l_tax": "CAST(l_tax AS decimal(6,2))"}, [
        _share("l_tax", "hasHistogramValues", "0.020=0.05", "l_tax = 0.02", ">= 0.05"),
        _share("l_tax", "hasHistogramValues", "0.019=0.05", "l_tax = 0.019", ">= 0.05"),
    ]),
    "verify_bad_rules": ("lineitem", {}, [
        Case("l_quantity", "hasMin", "abc", "SELECT NULL::double", "= 1"),
        Case("l_missing", "isComplete", "s", "SELECT NULL::double", "= 1"),
        Case("l_quantity", "isUnheardOf", "s", "SELECT NULL::double", "= 1"),
        Case("l_quantity", "hasPattern", "[", "SELECT NULL::double", "= 1"),
        Case("l_quantity", "satisfies", "l_quantity >", "SELECT NULL::double", "= 1"),
        Case("l_quantity", "hasMinLength", "1", "SELECT NULL::double", "= 1"),
        Case("l_shipdate", "hasSum", "1", "SELECT NULL::double", "= 1"),
        Case("l_quantity", "hasDataType", "Colour", "SELECT NULL::double", "= 1"),
        _exact("Minimum", "l_quantity", "hasMin", "1", "= 1"),
    ]),
}


def rule_table(spark: SparkSession, source: str, cases: list[Case]) -> DataFrame:
    """The wide rule table: a row per case, a column per rule."""
    rules = list(dict.fromkeys(case.rule for case in cases))
    columns = {"source": [source] * len(cases), "field": [c.field for c in cases]}
    columns |= {rule: [c.arg if c.rule == rule else None for c in cases] for rule in rules}
    return spark.createDataFrame(pa.table(columns))


def verdicts(spark, sf_dir, source: str, replace: dict[str, str], cases: list[Case]) -> DataFrame:
    df = derived(spark, sf_dir, source, replace)
    found = tm.verify_detailed(df, rule_table(spark, source, cases), source)
    sketches = [c.rule for c in cases if not c.exact] or [""]
    return found.selectExpr(
        "source", "field", "rule", "arg",
        f"if(rule IN ({', '.join(repr(r) for r in sketches)}), NULL, {ROUNDED}) AS value",
        "check_status", "constraint_status",
    )


def verdicts_sql(source: str, replace: dict[str, str], cases: list[Case]) -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    union = " UNION ALL ".join(
        f"SELECT {text(c.field)} AS field, {text(c.rule)} AS rule, {text(c.arg)} AS arg,"
        f" {str(c.exact).lower()} AS exact, value,"
        f" coalesce(value {c.good}, false) AS good FROM (SELECT ({c.value})::double AS value)"
        for c in cases
    )
    return (
        f"WITH t AS ({derived_sql(source, replace)}), v AS ({union})"
        f" SELECT '{source}' AS source, field, rule, arg,"
        f" CASE WHEN exact THEN {ROUNDED} END AS value,"
        " CASE WHEN good THEN 'Success' ELSE 'Error' END AS check_status,"
        " CASE WHEN good THEN 'Success' ELSE 'Failure' END AS constraint_status FROM v"
    )


def _query(name: str):
    return lambda spark, sf_dir: verdicts(spark, sf_dir, *CASES[name])


QUERIES = {name: _query(name) for name in CASES}
ORACLE = {name: verdicts_sql(*case) for name, case in CASES.items()}

# Every rule of the three big tables in one suite per table.
SUITE = {
    source: (source, _NULLED_PRIORITY if source == "orders" else {}, [
        case
        for name, (table, replace, cases) in CASES.items()
        if table == source and replace in ({}, _NULLED_PRIORITY) and name != "verify_bad_rules"
        for case in cases
    ])
    for source in ("orders", "customer", "lineitem")
}


def verify_suite(spark, sf_dir) -> DataFrame:
    orders, customer, lineitem = (verdicts(spark, sf_dir, *SUITE[s]) for s in SUITE)
    return orders.unionByName(customer).unionByName(lineitem)


QUERIES["verify_suite"] = verify_suite
ORACLE["verify_suite"] = " UNION ALL ".join(f"({verdicts_sql(*suite)})" for suite in SUITE.values())


def verify_result_rows(spark, sf_dir) -> DataFrame:
    """The result as it is written: check, constraint and message of each verdict."""
    _, replace, cases = CASES["verify_has_completeness"]
    df = derived(spark, sf_dir, "orders", replace)
    return tm.verify(df, rule_table(spark, "orders", cases), "orders")


QUERIES["verify_result_rows"] = verify_result_rows
ORACLE["verify_result_rows"] = """
WITH v AS (SELECT count(nullif(o_orderpriority, '5-LOW'))::double / count(*) AS value FROM orders),
r AS (SELECT value, bound FROM v, (VALUES (0.75::double), (0.85::double)) AS bounds(bound))
SELECT 'orders' AS source, 'o_orderpriority' AS field, 'hasCompleteness' AS rule,
  'hasCompleteness: o_orderpriority checks' AS "check", 'Error' AS check_level,
  CASE WHEN value >= bound THEN 'Success' ELSE 'Error' END AS check_status,
  concat('Completeness(o_orderpriority) >= ', bound) AS "constraint",
  CASE WHEN value >= bound THEN 'Success' ELSE 'Failure' END AS constraint_status,
  CASE WHEN value >= bound THEN '' ELSE concat('value ', value, ' is not >= ', bound) END
    AS constraint_message
FROM r"""
