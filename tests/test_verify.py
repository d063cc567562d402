"""Rules: reading, typing, verdicts, and the mistakes rule files make."""

import pytest

import tidemark as tm
from tidemark.operators import rules as R


def verdicts(spark, df, **cells):
    """rule -> (status, message) for cells of column `a`."""
    rules = spark.createDataFrame(
        [("t", "a", *cells.values())],
        ", ".join(f"{c} string" for c in ("source", "field", *cells)),
    )
    return {
        r["rule"]: (r["constraint_status"], r["constraint_message"])
        for r in tm.verify(df, rules, "t").collect()
    }


def statuses(spark, df, **cells):
    return {rule: status for rule, (status, _) in verdicts(spark, df, **cells).items()}


@pytest.fixture(scope="module")
def ab(spark):
    return spark.createDataFrame([(1, 2), (2, 2), (3, 4)], "a int, b int")


def test_result_columns(spark, ab):
    rules = spark.createDataFrame([("t", "a", "s")], "source string, field string, isComplete string")
    row = tm.verify(ab, rules, "t").first().asDict()
    assert row == {
        "source": "t", "field": "a", "rule": "isComplete", "check": "isComplete: a checks",
        "check_level": "Error", "check_status": "Success", "constraint": "Completeness(a) = 1.0",
        "constraint_status": "Success", "constraint_message": "",
    }


def test_the_four_comparisons_are_four_operators(spark, ab):
    rules = dict(isLessThan="b", isLessThanOrEqualTo="b", isGreaterThan="b", isGreaterThanOrEqualTo="b")
    assert statuses(spark, ab, **rules) == {
        "isLessThan": "Failure", "isLessThanOrEqualTo": "Success",
        "isGreaterThan": "Failure", "isGreaterThanOrEqualTo": "Failure",
    }
    own = {rule: "a" for rule in rules}
    assert statuses(spark, ab, **own) == {
        "isLessThan": "Failure", "isLessThanOrEqualTo": "Success",
        "isGreaterThan": "Failure", "isGreaterThanOrEqualTo": "Success",
    }


def test_a_null_operand_does_not_comply(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    assert statuses(spark, df, isLessThan="b") == {"isLessThan": "Failure"}


def test_comparing_text_with_numbers_does_not_raise(spark):
    df = spark.createDataFrame([("1", 2), ("x", 2)], "a string, b int")
    assert statuses(spark, df, isLessThan="b") == {"isLessThan": "Failure"}
    assert statuses(spark, df.where("a = '1'"), isLessThan="b") == {"isLessThan": "Success"}


def test_contained_in_fails_on_a_foreign_value_and_accepts_nulls(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "a string")
    assert statuses(spark, df, isContainedIn="x , y") == {"isContainedIn": "Success"}
    assert statuses(spark, df, isContainedIn="x") == {"isContainedIn": "Failure"}


def test_contained_in_quotes_are_data(spark):
    df = spark.createDataFrame([("it's",), ("back\\slash",)], "a string")
    assert statuses(spark, df, isContainedIn="it's,back\\slash") == {"isContainedIn": "Success"}


def test_signs_accept_nulls(spark):
    df = spark.createDataFrame([(0,), (5,), (None,)], "a int")
    assert statuses(spark, df, isNonNegative="s", isPositive="s") == {
        "isNonNegative": "Success", "isPositive": "Failure",
    }
    text = spark.createDataFrame([("1",), ("x",)], "a string")
    assert statuses(spark, text, isPositive="s") == {"isPositive": "Failure"}


def test_thresholds_are_doubles(spark):
    df = spark.createDataFrame([(12.5,)], "a double")
    assert statuses(spark, df, hasMin="12.5", hasMax=" 12.5 ", hasMean="12", hasSum="12.5") == {
        "hasMin": "Success", "hasMax": "Success", "hasMean": "Failure", "hasSum": "Success",
    }


def test_means_and_sums_tolerate_the_order_of_addition(spark):
    df = spark.createDataFrame([(0.1,)] * 10, "a double").repartition(7)
    assert statuses(spark, df, hasSum="1", hasMean="0.1") == {"hasSum": "Success", "hasMean": "Success"}
    assert statuses(spark, df, hasSum="1.00000001") == {"hasSum": "Failure"}


def test_data_type_follows_the_cell(spark):
    df = spark.createDataFrame([("1.5",), ("2.5",), (None,)], "a string")
    for name, status in {"Fractional": "Success", "numeric": "Success", "Integral": "Failure",
                         "String": "Failure", "Colour": "Failure"}.items():
        assert statuses(spark, df, hasDataType=name) == {"hasDataType": status}, name


def test_quantile_is_a_parameter(spark):
    df = spark.range(1, 101).selectExpr("id AS a")
    assert statuses(spark, df, hasApproxQuantile="0.9=89") == {"hasApproxQuantile": "Success"}
    assert statuses(spark, df, hasApproxQuantile="0.1=20") == {"hasApproxQuantile": "Failure"}
    assert statuses(spark, df, hasApproxQuantile="49") == {"hasApproxQuantile": "Success"}
    assert "quantile" in verdicts(spark, df, hasApproxQuantile="7=1")["hasApproxQuantile"][1]


def test_unusual_but_declared_rules(spark, ab):
    got = statuses(
        spark, ab, hasUniqueness="1", hasDistinctness="1", hasUniqueValueRatio="1",
        hasHistogramValues="2=0.33", hasCorrelation="b=0.8", satisfies="a < b",
    )
    assert got == {
        "hasUniqueness": "Success", "hasDistinctness": "Success", "hasUniqueValueRatio": "Success",
        "hasHistogramValues": "Success", "hasCorrelation": "Success", "satisfies": "Failure",
    }


def test_a_histogram_value_may_hold_an_equals_sign(spark):
    df = spark.createDataFrame([("k=v",), ("x",)], "a string")
    assert statuses(spark, df, hasHistogramValues="k=v=0.5") == {"hasHistogramValues": "Success"}


def test_only_s_switches_a_flag_on(spark, ab):
    assert set(statuses(spark, ab, isComplete=" S ", isUnique="n", isPrimaryKey="yes")) == {"isComplete"}


def test_bad_rules_fail_alone(spark, ab):
    got = verdicts(
        spark, ab, isComplete="s", hasMin="abc", isUnheardOf="s", hasPattern="[",
        satisfies="a >", hasMinLength="1", isLessThan="nope", hasHistogramValues="1",
    )
    assert got.pop("isComplete") == ("Success", "")
    assert {status for status, _ in got.values()} == {"Failure"}
    assert got["hasMin"][1] == "no number in abc"
    assert got["isUnheardOf"][1] == "unknown rule"
    assert got["hasPattern"][1] == "bad pattern ["
    assert got["satisfies"][1] == "bad predicate a >"
    assert got["isLessThan"][1] == "no column nope"
    assert got["hasMinLength"][1] == "column a of type int is not text"


def test_a_predicate_with_an_aggregate_is_a_bad_predicate(spark, ab):
    assert verdicts(spark, ab, satisfies="count(*) > 0")["satisfies"] == (
        "Failure", "bad predicate count(*) > 0")


def test_every_rule_fails_on_an_empty_table(spark):
    cells = {name: {"flag": "s", "number": "0", "quantile": "0", "keyed": "b=0", "column": "b",
                    "list": "x", "pattern": ".", "type": "String", "predicate": "a = b"}[rule.cell]
             for name, rule in R.RULES.items()}
    for schema in ("a string, b string", "a int, b int"):
        got = statuses(spark, spark.createDataFrame([], schema), **cells)
        assert set(got) == set(R.RULES) and set(got.values()) == {"Failure"}


def test_a_nan_meets_no_bound(spark):
    df = spark.createDataFrame([(float("nan"),)], "a double")
    assert statuses(spark, df, hasStandardDeviation="1", hasMax="1") == {
        "hasStandardDeviation": "Failure", "hasMax": "Failure"}


def test_rules_are_bound_by_name_and_by_source(spark, ab):
    rules = spark.createDataFrame(
        [("s", "a", "t"), ("s", "a", "it's")], "isUnique string, field string, source string")
    assert [r["source"] for r in tm.verify(ab, rules, "it's").collect()] == ["it's"]


def test_a_table_without_rules_has_an_empty_result(spark, ab):
    rules = spark.createDataFrame([("x", "a", "s")], "source string, field string, isComplete string")
    result = tm.verify(ab, rules, "t")
    assert result.columns[0] == "source" and result.count() == 0
    assert tm.verify(ab, rules.select("source", "field")).count() == 0


def test_rows_without_source_or_field_are_rejected(spark, ab):
    rules = spark.createDataFrame(
        [(None, "a", "s"), ("t", None, "s"), ("t", "a", "s")],
        "source string, field string, isComplete string")
    assert tm.rejected_rules(rules).count() == 2
    got = sorted(r["constraint_message"] for r in tm.verify(ab, rules, "t").collect())
    assert got == ["", "rule without a field"]


def test_too_many_rules_are_refused_not_cut(spark, ab, monkeypatch):
    monkeypatch.setattr(R, "MAX_RULES", 1)
    rules = spark.createDataFrame([("t", "a", "s", "s")],
                                  "source string, field string, isComplete string, isUnique string")
    with pytest.raises(ValueError, match="more than 1 rules"):
        tm.verify(ab, rules, "t")


def test_shared_metrics_are_computed_once(spark, ab):
    rules = spark.createDataFrame(
        [("t", "a", "s", "0.5", "s", "s", "0.1")],
        "source string, field string, isComplete string, hasCompleteness string, isUnique string,"
        " isPrimaryKey string, hasUniqueness string")
    plan = tm.verify(ab, rules, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("count(a") <= 2  # partial of completeness, once
    assert plan.count("Expand") == 1
