"""Predicates that fail on rows of the data: one Failure row each, in one scan, also in lazy verify."""

import pytest

import tidemark as tm


def results(spark, df, *predicates):
    rules = spark.createDataFrame(
        [("t", "a", p, None) for p in predicates] + [("t", "a", None, "s")],
        "source string, field string, satisfies string, isComplete string",
    )
    found = tm.verify_detailed(df, rules, "t").collect()
    assert [r.constraint_status for r in found if r.rule == "isComplete"] == ["Success"]
    return {r.arg: (r.constraint_status, r.value, r.constraint_message) for r in found if r.rule == "satisfies"}


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(-2, 3).selectExpr("id AS a", "if(id = 1, 'x', string(id)) AS s", "array(id) AS many")


def test_each_kind_of_error_fails_its_rule_alone(spark, numbers):
    errors = {
        "1 / a < 9": 1, "s::int < 9": 1, "many[a] > -9": 4, "raise_error(s) IS NULL": 5, "a + 9223372036854775807 <> 0": 2,
        "to_date(s, 'yyyy-MM-dd') > '2000-01-01'": 5, "element_at(map(1L, 2), a) > 0 OR 1 / a < 9": 1,
    }
    good = {"a < 3": 1.0, "a > 0": 0.4, "a = 0 OR 1 / a < 9": 1.0, "try_cast(s AS int) < 9": 0.8, "NULL": 0.0}
    found = results(spark, numbers, *errors, *good)
    for predicate, rows in errors.items():
        assert found[predicate] == ("Failure", None, f"predicate fails on the data, in {rows} rows"), predicate
    for predicate, value in good.items():
        assert found[predicate][:2] == ("Success" if value == 1 else "Failure", value), predicate


def test_parts_that_predicates_share_fail_where_they_stand(spark, numbers):
    shared = ["1 / a < 9 OR 1 / a >= 9", "1 / a < 9", "a <> 0 AND 1 / a < 9", "if(a = 0, true, 1 / a < 9)"]
    found = results(spark, numbers, *shared)
    assert [found[p][0] for p in shared] == ["Failure", "Failure", "Failure", "Success"]
    assert found[shared[2]][1] == 0.8 and found[shared[0]][1] is None


def test_many_predicates_are_one_scan(spark, numbers, tmp_path):
    path = str(tmp_path / "numbers")
    numbers.write.parquet(path)
    rules = spark.createDataFrame([("t", "a", f"{i} / a < 9") for i in range(40)], "source string, field string, satisfies string")
    verified = tm.verify(spark.read.parquet(path), rules, "t")
    plan = verified._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert verified.where("constraint_status = 'Failure'").count() == 40


def test_an_empty_table_fails_no_predicate_on_a_row(spark, numbers):
    found = results_of_empty = tm.verify_detailed(
        numbers.where("a > 9"),
        spark.createDataFrame([("t", "a", "1 / 0 > 0")], "source string, field string, satisfies string"), "t",
    ).first()
    assert found.constraint_status == "Failure" and found.constraint_message == "the metric has no value"
    assert results_of_empty.value is None
