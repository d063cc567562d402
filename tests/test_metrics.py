"""Metrics on small frames: nulls, empty tables, special values, and how they scale."""

import datetime
import decimal
import math
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

import tidemark as tm
from tidemark import Request
from tidemark.operators import frequency, scan
from tidemark.plans.metrics import compute


def values(df, *requests):
    return {
        (row["instance"], row["name"]): row["value"]
        for row in tm.metrics(df, requests).collect()
    }


def everything(df):
    return {(r["instance"], r["name"]): r["value"] for r in tm.profile(df).collect()}


def test_nulls_count_in_the_total_but_not_as_values(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    got = everything(df)
    assert got["*", "Size"] == 4
    assert got["c", "Completeness"] == 0.75
    assert got["c", "Distinctness"] == 0.5
    assert got["c", "Uniqueness"] == 0.25
    assert got["c", "UniqueValueRatio"] == 0.5
    assert got["c", "Entropy"] == pytest.approx(-(0.5 * math.log(0.5) + 0.25 * math.log(0.25)))
    assert got["c", "Histogram.abs.Unknown"] == 1
    assert got["c", "Histogram.ratio.String"] == 0.75


def test_the_empty_text_is_a_value(spark):
    got = everything(spark.createDataFrame([("",), ("",)], "c string"))
    assert got["c", "ApproxCountDistinct"] == 1 and got["c", "Distinctness"] == 0.5
    assert got["c", "Histogram.abs.String"] == 2


def test_empty_table_has_a_size_and_nothing_else(spark):
    df = spark.createDataFrame([], "c string, n int, a array<int>")
    assert everything(df) == {("*", "Size"): 0.0}


def test_all_null_column(spark):
    got = everything(spark.createDataFrame([(None,), (None,)], "n int"))
    assert got["n", "Completeness"] == 0
    assert got["n", "Distinctness"] == 0
    assert got["n", "ApproxCountDistinct"] == 0
    absent = {"Mean", "Maximum", "ApproxQuantile-0.5", "UniqueValueRatio", "Entropy"}
    assert not absent & {name for _, name in got}


def test_single_row_is_unique_with_no_entropy(spark):
    got = everything(spark.createDataFrame([(7,)], "n int"))
    assert (got["n", "Uniqueness"], got["n", "Entropy"], got["n", "Mean"]) == (1, 0, 7)
    assert got["n", "ApproxQuantile-0.5"] == 7


def test_nan_and_negative_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "x double")
    got = everything(df)
    assert got["x", "Distinctness"] == 0.5  # one zero, one NaN
    assert math.isnan(got["x", "Maximum"]) and got["x", "Minimum"] == 0
    assert math.copysign(1, got["x", "Minimum"]) == 1


def test_every_atomic_type_is_profiled(spark):
    day, time = datetime.date(2024, 2, 29), datetime.datetime(2024, 2, 29, 1, 2, 3)
    row = (1, 2, 3, 4, 1.5, 2.5, decimal.Decimal("3.25"), True, day, time, time, b"x", "t", [1])
    schema = (
        "b byte, s short, i int, l long, f float, d double, m decimal(10,2), t boolean, a date,"
        " ts timestamp, n timestamp_ntz, y binary, c string, r array<int>"
    )
    got = everything(spark.createDataFrame([row, row, tuple([None] * 14)], schema))
    for column in "b s i l f d m t a ts n y c".split():
        assert got[column, "Distinctness"] == pytest.approx(1 / 3), column
        assert got[column, "ApproxCountDistinct"] == 1, column
    assert {c for c, name in got if name == "Mean"} == set("b s i l f d m".split())
    assert [name for c, name in got if c == "r"] == ["Completeness"]


def test_column_names_with_dots_quotes_and_backticks(spark):
    df = spark.createDataFrame([(1, "x", None)], "`a.b` int, `it's` string, `c``d` string")
    got = everything(df)
    assert got["a.b", "Maximum"] == 1 and got["it's", "Uniqueness"] == 1
    assert got["c`d", "Completeness"] == 0


def test_text_is_typed_by_its_values(spark):
    rows = [("1", "1.5", "true", "1", "true", "1"), ("-2", "+.5", "false", "x", "3", "2\n")]
    df = spark.createDataFrame(rows, "i string, f string, b string, s string, m string, n string")
    types = {r["column"]: r["data_type"] for r in tm.column_profiles(df).collect()}
    assert types == {"i": "Integral", "f": "Fractional", "b": "Boolean", "s": "String",
                     "m": "String", "n": "String"}
    got = everything(df)
    assert got["i", "Sum"] == -1 and got["f", "Mean"] == 1
    assert ("s", "Sum") not in got and ("b", "Sum") not in got


def test_long_texts_differing_only_at_the_end_are_different_values(spark):
    text = "x" * 10_000
    df = spark.createDataFrame([(text + "a",), (text + "b",), (text + "b",), ("x",)], "c string")
    got = values(df, Request("CountDistinct", "c"), Request("Uniqueness", "c"))
    assert got["c", "CountDistinct"] == 3 and got["c", "Uniqueness"] == 0.5


def test_moments_merge_across_partitions(spark):
    df = spark.range(0, 10_000, 1, 13).selectExpr("id", "1e9 + id % 97 AS x", "id % 31 - id AS y")
    pdf = df.toPandas()
    got = values(df, Request("StandardDeviation", "x"), Request("Correlation", "x", "y"),
                 Request("Mean", "x"))
    assert got["x", "StandardDeviation"] == pytest.approx(pdf.x.std(ddof=0), rel=1e-9)
    assert got["x", "Mean"] == pytest.approx(pdf.x.mean(), rel=1e-12)
    # x is known to 1e-7 in 28, its standard deviation, so a coefficient to some 1e-9
    assert got["x,y", "Correlation"] == pytest.approx(pdf.x.corr(pdf.y), abs=1e-8)


def test_correlation_ignores_rows_with_a_null(spark):
    df = spark.createDataFrame([(1, 2), (2, 4), (3, 6), (9, None), (None, 1)], "a int, b int")
    assert values(df, Request("Correlation", "a", "b"))["a,b", "Correlation"] == pytest.approx(1)


def test_repartitioning_changes_nothing(spark):
    df = spark.range(0, 5_000, 1, 4).selectExpr("id % 71 AS k", "id / 7 AS x", "string(id % 3) AS s")
    def exact(frame):
        return {k: v for k, v in everything(frame).items() if "Approx" not in k[1]}
    assert exact(df.repartition(23)) == pytest.approx(exact(df.coalesce(1)), rel=1e-12)


def test_doubling_a_table(spark):
    df = spark.range(0, 1000, 1, 3).selectExpr("id", "if(id % 4 = 0, NULL, id % 11) AS k")
    once, twice = everything(df), everything(df.union(df))
    for column in ("id", "k"):
        for name in ("Completeness", "Entropy", "ApproxCountDistinct"):
            assert twice[column, name] == pytest.approx(once[column, name])
        assert twice[column, "Uniqueness"] == 0
        assert twice[column, "Distinctness"] == pytest.approx(once[column, "Distinctness"] / 2)


def test_more_input_partitions_than_a_merge_reads(spark):
    df = spark.range(0, 60_000, 1, 700).selectExpr("id", "id % 1000 / 4 AS x", "string(id % 9) AS s")
    assert df.rdd.getNumPartitions() > scan.MERGE_WIDTH
    got = everything(df)
    assert got["*", "Size"] == 60_000 and got["id", "Uniqueness"] == 1
    assert got["id", "ApproxCountDistinct"] == pytest.approx(60_000, rel=0.1)
    assert got["id", "ApproxQuantile-0.5"] == pytest.approx(30_000, rel=0.05)
    assert got["x", "ApproxQuantiles-0.9"] == pytest.approx(225, rel=0.05)
    assert got["x", "Mean"] == pytest.approx(124.875) and got["s", "Mean"] == pytest.approx(4, abs=0.001)
    moments = values(df, Request("StandardDeviation", "x"))
    assert moments["x", "StandardDeviation"] == pytest.approx(72.16875, rel=1e-6)


def test_a_value_that_fills_a_third_of_the_table(spark):
    df = spark.range(0, 30_000, 1, 8).selectExpr("if(id % 3 = 0, -1, id) AS k")
    got = values(df, Request("CountDistinct", "k"), Request("Uniqueness", "k"))
    assert got["k", "CountDistinct"] == 20_001
    assert got["k", "Uniqueness"] == pytest.approx(2 / 3)


def test_batches_of_columns_agree_with_one_scan(spark, monkeypatch):
    df = spark.range(0, 100, 1, 2).selectExpr(*[f"id % {i + 2} AS c{i}" for i in range(9)])
    whole = everything(df)
    monkeypatch.setattr(scan, "COLUMNS_PER_SCAN", 2)
    monkeypatch.setattr(frequency, "COLUMNS_PER_SHUFFLE", 2)
    assert everything(df) == pytest.approx(whole)


_column = st.lists(
    st.one_of(st.none(), st.integers(-3, 3), st.integers(-(2**53), 2**53)), max_size=40
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_column)
def test_frequency_metrics_by_brute_force(spark, column):
    df = spark.createDataFrame([(v,) for v in column], "c long")
    got = {name: v for (_, name), v in values(df, *[Request(m, "c") for m in frequency.METRICS]).items()}
    counts = Counter(v for v in column if v is not None)
    n = len(column)
    once = sum(1 for k in counts.values() if k == 1)
    expected = {} if not n else {
        "Distinctness": len(counts) / n,
        "Uniqueness": once / n,
        "CountDistinct": len(counts),
    }
    if counts:
        expected["UniqueValueRatio"] = once / len(counts)
        expected["Entropy"] = -sum(k / n * math.log(k / n) for k in counts.values())
    assert got == pytest.approx(expected, abs=1e-12)


def test_histogram(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    rows = {r["value"]: (r["n"], r["ratio"]) for r in tm.histogram(df, "c").collect()}
    assert rows == {"a": (2, 0.5), "b": (1, 0.25), None: (1, 0.25)}
    assert [r["value"] for r in tm.histogram(df, "c", top=1).collect()] == ["a"]


def test_unknown_metric_or_column_is_an_error(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="no column nope"):
        tm.metrics(df, [Request("Mean", "nope")])
    with pytest.raises(ValueError, match="unknown metric"):
        tm.metrics(df, [Request("Magic", "id")])


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_metrics_take_one_scan_and_two_small_exchanges(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    requests = [Request(m, c) for c in ("l_quantity", "l_tax")
                for m in ("Mean", "Completeness", "ApproxCountDistinct", "ApproxQuantiles")]
    table, _ = compute(df, requests)
    plan = _plan(table)
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 2
    assert re.search(r"ReadSchema: struct<l_quantity:double,l_tax:double>", plan)


def test_value_metrics_take_one_scan_and_combine_before_the_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    table, _ = compute(df, [Request("Uniqueness", c) for c in ("l_orderkey", "l_returnflag", "l_tax")])
    plan = _plan(table)
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 2
    assert plan.count("partial_count(1)") == 1
    assert "Expand" in plan and "Window" not in plan and "Join" not in plan


def test_a_histogram_counts_long_texts_by_digest(spark, tmp_path):
    spark.range(1000).selectExpr("concat(repeat('x', 100), id % 7) AS s").write.parquet(str(tmp_path / "t"))
    bins = tm.histogram(spark.read.parquet(str(tmp_path / "t")), "s", 3)
    rows = bins.collect()
    assert [r["n"] for r in rows] == [143, 143, 143] and [r["value"][-1] for r in rows] == ["0", "1", "2"]
    assert "sha2" in bins._jdf.queryExecution().executedPlan().toString()
