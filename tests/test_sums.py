"""Sums and means: the same in every bit however rows are dealt out, and equal up to rounding."""

import math
import random
from fractions import Fraction

import pytest

import tidemark as tm
from tidemark.operators import scan


def value(df, metric, column="x"):
    found = [r.value for r in tm.metrics(df, [tm.Request(metric, column)]).collect()]
    return found[0] if found else None


def doubles(spark, values, partitions=3):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)


def verdict(spark, df, **cells):
    names = ", ".join(f"{c} string" for c in ("source", "field", *cells))
    rules = spark.createDataFrame([("t", "x", *cells.values())], names)
    return {r["rule"]: r["constraint_status"] for r in tm.verify(df, rules, "t").collect()}


def test_equal_bits_after_any_repartition(spark):
    rng = random.Random(1)
    values = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-25, 25) for _ in range(3000)]
    values += [-v for v in values[:1000]] + [0.1] * 1000
    found = {(value(df, "Sum"), value(df, "Mean")) for df in (
        doubles(spark, rng.sample(values, len(values)), n) for n in (1, 2, 7, 150)
    )}
    assert len(found) == 1
    total = float(sum(map(Fraction, values)))
    assert math.isclose(found.pop()[0], total, rel_tol=2e-15)


@pytest.mark.parametrize("values, total", [
    ([1e30, 1.0, -1e30], 1.0), ([2.0**94, -(2.0**94), 2.0**-90], 2.0**-90), ([0.1, 0.2, -0.3], 2.0**-55),
    ([-0.1] * 10, float(10 * Fraction(-0.1))), ([1e300, 1.0], 1e300), ([5e-324], 0.0), ([0.0, -0.0], 0.0), ([-5.0, 2.0], -3.0),
    ([float("inf"), 1.0], float("inf")), ([9e15, 1.0, 0.25], 9e15 + 1), ([-(2.0**127), 1.0], -(2.0**127)),
])
def test_sums(spark, values, total):
    assert value(doubles(spark, values), "Sum") == total
    assert value(doubles(spark, [*values, None]), "Mean") == total / len(values)


def test_not_a_number_and_no_number(spark):
    assert math.isnan(value(doubles(spark, [float("nan"), 1.0]), "Sum"))
    assert value(doubles(spark, [None, None]), "Sum") is None
    assert verdict(spark, doubles(spark, [float("inf")]), hasSum="3", hasMean="3") == {"hasSum": "Failure", "hasMean": "Failure"}


def test_whole_numbers_and_decimals_are_exact(spark):
    big = 2**62
    longs = spark.createDataFrame([(big,), (big,), (big,), (-big,), (7,), (-1,)], "x long")
    assert value(longs, "Sum") == float(2 * big + 6)
    assert value(spark.sql("SELECT CAST(id AS int) AS x FROM range(100)"), "Sum") == 4950
    wide = spark.sql("SELECT CAST('99999999999999999999999999999999999.999' AS decimal(38,3)) AS x FROM range(2)")
    assert value(wide, "Sum") == 2e35
    floats = spark.createDataFrame([(0.1,), (0.2,)], "x float")
    assert value(floats, "Sum") == 0.10000000149011612 + 0.20000000298023224
    texts = spark.createDataFrame([("0.1",), ("0.2",), ("-0.3",)], "x string")
    assert value(texts, "Sum") == 2.0**-55


def test_tolerance_at_zero(spark):
    near = doubles(spark, [0.1, 0.2, -0.3])
    assert verdict(spark, near, hasSum="0", hasMean="0") == {"hasSum": "Success", "hasMean": "Success"}
    assert verdict(spark, near, hasSum="1e-15", hasMean="1e-15") == {"hasSum": "Failure", "hasMean": "Failure"}
    whole = spark.createDataFrame([(1,), (-1,)], "x int")
    assert verdict(spark, whole, hasSum="0.0000001") == {"hasSum": "Failure"}


@pytest.mark.parametrize("partitions", [1, 10, 64, 65, 1_000, 4_097, 100_000])
def test_no_merge_reads_more_than_its_width(spark, partitions):
    rows, widths = spark.range(partitions).withColumnRenamed("id", "bucket"), []
    for _ in range(scan.merge_levels(partitions)):  # after a row for each partition
        rows = rows.groupBy(scan.F.expr(scan.next_bucket("bucket")).alias("bucket")).count()
        widths.append(rows.agg({"count": "max"}).first()[0])
    assert max([1, *widths]) <= scan.MERGE_WIDTH and rows.count() <= scan.MERGE_WIDTH


def test_levels_do_not_change_metrics(spark, monkeypatch):
    df = spark.range(5000).selectExpr("id % 97 AS x", "string(id) AS s", "id / 7D AS y").repartition(200)
    wanted = [tm.Request(m, c) for m in ("Sum", "Mean", "StandardDeviation", "Minimum", "Completeness") for c in ("x", "y")]
    wanted += [tm.Request("ApproxCountDistinct", "s"), tm.Request("Correlation", "x", "y"), tm.Request("DataType", "s")]
    found = []
    for width in (64, 3):
        monkeypatch.setattr(scan, "MERGE_WIDTH", width)
        monkeypatch.setattr(scan, "input_partitions", lambda df: 200)
        found.append({(r.instance, r.name): round(r.value, 9) for r in tm.metrics(df, wanted).collect()})
    assert found[0] == found[1]
