"""Quantile summaries: the same bits in every run, and ranks within the stated bound."""

import math
import random

import pytest

import tidemark as tm
from tidemark.operators import scan

RANKS = [0.0, 0.001, 0.1, 0.25, 0.5, 0.777, 0.9, 0.999, 1.0]


def quantiles(df):
    wanted = [tm.Request("ApproxQuantile", "x", str(q)) for q in RANKS]
    return [r.value for r in sorted(tm.metrics(df, wanted).collect(), key=lambda r: float(r.name.split("-")[1]))]


def furthest(values, found):
    """By how much of the rows a found value lies off its rank, at most."""
    n, worst = len(values), 0.0
    for q, v in zip(RANKS, found):
        below, upto = sum(x < v for x in values) / n, sum(x <= v for x in values) / n
        worst = max(worst, below - q, q - upto)
    return worst


def bound(partitions):
    """Half a share for the partitions, for each level of merges but the last and for the answer."""
    return (2 + scan.merge_levels(partitions)) * 0.5 / scan.QUANTILE_POINTS + 1 / scan.QUANTILE_ACCURACY


@pytest.mark.parametrize("partitions", [1, 7, 200])
@pytest.mark.parametrize("shape", ["even", "few", "skewed", "sorted"])
def test_ranks_within_the_bound(spark, partitions, shape):
    rng = random.Random(partitions)
    values = {
        "even": lambda: [rng.random() for _ in range(20_000)], "few": lambda: [float(rng.randint(0, 3)) for _ in range(9_999)],
        "skewed": lambda: [math.exp(rng.gauss(0, 9)) * rng.choice([-1, 1]) for _ in range(20_000)] + [0.0] * 7_000,
        "sorted": lambda: [i / 7 for i in range(30_000)],
    }[shape]()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    df = df.repartitionByRange(partitions, "x") if shape == "sorted" else df.repartition(partitions)
    # A value is one row of its own, which few rows cannot divide.
    assert furthest(values, quantiles(df)) <= bound(partitions) + partitions / len(values)


def test_two_runs_give_the_same_bits(spark, tmp_path):
    spark.range(200_000).selectExpr("sin(id) * exp(id % 31) AS x").repartition(90).write.parquet(str(tmp_path / "t"))
    runs = {tuple(quantiles(spark.read.parquet(str(tmp_path / "t")))) for _ in range(4)}
    assert len(runs) == 1


def test_merging_in_levels_keeps_the_bound(spark, monkeypatch):
    monkeypatch.setattr(scan, "MERGE_WIDTH", 3)
    monkeypatch.setattr(scan, "input_partitions", lambda df: 81)
    values = [float((i * 7919) % 30_011) for i in range(30_011)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(81)
    assert furthest(values, quantiles(df)) <= bound(81)


def test_few_and_no_values(spark):
    df = spark.createDataFrame([(5.0,), (None,), (1.0,), (3.0,)], "x double").repartition(4)
    found = quantiles(df)
    assert found[0] == 1.0 and found[4] == 3.0 and found[-1] == 5.0
    empty = spark.createDataFrame([(None,)], "x double")
    assert tm.metrics(empty, [tm.Request("ApproxQuantile", "x", "0.5")]).count() == 0
    texts = spark.createDataFrame([("1",), ("10",), ("9",)], "x string")
    assert quantiles(texts)[4] == 9.0
