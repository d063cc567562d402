"""Landed files bound by header, decimals and collated texts compared as they are."""

import gzip

import pytest

import tidemark as tm
from tidemark.sources.files import format_of


def test_csv_is_bound_by_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,extra,a\n2,z,1\n")
    with gzip.open(tmp_path / "y.csv.gz", "wt") as file:
        file.write("a,b\n3,4\n")
    schema = spark.createDataFrame([], "a int, b string").schema
    df = tm.read_interface(spark, [str(tmp_path / "x.csv"), str(tmp_path / "y.csv.gz")], schema=schema)
    assert df.columns == ["a", "b"]
    assert sorted(map(tuple, df.collect())) == [(1, "2"), (3, "4")]
    (tmp_path / "z.csv").write_text("a\n1\n")
    with pytest.raises(ValueError, match="no column b"):
        tm.read_interface(spark, str(tmp_path / "z.csv"), schema=schema)


def test_formats_by_ending():
    found = [format_of(p) for p in ("/l/x.csv", "/l/x.csv.gz", "/l.d/x", "/l/x.json.zst", "/l/x.2024.orc/")]
    assert found == ["csv", "csv", "parquet", "json", "orc"]


def test_decimals_are_not_rounded(spark):
    df = spark.sql("SELECT CAST(1.24 AS decimal(10,2)) AS d")
    rules = spark.createDataFrame(
        [("d", "1.239", None), ("d", "1.240", None), ("d", None, "1.239=1"), ("d", None, "1.24=1")],
        "field string, isContainedIn string, hasHistogramValues string",
    ).selectExpr("'t' AS source", "*")
    verdicts = {(r["rule"], r["arg"]): r["constraint_status"] for r in tm.verify_detailed(df, rules).collect()}
    assert verdicts == {
        ("isContainedIn", "1.239"): "Failure", ("isContainedIn", "1.240"): "Success",
        ("hasHistogramValues", "1.239=1"): "Failure", ("hasHistogramValues", "1.24=1"): "Success",
    }


def test_collated_texts_count_as_equal_at_any_length(spark):
    df = spark.sql(
        "SELECT s COLLATE UTF8_LCASE AS s FROM VALUES ('ab'), ('AB'), (repeat('ab', 50)), (repeat('AB', 50)), ('') AS t(s)"
    )
    wanted = [tm.Request("CountDistinct", "s"), tm.Request("ApproxCountDistinct", "s")]
    values = {r["name"]: r["value"] for r in tm.metrics(df, wanted).collect()}
    assert values["CountDistinct"] == 3
    assert round(values["ApproxCountDistinct"]) == 3
