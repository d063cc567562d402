"""Rules files, landed files, result files and the job."""

import os

import pytest

import tidemark as tm
from tidemark.sources import files
from tidemark.sources.folders import shared_folder


@pytest.fixture
def landing(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "sales.csv").write_text("id,amount\n1,2.5\n2,\n3,abc\n")
    spark.range(10).withColumnRenamed("id", "k").write.parquet(str(folder / "stock.parquet"))
    (folder / "broken.parquet").write_text("this is no parquet file")
    (folder / "ignored.csv").write_text("x\n1\n")
    return str(folder)


def rules_file(tmp_path, text):
    path = tmp_path / "rules.csv"
    path.write_text(text)
    return str(path)


def part_files(path):
    return [f for f in os.listdir(path) if f.startswith("part-")]


def test_rules_are_read_by_name_with_any_subset_of_columns(spark, tmp_path):
    path = rules_file(tmp_path, "hasMin; source;field;isOdd\n5;t;a;s\n;t;b;\n")
    rules = tm.read_rules(spark, path)
    row = rules.where("field = 'a'").first()
    assert (row["source"], row["hasMin"], row["isOdd"], row["isUnique"]) == ("t", "5", "s", None)
    assert {(r["rule"], r["arg"]) for r in tm.unpivot_rules(rules).collect()} == {
        ("hasMin", "5"), ("isOdd", "s")}


def test_a_rules_file_needs_its_keys(spark, tmp_path):
    with pytest.raises(ValueError, match="no column field"):
        tm.read_rules(spark, rules_file(tmp_path, "source;isUnique\nt;s\n"))


def test_a_bad_cell_spoils_only_itself(spark, tmp_path):
    path = rules_file(tmp_path, "source;field;hasMin;hasMax\nt;id;oops;9\n")
    got = {r["rule"]: r["constraint_status"]
           for r in tm.verify(spark.range(10), tm.read_rules(spark, path), "t").collect()}
    assert got == {"hasMin": "Failure", "hasMax": "Success"}


def test_landed_files_are_found_by_name(spark, landing):
    found = {r["interface"]: r["path"] for r in
             tm.landed_files(spark, landing, ["sales", "stock", "absent"]).collect()}
    assert found == {"sales": f"{landing}/sales.csv", "stock": f"{landing}/stock.parquet"}


def test_the_schema_comes_from_the_catalog_if_it_can(spark, landing):
    spark.sql("CREATE OR REPLACE TEMP VIEW landed_sales AS SELECT 1L AS id, 'x' AS amount")
    df = tm.read_interface(spark, f"{landing}/sales.csv", table="landed_sales", schema="id int")
    assert dict(df.dtypes) == {"id": "bigint", "amount": "string"}
    df = tm.read_interface(spark, f"{landing}/sales.csv", table="no_such_table",
                           schema="id int, amount string")
    assert dict(df.dtypes) == {"id": "int", "amount": "string"}
    assert tm.read_interface(spark, f"{landing}/stock.parquet").count() == 10


def test_a_result_is_one_part_file_with_a_header(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    for _ in range(2):  # overwrites
        tm.write_single_csv(spark.range(0, 100, 1, 5).selectExpr("id AS n"), path, "n")
    assert len(part_files(path)) == 1
    lines = open(os.path.join(path, part_files(path)[0])).read().split()
    assert lines[0] == "n" and lines[1:] == [str(i) for i in range(100)]


def test_the_job_writes_both_results_and_survives_a_bad_interface(spark, landing, tmp_path):
    rules = tm.read_rules(spark, rules_file(
        tmp_path, "source;field;isComplete;hasMin\nsales;amount;s;\nsales;id;s;1\nbroken;x;s;\n"))
    out = str(tmp_path / "results")
    outcome = {r["interface"]: r for r in
               tm.run(spark, landing, ["sales", "broken", "stock", "absent"], rules, out).collect()}
    assert {k: r["status"] for k, r in outcome.items()} == {
        "sales": "Success", "broken": "Failure", "stock": "Success", "absent": "Failure"}
    assert outcome["absent"]["message"] == "nothing landed for absent"
    sales = spark.read.option("header", True).csv(files.verification_path(out, "sales"))
    assert {(r["field"], r["rule"]): r["constraint_status"] for r in sales.collect()} == {
        ("amount", "isComplete"): "Failure", ("id", "isComplete"): "Success", ("id", "hasMin"): "Success"}
    profile = spark.read.option("header", True).csv(files.profile_path(out, "sales"))
    values = {(r["instance"], r["name"]): float(r["value"]) for r in profile.collect()}
    assert values["*", "Size"] == 3 and values["amount", "Completeness"] == pytest.approx(2 / 3)
    # an interface without rules: a header and no rows
    empty = files.verification_path(out, "stock")
    assert spark.read.option("header", True).csv(empty).count() == 0


def test_a_predicate_that_fails_on_a_row_fails_alone(spark, landing, tmp_path):
    rules = spark.createDataFrame(
        [("stock", "k", "1 / k > 0", "s"), ("stock", "k", "k >= 0", None)],
        "source string, field string, satisfies string, isUnique string")
    out = str(tmp_path / "results")
    assert tm.run(spark, landing, ["stock"], rules, out).first()["status"] == "Success"
    written = spark.read.option("header", True).csv(files.verification_path(out, "stock"))
    got = {r["constraint"]: (r["constraint_status"], r["constraint_message"]) for r in written.collect()}
    status, message = got["Satisfies(k, 1 / k > 0) = 1.0"]
    assert status == "Failure" and message.startswith("predicate fails on the data")
    assert got["Satisfies(k, k >= 0) = 1.0"][0] == "Success"
    assert got["Uniqueness(k) = 1.0"][0] == "Success"


def test_all_files_landed_for_an_interface_are_one_table(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for day in (1, 2):
        (folder / f"sales_{day}.csv").write_text(f"id;note\n{day};a\n")
    spark.sql("CREATE OR REPLACE TEMP VIEW landing_sales AS SELECT 1L AS id, 'x' AS note")
    out = str(tmp_path / "results")
    rules = spark.createDataFrame([("sales", "id", "s")], "source string, field string, isUnique string")
    outcome = tm.run(
        spark, str(folder), ["sales"], rules, out, pattern=r"^([a-z]+)_",
        read=lambda spark, interface, paths: tm.read_interface(
            spark, paths, table="landing_sales", options={"sep": ";"}),
    ).first()
    assert outcome["status"] == "Success", outcome["message"]
    profile = spark.read.option("header", True).csv(files.profile_path(out, "sales"))
    values = {(r["instance"], r["name"]): float(r["value"]) for r in profile.collect()}
    assert values["*", "Size"] == 2 and values["id", "Sum"] == 3


def test_the_job_takes_schemas_from_the_catalog(spark, landing, tmp_path):
    spark.sql("CREATE OR REPLACE TEMP VIEW landing_sales AS SELECT 1L AS id, 1.5D AS amount")
    rules = spark.createDataFrame([("sales", "amount", "2.5")], "source string, field string, hasMax string")
    out = str(tmp_path / "results")
    tm.run(spark, landing, ["sales"], rules, out, tables={"sales": "landing_sales"})
    written = spark.read.option("header", True).csv(files.verification_path(out, "sales"))
    assert written.first()["constraint_status"] == "Success"


def test_job_results_equal_profile_and_verify(spark, landing, tmp_path):
    rules = spark.createDataFrame([("stock", "k", "s", "0.9=8", "10")],
                                  "source string, field string, isUnique string,"
                                  " hasApproxQuantile string, hasNumberOfDistinctValues string")
    out = str(tmp_path / "results")
    tm.run(spark, landing, ["stock"], rules, out)
    df = tm.read_interface(spark, f"{landing}/stock.parquet")
    written = spark.read.option("header", True).csv(files.profile_path(out, "stock"))
    assert {(r["instance"], r["name"]) for r in written.collect()} == {
        (r["instance"], r["name"]) for r in tm.profile(df).collect()}
    written = spark.read.option("header", True).csv(files.verification_path(out, "stock"))
    assert {(r["rule"], r["constraint"]) for r in written.collect()} == {
        (r["rule"], r["constraint"]) for r in tm.verify(df, rules, "stock").collect()}


def test_the_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_blanks_around_a_source_do_not_lose_its_rules(spark):
    rules = spark.createDataFrame([(" t ", "a", "s"), ("u", "a", "s")], "source string, field string, isComplete string")
    assert [row["source"] for row in tm.rules_for(rules, "t").collect()] == ["t"]
