"""Results of an interface are replaced together; what a job needs on the way is deleted."""

import os

import pytest

import tidemark as tm
from tidemark.plans import job
from tidemark.sources import files
from tidemark.sources.folders import shared_folder

RULES = "source string, field string, isComplete string"


@pytest.fixture
def landing(spark, tmp_path):
    folder = tmp_path / "landing"
    spark.range(3).selectExpr("id AS k").write.parquet(str(folder / "stock.parquet"))
    return str(folder)


def sizes(spark, out):
    profile = spark.read.option("header", True).csv(files.profile_path(out, "stock"))
    return profile.where("name = 'Size'").first()["value"], sorted(os.listdir(out))


def test_a_failure_between_the_writes_leaves_the_older_pair(spark, landing, tmp_path, monkeypatch):
    out, rules = str(tmp_path / "out"), spark.createDataFrame([("stock", "k", "s")], RULES)
    assert tm.run(spark, landing, ["stock"], rules, out).first()["status"] == "Success"
    before = sizes(spark, out)
    assert before == ("3.0", ["stock.profile.csv", "stock.verification.csv"])
    spark.range(9).selectExpr("id AS k").write.mode("overwrite").parquet(f"{landing}/stock.parquet")
    write = files.write_single_csv

    def failing(df, path, *order):
        if path.endswith("verification.csv"):
            raise OSError("disk full")
        write(df, path, *order)

    monkeypatch.setattr(job.files, "write_single_csv", failing)
    assert tm.run(spark, landing, ["stock"], rules, out).first()["message"] == "disk full"
    assert sizes(spark, out) == before
    monkeypatch.undo()
    assert tm.run(spark, landing, ["stock"], rules, out).first()["status"] == "Success"
    assert sizes(spark, out) == ("9.0", before[1])


def test_a_failing_move_puts_the_older_results_back(spark, tmp_path):
    for name in ("a", "b", "new_a"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "of").write_text(name)
    aside = {str(tmp_path / "new_a"): str(tmp_path / "a"), str(tmp_path / "missing"): str(tmp_path / "b")}
    with pytest.raises(Exception):
        files.publish(spark, aside)
    assert [(tmp_path / name / "of").read_text() for name in ("a", "b")] == ["a", "b"]


def test_nothing_stays_in_the_shared_folder(spark, landing, tmp_path):
    before = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    rules = spark.createDataFrame([("stock", "k", "s")], RULES)
    tm.run(spark, landing, ["stock"], rules, str(tmp_path / "out"))
    assert set(os.listdir(shared_folder(spark).removeprefix("file:"))) == before


def test_schemas_and_odd_files(spark, tmp_path):
    folder, out = tmp_path / "landing", str(tmp_path / "out")
    folder.mkdir()
    (folder / "stock.csv").write_text("k,extra\n07,x\n08,y\n")
    (folder / "empty.csv").write_text("")
    rules = spark.createDataFrame([("stock", "k", "s"), (None, "k", "s")], RULES)
    outcome = tm.run(
        spark, str(folder), ["stock", "empty"], rules, out, schemas={"stock": "k string", "empty": "k string"}
    ).collect()
    assert [(r["interface"], r["status"]) for r in outcome] == [("stock", "Success"), ("empty", "Success"), (None, "Rejected")]
    profile = spark.read.option("header", True).csv(files.profile_path(out, "stock"))
    assert {r["instance"] for r in profile.collect()} == {"*", "k"}
    assert [files.format_of(f"x/orders{e}") for e in (".gz", ".csv.gz", "", ".json.zst", ".orc")] == ["csv", "csv", "parquet", "json", "orc"]


def test_a_wide_csv_file_is_parsed_once(spark, tmp_path, monkeypatch):
    folder, out = tmp_path / "landing", str(tmp_path / "out")
    folder.mkdir()
    names = [f"c{i}" for i in range(120)]
    (folder / "wide.csv").write_text(",".join(names) + "\n" + "\n".join(",".join(str(i * j) for j in range(120)) for i in range(5)))
    plans = []
    compute = job.compute

    def watched(df, requests):
        table, problems = compute(df, requests)
        plans.append(table._jdf.queryExecution().optimizedPlan().toString())
        return table, problems

    monkeypatch.setattr(job, "compute", watched)
    outcome = tm.run(spark, str(folder), ["wide"], spark.createDataFrame([], RULES), out, schemas={"wide": ", ".join(f"{n} int" for n in names)})
    assert outcome.first()["status"] == "Success", outcome.first()["message"]
    assert len(plans) == 1 and "csv" not in plans[0].lower() and "parquet" in plans[0]
    profile = spark.read.option("header", True).csv(files.profile_path(out, "wide"))
    assert profile.where("name = 'Maximum' AND instance = 'c119'").first()["value"] == "476.0"
