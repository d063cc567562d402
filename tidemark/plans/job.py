"""Profile and verification of every landed file."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.operators.constraints import RESULT_COLUMNS, RESULT_SCHEMA, evaluate
from tidemark.operators.rules import active_rules, collect_rules, rejected_rules, rules_for, unpivot_rules
from tidemark.plans.metrics import compute
from tidemark.plans.profile import profile_requests, profile_rows
from tidemark.plans.verify import local_rules, read_rules_of, requests_of
from tidemark.sources import files
from tidemark.sources.folders import kept, shared_folder

OUTCOME_COLUMNS = ("interface", "status", "message", "profile", "verification")
_OUTCOME_SCHEMA = pa.schema([(name, pa.string()) for name in OUTCOME_COLUMNS])


def run(
    spark: SparkSession,
    landing: str,
    interfaces: Sequence[str],
    rules: DataFrame,
    out: str,
    *,
    tables: Mapping[str, str] | None = None,
    schemas: Mapping[str, T.StructType | str] | None = None,
    read: Callable[[SparkSession, str, list[str]], DataFrame] | None = None,
    pattern: str = r"^([^.]+)",
    concurrency: int = 4,
) -> DataFrame:
    """Writes `<out>/<interface>.profile.csv` and `.verification.csv` per landed file.

    Returns one row per requested interface.  An interface that fails, or of which nothing
    landed, is reported and the others continue; both results of an interface are replaced
    together or not at all.  Interfaces are independent jobs, a few of them at a time, so that
    small ones do not leave a cluster idle.  A rule without a table or a field, which belongs to
    no interface, is reported as a row of its own with the status Rejected.

    `tables` names the catalog table an interface takes its schema from, `schemas` its schema where
    there is no such table; `read` replaces the reader altogether; `pattern` finds the interface
    in the name of a landed file.  All files landed for an interface are one table.  CSV and JSON
    files are read once, into a columnar copy in the shared folder that is deleted afterwards;
    however many columns there are, each further scan then reads its own ones only.
    """
    tables, schemas = tables or {}, schemas or {}
    read = read or (
        lambda spark, interface, paths: files.read_interface(
            spark, paths, table=tables.get(interface), schema=schemas.get(interface)
        )
    )
    shared_folder(spark)
    landed: dict[str, list[str]] = {}
    for row in files.landed_files(spark, landing, interfaces, pattern).collect():
        landed.setdefault(row["interface"], []).append(row["path"])

    def one(interface: str) -> tuple:
        targets = files.profile_path(out, interface), files.verification_path(out, interface)
        try:
            if interface not in landed:
                raise FileNotFoundError(f"nothing landed for {interface}")
            paths = sorted(landed[interface])
            df = read(spark, interface, paths)
            # A file of rows is read whole by each scan: it is read once, into a columnar copy.
            by_rows = any(files.format_of(path) in files.ROW_FORMATS for path in paths)
            with kept(df) if by_rows else nullcontext(df) as table:
                _process(table, read_rules_of(rules_for(rules, interface)), *targets)
        except Exception as error:  # one interface must not stop the others
            return interface, "Failure", _first_line(error), None, None
        return interface, "Success", "", *targets

    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        outcomes = list(pool.map(one, dict.fromkeys(interfaces)))
    outcomes += _rejections(rules)
    if not outcomes:
        return spark.createDataFrame(_OUTCOME_SCHEMA.empty_table())
    columns = {name: list(cells) for name, cells in zip(OUTCOME_COLUMNS, zip(*outcomes))}
    return spark.createDataFrame(pa.table(columns, schema=_OUTCOME_SCHEMA))


def _first_line(error: Exception) -> str:
    return str(error).split("\n")[0]


def _rejections(rules: DataFrame) -> list[tuple]:
    """An outcome for each rule that belongs to no table or no field."""
    found = collect_rules(active_rules(unpivot_rules(rejected_rules(rules))))
    return [
        (row["source"], "Rejected", f"rule {row['rule']} of field {row['field']} has no table or no field", None, None)
        for row in found
    ]


def _process(df: DataFrame, rules: list, profile_target: str, verification_target: str) -> None:
    """Computes what profile and rules need together, once, and publishes both results."""
    spark = df.sparkSession
    wanted = profile_requests(df.schema)
    table, problems = compute(df, [*wanted, *requests_of(rules)])
    folder = f"{profile_target.rsplit('/', 1)[0]}/_aside-{uuid.uuid4().hex}"
    aside = {f"{folder}/profile.csv": profile_target, f"{folder}/verification.csv": verification_target}
    profile_aside, verification_aside = aside
    try:
        with kept(table) as metrics:  # a row for each metric, read by both writes
            files.write_single_csv(profile_rows(metrics, wanted), profile_aside, "entity", "instance", "name")
            if rules:
                judged = evaluate(local_rules(spark, rules, problems), metrics)
                results = judged.select(*RESULT_COLUMNS)
            else:
                results = spark.createDataFrame([], RESULT_SCHEMA)
            files.write_single_csv(results, verification_aside, "source", "field", "rule")
        files.publish(spark, aside)
    finally:
        files.delete(spark, folder)
