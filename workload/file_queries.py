"""Rule files, landed files and the job over all landed files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

import tidemark as tm
from tidemark.sources.folders import shared_folder
from workload.common import ROUNDED, metric_sql, rounded, rows_sql, table
from workload.profile_queries import ORACLE as PROFILE_ORACLE
from workload.verify_queries import CASES, Case, rule_table

QUERIES = {}
ORACLE = {}

# A wide rule table derived from the orders: one rule row per order, every kind of cell.
_CELLS = {
    "isComplete": "CASE o_orderstatus WHEN 'F' THEN 's' WHEN 'O' THEN ' S ' ELSE 'n' END",
    "hasCompleteness": "CASE WHEN o_orderkey % 3 = 0 THEN ' 0.5 ' WHEN o_orderkey % 3 = 1"
    " THEN 'abc' ELSE NULL END",
    "hasMin": "CAST(o_custkey AS varchar(20))",
    "hasApproxQuantile": "CASE WHEN o_orderkey % 2 = 0 THEN '0.25=7' WHEN o_orderkey % 5 = 0"
    " THEN '2=7' ELSE '9' END",
    "hasHistogramValues": "concat(o_orderpriority, '=0.25')",
    "isContainedIn": "concat(' ', o_orderstatus, ' , ', o_orderpriority)",
    "isLessThan": "concat(' ', o_orderpriority)",
    "hasDataType": "CASE WHEN o_orderstatus = 'P' THEN 'integral' ELSE 'Colour' END",
    "isUnheardOf": "nullif(o_orderstatus, 'O')",
}


def _wide_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderstatus AS source",
        "concat('f', CAST(o_orderkey AS string)) AS field",
        *[f"{sql} AS {rule}" for rule, sql in _CELLS.items()],
    )


_LONG_SQL = " UNION ALL ".join(
    f"SELECT o_orderstatus AS source, concat('f', o_orderkey) AS field, '{rule}' AS rule,"
    f" {sql} AS arg FROM orders"
    for rule, sql in _CELLS.items()
)
_LONG_SQL = f"SELECT * FROM ({_LONG_SQL}) WHERE arg IS NOT NULL"
_ACTIVE_SQL = f"SELECT * FROM ({_LONG_SQL}) WHERE rule <> 'isComplete' OR lower(trim(arg)) = 's'"


def _unpivot(spark, sf_dir):
    return tm.unpivot_rules(_wide_rules(spark, sf_dir))


def _active(spark, sf_dir):
    return tm.active_rules(tm.unpivot_rules(_wide_rules(spark, sf_dir)))


def _typed(spark, sf_dir):
    return tm.typed_rules(_active(spark, sf_dir))


def _for_source(spark, sf_dir):
    return tm.unpivot_rules(tm.rules_for(_wide_rules(spark, sf_dir), "P"))


def _rejected(spark, sf_dir):
    wide = _wide_rules(spark, sf_dir).withColumn("field", F.expr("nullif(field, concat('f', hasMin))"))
    return tm.rejected_rules(wide).select("source", "hasMin")


QUERIES["rules_unpivot"] = _unpivot
ORACLE["rules_unpivot"] = _LONG_SQL
QUERIES["rules_active"] = _active
ORACLE["rules_active"] = _ACTIVE_SQL
QUERIES["rules_for_source"] = _for_source
ORACLE["rules_for_source"] = f"SELECT * FROM ({_LONG_SQL}) WHERE source = 'P'"
QUERIES["rules_rejected"] = _rejected
ORACLE["rules_rejected"] = (
    "SELECT o_orderstatus AS source, CAST(o_custkey AS varchar) AS hasMin FROM orders"
    " WHERE o_orderkey = o_custkey"
)
QUERIES["rules_typed"] = _typed
ORACLE["rules_typed"] = f"""
SELECT source, field, rule, arg,
  CASE rule WHEN 'isComplete' THEN 'Completeness' WHEN 'hasCompleteness' THEN 'Completeness'
    WHEN 'hasMin' THEN 'Minimum' WHEN 'hasApproxQuantile' THEN 'ApproxQuantile'
    WHEN 'hasHistogramValues' THEN 'HistogramRatio' WHEN 'isContainedIn' THEN 'ContainedIn'
    WHEN 'isLessThan' THEN 'LessThan' WHEN 'hasDataType' THEN 'TypeRatio' END AS metric,
  CASE rule
    WHEN 'hasApproxQuantile' THEN CASE arg WHEN '0.25=7' THEN '0.25' WHEN '2=7' THEN '2.0' ELSE '0.5' END
    WHEN 'hasHistogramValues' THEN regexp_replace(arg, '=0.25$', '')
    WHEN 'isContainedIn' THEN concat(trim(split_part(arg, ',', 1)), ',', trim(split_part(arg, ',', 2)))
    WHEN 'isLessThan' THEN trim(arg)
    WHEN 'hasDataType' THEN CASE arg WHEN 'integral' THEN 'Integral' ELSE arg END
    ELSE '' END AS params,
  CASE rule WHEN 'isUnheardOf' THEN NULL WHEN 'hasCompleteness' THEN '>='
    WHEN 'hasApproxQuantile' THEN '>=' WHEN 'hasHistogramValues' THEN '>=' ELSE '=' END AS comparison,
  CASE rule WHEN 'hasCompleteness' THEN try_cast(trim(arg) AS double)
    WHEN 'hasMin' THEN arg::double
    WHEN 'hasApproxQuantile' THEN CASE WHEN contains(arg, '=') THEN 7 ELSE 9 END
    WHEN 'hasHistogramValues' THEN 0.25 ELSE 1 END::double AS threshold,
  CASE WHEN rule = 'isUnheardOf' THEN 'unknown rule'
    WHEN arg = 'abc' THEN 'no number in abc'
    WHEN rule = 'hasApproxQuantile' AND arg = '2=7' THEN 'no quantile in 2=7'
    WHEN arg = 'Colour' THEN 'unknown type Colour' END AS problem
FROM ({_ACTIVE_SQL})"""


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"


def _rules_roundtrip(spark, sf_dir):
    """Rules written as a `;` file, read back by name."""
    folder = _new_folder(spark)
    wide = _wide_rules(spark, sf_dir)
    wide.write.option("sep", ";").option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return tm.unpivot_rules(tm.read_rules(spark, folder))


QUERIES["csv_rules_roundtrip"] = _rules_roundtrip
ORACLE["csv_rules_roundtrip"] = _LONG_SQL


def _interface_roundtrip(spark, sf_dir):
    """Line items landed as CSV, read with a declared schema, then profiled."""
    folder = _new_folder(spark) + ".csv"
    df = table(spark, sf_dir, "lineitem")
    df.write.option("header", True).csv(folder)
    landed = tm.read_interface(spark, folder, schema=df.schema)
    wanted = [
        tm.Request(m, c) for m in ("Completeness", "Minimum", "Maximum", "Sum", "CountDistinct")
        for c in ("l_orderkey", "l_quantity", "l_discount")
    ]
    return rounded(tm.metrics(landed, wanted))


QUERIES["csv_interface_roundtrip"] = _interface_roundtrip
ORACLE["csv_interface_roundtrip"] = (
    "WITH t AS (SELECT * FROM lineitem), m AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS instance, '{m}' AS name, ({metric_sql(m, c)}) AS value"
        for m in ("Completeness", "Minimum", "Maximum", "Sum", "CountDistinct")
        for c in ("l_orderkey", "l_quantity", "l_discount")
    )
    + f") SELECT instance, name, {ROUNDED} AS value FROM m"
)


def _sink_roundtrip(spark, sf_dir):
    """A profile written as a single-part CSV, read back."""
    path = _new_folder(spark) + ".csv"
    tm.write_single_csv(rounded(tm.profile(table(spark, sf_dir, "customer"))), path, "instance", "name")
    back = spark.read.option("header", True).csv(path)
    return back.selectExpr("instance", "name", "CAST(value AS double) AS value")


QUERIES["csv_sink_roundtrip"] = _sink_roundtrip
ORACLE["csv_sink_roundtrip"] = PROFILE_ORACLE["profile_customer"]


def _run_all(spark, sf_dir):
    """The job over landed files: each interface's verdicts and size, read back from its files."""
    out = _new_folder(spark)
    rules = None
    for source, cases in _JOB_RULES.items():
        wide = rule_table(spark, source, cases)
        rules = wide if rules is None else rules.unionByName(wide, allowMissingColumns=True)
    outcome = tm.run(spark, sf_dir, [*_JOB_RULES, "nation", "absent"], rules, out)
    done = [(r["interface"], r["profile"], r["verification"])
            for r in outcome.where("status = 'Success'").collect()]
    verdicts = spark.read.option("header", True).csv([v for _, _, v in done]).selectExpr(
        "source", "rule", "field", "constraint_status AS result"
    )
    sizes = None
    for interface, profile, _ in done:
        size = spark.read.option("header", True).csv(profile).where("name = 'Size'").select(
            F.lit(interface).alias("source"), F.lit("Size").alias("rule"), F.lit("*").alias("field"),
            F.col("value").cast("double").cast("bigint").cast("string").alias("result"),
        )
        sizes = size if sizes is None else sizes.unionByName(size)
    failed = outcome.where("status <> 'Success'").select(
        F.col("interface").alias("source"), F.lit("").alias("rule"), F.lit("").alias("field"),
        F.col("status").alias("result"),
    )
    return verdicts.unionByName(sizes).unionByName(failed)


_JOB_RULES: dict[str, list[Case]] = {
    source: [
        case
        for table_name, replace, cases in CASES.values()
        if table_name == source and not replace
        for case in cases
        if case.rule not in ("isUnheardOf",)
    ]
    for source in ("lineitem", "customer", "part")
}

QUERIES["run_all_interfaces"] = _run_all
ORACLE["run_all_interfaces"] = " UNION ALL ".join(
    f"(WITH t AS (SELECT * FROM {source}) "
    + " UNION ALL ".join(
        f"SELECT '{source}' AS source, '{c.rule}' AS rule, '{c.field}' AS field,"
        f" CASE WHEN coalesce(value {c.good}, false) THEN 'Success' ELSE 'Failure' END AS result"
        f" FROM (SELECT ({c.value})::double AS value)"
        for c in cases
    )
    + ")"
    for source, cases in _JOB_RULES.items()
) + "".join(
    f" UNION ALL SELECT '{source}', 'Size', '*', count(*)::varchar FROM {source}"
    for source in (*_JOB_RULES, "nation")
) + " UNION ALL SELECT 'absent', '', '', 'Failure'"


def _catalog_schema(spark, sf_dir):
    """Orders read with the schema of a catalog table, which has two of its columns."""
    name = f"landing_orders_{uuid.uuid4().hex}"
    table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").createOrReplaceTempView(name)
    df = tm.read_interface(spark, f"{sf_dir}/orders.parquet", table=name)
    spark.catalog.dropTempView(name)
    return rounded(tm.metrics(df, [tm.Request("Mean", c) for c in df.columns]))


QUERIES["interface_schema_from_catalog"] = _catalog_schema
ORACLE["interface_schema_from_catalog"] = rows_sql(
    "orders", {}, [(c, "Mean", metric_sql("Mean", c)) for c in ("o_orderkey", "o_totalprice")]
)


def _interface_reordered(spark, sf_dir):
    """Line items landed in two CSV files whose columns stand in another order, one with a column more."""
    df = table(spark, sf_dir, "lineitem")
    first, second = _new_folder(spark) + ".csv", _new_folder(spark) + ".csv"
    df.where("l_linenumber < 4").select(*reversed(df.columns)).write.option("header", True).csv(first)
    df.where("l_linenumber >= 4").select(F.lit("x").alias("extra"), *df.columns).write.option("header", True).csv(second)
    landed = tm.read_interface(spark, [first, second], schema=df.schema)
    wanted = [
        tm.Request(m, c) for m in ("Completeness", "Minimum", "Maximum", "Sum", "CountDistinct")
        for c in ("l_orderkey", "l_quantity", "l_discount")
    ]
    return rounded(tm.metrics(landed, wanted))


QUERIES["csv_interface_reordered"] = _interface_reordered
ORACLE["csv_interface_reordered"] = ORACLE["csv_interface_roundtrip"]


def _run_rejected(spark, sf_dir):
    """Rules without a table or a field beside one that holds: each has an outcome."""
    cells = [("nation", "n_name", "s"), (None, "n_name", "s"), (" ", "n_nationkey", "s"), ("nation", None, "s"), (None, None, None)]
    rules = spark.createDataFrame(cells, "source string, field string, isComplete string")
    outcome = tm.run(spark, sf_dir, ["nation"], rules, _new_folder(spark))
    size = table(spark, sf_dir, "nation").agg(F.count("*")).scalar()
    return outcome.select("interface", "status", "message", F.when(F.col("status") == "Success", size).alias("n"))


QUERIES["run_rejected_rules"] = _run_rejected
ORACLE["run_rejected_rules"] = (
    "SELECT 'nation' AS interface, 'Success' AS status, '' AS message, count(*) AS n FROM nation UNION ALL"
    " SELECT * FROM (VALUES"
    " (NULL, 'Rejected', 'rule isComplete of field n_name has no table or no field', NULL),"
    " (' ', 'Rejected', 'rule isComplete of field n_nationkey has no table or no field', NULL),"
    " ('nation', 'Rejected', 'rule isComplete of field None has no table or no field', NULL))"
)
