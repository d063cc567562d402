"""The profile of every table, compared on its exact metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

import tidemark as tm
from workload.common import metric_sql, rounded, rows_sql, table
from workload.metric_queries import type_rows

# Columns of each table by value type.
TABLES = {
    "region": {"Integral": ["r_regionkey"], "text": ["r_name"]},
    "nation": {"Integral": ["n_nationkey", "n_regionkey"], "text": ["n_name"]},
    "customer": {
        "Integral": ["c_custkey", "c_nationkey"],
        "Fractional": ["c_acctbal"],
        "text": ["c_name", "c_mktsegment"],
    },
    "supplier": {
        "Integral": ["s_suppkey", "s_nationkey"], "Fractional": ["s_acctbal"], "text": ["s_name"],
    },
    "part": {
        "Integral": ["p_partkey", "p_size"],
        "Fractional": ["p_retailprice"],
        "text": ["p_name", "p_brand", "p_type"],
    },
    "orders": {
        "Integral": ["o_orderkey", "o_custkey"],
        "Fractional": ["o_totalprice"],
        "text": ["o_orderstatus", "o_orderpriority"],
        "time": ["o_orderdate"],
    },
    "lineitem": {
        "Integral": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
        "Fractional": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        "text": ["l_returnflag", "l_linestatus"],
        "time": ["l_shipdate"],
    },
    "events": {
        "Integral": ["event_id", "user_id"],
        "Fractional": ["value"],
        "text": ["event_type", "props"],
        "time": ["ts"],
    },
    "documents": {"Integral": ["doc_id", "n_chars"], "text": ["text", "lang", "source"]},
    "embeddings": {"Integral": ["vec_id", "label"], "nested": ["embedding"]},
    "pages": {"Integral": ["page_id"], "text": ["url", "html"]},
    "benchmark": {"Integral": ["item_id"], "text": ["text"]},
    "labels": {"Integral": ["doc_id", "quality", "toxic"]},
    "conversations": {"Integral": ["conv_id", "turn"], "text": ["role", "text"]},
}

_FREQUENCY = ("Distinctness", "Entropy", "Uniqueness", "UniqueValueRatio")
_NUMERIC = ("Maximum", "Minimum", "Mean", "Sum")


def _rows(kind: str, column: str) -> list[tuple[str, str, str]]:
    rows = [(column, "Completeness", metric_sql("Completeness", column))]
    if kind == "nested":
        return rows
    rows += [(column, m, metric_sql(m, column)) for m in _FREQUENCY]
    if kind in ("Integral", "Fractional"):
        rows += [(column, m, metric_sql(m, column)) for m in _NUMERIC]
    if kind == "text":
        return rows + type_rows(column)
    declared = "String" if kind == "time" else kind
    rows.append((column, "Histogram.bins", "SELECT 5.0::double"))
    for value_type in ("Unknown", "Fractional", "Integral", "Boolean", "String"):
        count = {"Unknown": f"count(*) - count({column})", declared: f"count({column})"}.get(
            value_type, "0 * count(*)"
        )
        rows.append((column, f"Histogram.abs.{value_type}", f"SELECT ({count})::double FROM t"))
        rows.append(
            (column, f"Histogram.ratio.{value_type}", f"SELECT ({count})::double / count(*) FROM t")
        )
    return rows


def _profile(name: str):
    def query(spark, sf_dir) -> DataFrame:
        return rounded(tm.profile(table(spark, sf_dir, name)))

    return query


def _estimated(spark, sf_dir) -> DataFrame:
    """The profile without value frequencies; its distinctness is within 10 % of the exact one."""
    df = table(spark, sf_dir, "lineitem")
    estimated = tm.profile(df, exact=False)
    exact = tm.metrics(df, [tm.Request("Distinctness", c) for c in df.columns])
    both = estimated.unionByName(exact).where("name LIKE '%istinctness'")
    return both.groupBy("instance").agg(
        F.expr("count(1)").alias("n"),
        F.expr("max(value) / min(value) <= 1.1").alias("within"),
    )


QUERIES = {f"profile_{name}": _profile(name) for name in TABLES}
ORACLE = {
    f"profile_{name}": rows_sql(
        name,
        {},
        [("*", "Size", "SELECT count(*)::double FROM t")]
        + [row for kind, columns in kinds.items() for c in columns for row in _rows(kind, c)],
    )
    for name, kinds in TABLES.items()
}

QUERIES["profile_estimated"] = _estimated
ORACLE["profile_estimated"] = " UNION ALL ".join(
    f"SELECT '{c}' AS instance, 2::bigint AS n, count(*) > 0 AS within FROM lineitem"
    for columns in TABLES["lineitem"].values()
    for c in columns
)
