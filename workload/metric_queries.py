"""One query per metric of the profile and of the constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

import tidemark as tm
from tidemark import Request
from tidemark.functions import patterns
from tidemark.plans.metrics import compute
from workload.common import derived, metric_sql, rounded, rows_sql, table

QUERIES = {}
ORACLE = {}


def _register(name: str, source: str, replace: dict[str, str], wanted: list[tuple[str, str]]):
    """A query for exact metrics that are one scalar query each."""
    requests = [Request(metric, column) for metric, column in wanted]

    def query(spark, sf_dir) -> DataFrame:
        return rounded(tm.metrics(derived(spark, sf_dir, source, replace), requests))

    QUERIES[name] = query
    ORACLE[name] = rows_sql(
        source, replace, [(column, metric, metric_sql(metric, column)) for metric, column in wanted]
    )


_NULLED_PRIORITY = {"o_orderpriority": "nullif(o_orderpriority, '5-LOW')"}
_NULLED_NAME = {"p_name": "nullif(p_name, 'small ring')"}
_KEYS = ("l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate")
_NUMBERS = ("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")

_register(
    "metric_completeness", "orders", _NULLED_PRIORITY,
    [("Completeness", c) for c in ("o_orderkey", "o_orderpriority", "o_orderdate")],
)
for _name, _metric in {
    "metric_distinctness": "Distinctness",
    "metric_uniqueness": "Uniqueness",
    "metric_unique_value_ratio": "UniqueValueRatio",
    "metric_entropy": "Entropy",
    "metric_count_distinct": "CountDistinct",
}.items():
    _register(_name, "lineitem", {}, [(_metric, c) for c in _KEYS])
    _register(_name + "_with_nulls", "part", _NULLED_NAME,
              [(_metric, c) for c in ("p_name", "p_brand", "p_retailprice")])
_register(
    "metric_min_max_mean_sum", "lineitem", {},
    [(m, c) for m in ("Minimum", "Maximum", "Mean", "Sum") for c in _NUMBERS],
)
_register("metric_stddev", "lineitem", {}, [("StandardDeviation", c) for c in _NUMBERS])
_register("metric_lengths", "documents", {},
          [(m, c) for m in ("MinLength", "MaxLength") for c in ("text", "lang", "source")])
_register("metric_lengths_customer", "customer", {},
          [(m, c) for m in ("MinLength", "MaxLength") for c in ("c_name", "c_mktsegment")])
# whole documents as keys: long texts are counted by digest
_register("metric_uniqueness_long_text", "documents", {},
          [(m, "text") for m in ("Uniqueness", "Distinctness", "Entropy", "CountDistinct")])


def _size(spark, sf_dir):
    return tm.metrics(table(spark, sf_dir, "orders"), [Request("Size", "*")]).select(
        "entity", "instance", "name", "value"
    )


QUERIES["metric_size"] = _size
ORACLE["metric_size"] = (
    "SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name, count(*)::double AS value"
    " FROM orders"
)


def _correlation(spark, sf_dir):
    pairs = [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax"), ("l_orderkey", "l_orderkey")]
    return rounded(
        tm.metrics(table(spark, sf_dir, "lineitem"), [Request("Correlation", a, b) for a, b in pairs])
    )


QUERIES["metric_correlation"] = _correlation
ORACLE["metric_correlation"] = rows_sql(
    "lineitem", {},
    [
        (f"{a},{b}", "Correlation", f"SELECT corr({a}::double, {b}::double) FROM t")
        for a, b in (("l_quantity", "l_extendedprice"), ("l_discount", "l_tax"), ("l_orderkey", "l_orderkey"))
    ],
)

_FORMATS = {
    "email": patterns.EMAIL,
    "url": patterns.URL,
    "ssn": patterns.SOCIAL_SECURITY_NUMBER,
    "card": patterns.CREDIT_CARD,
}


def _pattern_fraction(source: str, column: str):
    def query(spark, sf_dir):
        requests = [Request("PatternMatch", column, p) for p in _FORMATS.values()]
        found, _ = compute(table(spark, sf_dir, source), requests)
        label = " ".join(f"WHEN '{_sql(p)}' THEN '{n}'" for n, p in _FORMATS.items())
        return found.selectExpr(f"CASE params {label} END AS format", "round(value, 6) AS value")

    sql = " UNION ALL ".join(
        f"SELECT '{n}' AS format, round(count(*) FILTER (WHERE regexp_matches({column}, '{p}'))"
        f"::double / count(*), 6) AS value FROM {source}"
        for n, p in _FORMATS.items()
    )
    return query, sql


def _sql(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


for _source, _column in (("documents", "text"), ("pages", "url"), ("pages", "html"), ("conversations", "text")):
    _name = f"metric_pattern_fraction_{_source}_{_column}"
    QUERIES[_name], ORACLE[_name] = _pattern_fraction(_source, _column)

_COMPLIANCE = [
    ("NonNegative", "l_tax", "", "l_tax >= 0"),
    ("Positive", "l_discount", "", "l_discount > 0"),
    ("LessThan", "l_tax", "l_discount", "l_tax < l_discount"),
    ("LessThanOrEqualTo", "l_tax", "l_discount", "l_tax <= l_discount"),
    ("GreaterThan", "l_tax", "l_discount", "l_tax > l_discount"),
    ("GreaterThanOrEqualTo", "l_tax", "l_discount", "l_tax >= l_discount"),
    ("ContainedIn", "l_returnflag", "A, R", "l_returnflag IS NULL OR l_returnflag IN ('A', 'R')"),
    ("Satisfies", "l_shipdate", "l_quantity * l_discount > 1", "l_quantity * l_discount > 1"),
]


def _compliance(spark, sf_dir):
    found, _ = compute(
        table(spark, sf_dir, "lineitem"), [Request(m, c, p) for m, c, p, _ in _COMPLIANCE]
    )
    return found.selectExpr("metric", "instance", "round(value, 6) AS value")


QUERIES["metric_compliance"] = _compliance
ORACLE["metric_compliance"] = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, '{c}' AS instance,"
    f" round(count(*) FILTER (WHERE {holds})::double / count(*), 6) AS value FROM lineitem"
    for m, c, _, holds in _COMPLIANCE
)


def _approx_count_distinct(spark, sf_dir):
    """The exact number of distinct values, and that the sketch is within 10 % of it."""
    df = table(spark, sf_dir, "lineitem")
    requests = [Request(m, c) for m in ("ApproxCountDistinct", "CountDistinct") for c in _KEYS]
    found = tm.metrics(df, requests)
    return found.groupBy("instance").agg(
        F.expr("max(value) FILTER (WHERE name = 'CountDistinct')").alias("exact"),
        F.expr(
            "abs(max(value) FILTER (WHERE name = 'ApproxCountDistinct')"
            " / max(value) FILTER (WHERE name = 'CountDistinct') - 1) <= 0.1"
        ).alias("within"),
    )


QUERIES["metric_approx_count_distinct"] = _approx_count_distinct
ORACLE["metric_approx_count_distinct"] = " UNION ALL ".join(
    f"SELECT '{c}' AS instance, count(DISTINCT {c})::double AS exact, true AS within FROM lineitem"
    for c in _KEYS
)

_QUANTILES = (0.1, 0.5, 0.9)


def _approx_quantiles(spark, sf_dir):
    """That each quantile sketch answers with a value whose rank is off by at most 2 %."""
    df = table(spark, sf_dir, "lineitem")
    found = tm.metrics(
        df,
        [Request("ApproxQuantiles", c) for c in _NUMBERS]
        + [Request("ApproxQuantile", c, "0.5") for c in _NUMBERS],
    )
    names = [f"ApproxQuantiles-{q}" for q in _QUANTILES] + ["ApproxQuantile-0.5"]
    checks = [(c, name, float(name.split("-")[1])) for c in _NUMBERS for name in names]
    fields = ", ".join(
        f"max(value) FILTER (WHERE instance = '{c}' AND name = '{name}') AS q{i}"
        for i, (c, name, _) in enumerate(checks)
    )
    answers = found.agg(F.expr(f"struct({fields})").alias("answers")).scalar()
    ranks = df.select(*_NUMBERS, answers.alias("a")).selectExpr(
        *[
            f"count_if({c} < a.q{i}) / count(1) - 0.02 <= {q}"
            f" AND count_if({c} <= a.q{i}) / count(1) + 0.02 >= {q} AS r{i}"
            for i, (c, name, q) in enumerate(checks)
        ]
    )
    rows = ", ".join(
        f"struct('{c}' AS instance, '{name}' AS name, r{i} AS within)"
        for i, (c, name, _) in enumerate(checks)
    )
    return ranks.selectExpr(f"inline(array({rows}))")


QUERIES["metric_approx_quantiles"] = _approx_quantiles
ORACLE["metric_approx_quantiles"] = " UNION ALL ".join(
    f"SELECT '{c}' AS instance, '{name}' AS name, count(*) > 0 AS within FROM lineitem"
    for c in _NUMBERS
    for name in [f"ApproxQuantiles-{q}" for q in _QUANTILES] + ["ApproxQuantile-0.5"]
)

# numbers rendered as text, some of them replaced by other literals or null
_TEXTS = {
    "o_orderkey": "CASE WHEN o_orderkey % 7 = 0 THEN 'abc' ELSE CAST(o_orderkey AS varchar(20)) END",
    "o_custkey": "CAST(o_custkey AS varchar(20))",
    "o_totalprice": "CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS varchar(20))"
    " ELSE CAST(CAST(o_totalprice AS decimal(12,2)) AS varchar(20)) END",
    "o_orderpriority": "CASE WHEN o_orderkey % 2 = 0 THEN 'true' WHEN o_orderkey % 3 = 0"
    " THEN NULL ELSE 'false' END",
    "o_orderstatus": "CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE '-7' END",
}
_TYPE_TESTS = {
    "Unknown": "{c} IS NULL",
    "Integral": "regexp_matches({c}, '^[-+]?\\d+\\z')",
    "Fractional": "regexp_matches({c}, '^[-+]?(\\d+\\.\\d*|\\.\\d+)\\z')",
    "Boolean": "{c} IN ('true', 'false')",
}
_TYPE_TESTS["String"] = "NOT coalesce(" + " OR ".join(_TYPE_TESTS.values()) + ", true)"


def type_rows(column: str) -> list[tuple[str, str, str]]:
    rows = [(column, "Histogram.bins", "SELECT 5.0::double")]
    for value_type, test in _TYPE_TESTS.items():
        test = test.replace("{c}", column)
        rows.append((column, f"Histogram.abs.{value_type}",
                     f"SELECT count(*) FILTER (WHERE {test})::double FROM t"))
        rows.append((column, f"Histogram.ratio.{value_type}",
                     f"SELECT count(*) FILTER (WHERE {test})::double / count(*) FROM t"))
    return rows


def _datatype_histogram(spark, sf_dir):
    df = derived(spark, sf_dir, "orders", _TEXTS)
    return rounded(tm.metrics(df, [Request("DataType", c) for c in _TEXTS]))


QUERIES["metric_datatype_histogram"] = _datatype_histogram
ORACLE["metric_datatype_histogram"] = rows_sql(
    "orders", _TEXTS, [row for c in _TEXTS for row in type_rows(c)]
)


def _text_numbers(spark, sf_dir):
    """Numeric metrics of text: present for columns of numbers, absent for mixed ones."""
    df = derived(spark, sf_dir, "orders", _TEXTS)
    wanted = ("Minimum", "Maximum", "Mean", "Sum", "StandardDeviation")
    return rounded(tm.metrics(df, [Request(m, c) for m in wanted for c in _TEXTS]))


QUERIES["metric_numbers_in_text"] = _text_numbers
ORACLE["metric_numbers_in_text"] = rows_sql(
    "orders", _TEXTS,
    [(c, m, metric_sql(m, c)) for m in ("Minimum", "Maximum", "Mean", "Sum", "StandardDeviation")
     for c in ("o_custkey", "o_totalprice")],
)


def _column_profiles(spark, sf_dir):
    found = tm.column_profiles(derived(spark, sf_dir, "orders", _TEXTS))
    return found.selectExpr("column", "round(completeness, 6) AS completeness", "data_type")


QUERIES["column_profiles"] = _column_profiles
ORACLE["column_profiles"] = f"WITH t AS (SELECT * REPLACE ({', '.join(f'{s} AS {c}' for c, s in _TEXTS.items())}) FROM orders) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(count({c})::double / count(*), 6) AS completeness,"
    f" '{t}' AS data_type FROM t"
    for c, t in {
        "o_orderkey": "String", "o_custkey": "Integral", "o_orderstatus": "String",
        "o_totalprice": "Fractional", "o_orderdate": "String", "o_orderpriority": "Boolean",
    }.items()
)


def _histogram(spark, sf_dir):
    df = derived(spark, sf_dir, "orders", _NULLED_PRIORITY)
    return tm.histogram(df, "o_orderpriority").selectExpr("value", "n", "round(ratio, 6) AS ratio")


QUERIES["metric_histogram"] = _histogram
ORACLE["metric_histogram"] = (
    "SELECT nullif(o_orderpriority, '5-LOW') AS value, count(*) AS n,"
    " round(count(*)::double / (SELECT count(*) FROM orders), 6) AS ratio FROM orders GROUP BY 1"
)


def _histogram_top(spark, sf_dir):
    found = tm.histogram(table(spark, sf_dir, "lineitem"), "l_partkey", top=20)
    return found.selectExpr("value", "n", "round(ratio, 8) AS ratio")


QUERIES["metric_histogram_top"] = _histogram_top
ORACLE["metric_histogram_top"] = (
    "SELECT l_partkey AS value, count(*) AS n,"
    " round(count(*)::double / (SELECT count(*) FROM lineitem), 8) AS ratio"
    " FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 20"
)


def _histogram_long_text(spark, sf_dir):
    """Repeated documents, which are counted by their digests."""
    bins = tm.histogram(table(spark, sf_dir, "documents"), "text").where("n > 1")
    return bins.selectExpr("md5(CAST(value AS binary)) AS digest", "n", "round(ratio, 8) AS ratio")


QUERIES["metric_histogram_long_text"] = _histogram_long_text
ORACLE["metric_histogram_long_text"] = (
    "SELECT md5(text) AS digest, count(*) AS n,"
    " round(count(*)::double / (SELECT count(*) FROM documents), 8) AS ratio"
    " FROM documents GROUP BY text HAVING count(*) > 1"
)


def _column_profiles_embeddings(spark, sf_dir):
    found = tm.column_profiles(table(spark, sf_dir, "embeddings"))
    return found.selectExpr("column", "completeness", "data_type", "approx_distinct IS NULL AS nested")


QUERIES["column_profiles_embeddings"] = _column_profiles_embeddings
ORACLE["column_profiles_embeddings"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c})::double / count(*) AS completeness,"
    f" {kind} AS data_type, {kind} IS NULL AS nested FROM embeddings"
    for c, kind in (("vec_id", "'Integral'"), ("label", "'Integral'"), ("embedding", "CAST(NULL AS varchar)"))
)

# Texts that are equal under their collation, in another case or with blanks at the end, and the
# binary texts that stand for them.
_COLLATED = {
    "lcase": "if(c_custkey % 2 = 0, upper(c_mktsegment), lower(c_mktsegment)) COLLATE UTF8_LCASE",
    "unicode_ci": "if(c_custkey % 2 = 0, upper(c_mktsegment), lower(c_mktsegment)) COLLATE UNICODE_CI",
    "padded": "concat(c_name, repeat(' ', CAST(c_custkey % 3 AS int))) COLLATE UTF8_BINARY_RTRIM",
    "number": "CAST(c_nationkey AS string) COLLATE UNICODE_CI",
}
_STAND_INS = {"lcase": "lower(c_mktsegment)", "unicode_ci": "lower(c_mktsegment)", "padded": "c_name",
              "number": "CAST(c_nationkey AS varchar)"}


def _collated(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*[f"{sql} AS {name}" for name, sql in _COLLATED.items()])


def _profile_collated(spark, sf_dir):
    return rounded(tm.profile(_collated(spark, sf_dir)))


def _count_distinct_collated(spark, sf_dir):
    """Exact counts by collation, and that the sketch heeds it too."""
    requests = [Request(m, c) for m in ("ApproxCountDistinct", "CountDistinct") for c in _COLLATED]
    found = tm.metrics(_collated(spark, sf_dir), requests)
    exact, estimate = (f"max(value) FILTER (WHERE name = '{n}')" for n in ("CountDistinct", "ApproxCountDistinct"))
    return found.groupBy("instance").agg(
        F.expr(exact).alias("exact"), F.expr(f"abs({estimate} / {exact} - 1) <= 0.1").alias("within")
    )


_STAND_IN_SQL = f"SELECT {', '.join(f'{sql} AS {name}' for name, sql in _STAND_INS.items())} FROM customer"
QUERIES["profile_collated"] = _profile_collated
ORACLE["profile_collated"] = rows_sql("customer", {}, [
    ("*", "Size", "SELECT count(*)::double FROM t"),
    *[
        (c, m, metric_sql(m, c))
        for c in _COLLATED for m in ("Completeness", "Distinctness", "Entropy", "Uniqueness", "UniqueValueRatio")
    ],
    *[row for c in _COLLATED for row in type_rows(c)],
    *[("number", m, metric_sql(m, "number")) for m in ("Minimum", "Maximum", "Mean", "Sum")],
]).replace("SELECT * FROM customer", _STAND_IN_SQL)
QUERIES["metric_count_distinct_collated"] = _count_distinct_collated
ORACLE["metric_count_distinct_collated"] = f"WITH t AS ({_STAND_IN_SQL}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS instance, count(DISTINCT {c})::double AS exact, true AS within FROM t" for c in _COLLATED
)
