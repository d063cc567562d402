"""Metrics that need the frequency of every value of a column.

All columns of a table are counted in one scan and one shuffle: an UNPIVOT turns each row
into one (column number, key) row per column, and the count over those is combined before
the shuffle, so a value that fills a third of the table leaves each task as one row.  Keys
keep their type, in one slot per key type, so a row is equally narrow for 5 or 50 columns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import columns as C
from tidemark.operators.scan import COLUMNS, Request, Scan, Unavailable, ratio

# Columns counted together; each batch reads only its own columns.
COLUMNS_PER_SHUFFLE = 50

# -sum(n/N ln(n/N)), N counting nulls too, from the sums of n and of n ln n.
_ENTROPY = ratio("filled * ln(total) - n_log_n", "total")

# The frequency metrics, all read off one frequency table.
METRICS = {
    "Distinctness": ratio("distinct_values", "total"),
    "Uniqueness": ratio("once", "total"),
    "UniqueValueRatio": ratio("once", "distinct_values"),
    # a column of one value may come out as a tiny negative number
    "Entropy": f"if(filled > 0, greatest({_ENTROPY}, 0.0d), NULL)",
    "CountDistinct": "CAST(distinct_values AS double)",
}


def frequency_metrics(
    df: DataFrame, requests: Iterable[Request]
) -> tuple[list[DataFrame], dict[Request, str]]:
    """Long metrics for the requested columns, and why a request has none."""
    problems: dict[Request, str] = {}
    wanted: dict[str, tuple[str, str]] = {}
    scan = Scan(df)
    for request in dict.fromkeys(requests):
        try:
            wanted[request.column] = C.frequency_key(*scan.atomic(request.column))
        except Unavailable as reason:
            problems[request] = str(reason)
    names = list(wanted)
    frames = []
    for start in range(0, len(names), COLUMNS_PER_SHUFFLE):
        batch = names[start : start + COLUMNS_PER_SHUFFLE]
        frames.append(_metrics_of(_frequencies(df, [wanted[name] for name in batch]), batch))
    return frames, problems


def _frequencies(df: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """(column_no, present, n): one row per column and value, with its number of rows.

    The nulls of a column are one row with present = false.
    """
    types = sorted({key_type for key_type, _ in keys})
    slots = {key_type: f"slot{i}" for i, key_type in enumerate(types)}
    narrow = df.selectExpr(
        *[f"{key} AS key{i}" for i, (_, key) in enumerate(keys)],
        *[f"CAST(NULL AS {key_type}) AS no_{slot}" for key_type, slot in slots.items()],
    )
    sets = []
    for i, (key_type, _) in enumerate(keys):
        cells = [f"key{i}" if t == key_type else f"no_{slot}" for t, slot in slots.items()]
        sets.append(f"({', '.join(cells)}) AS `{i}`")
    names = ", ".join(slots.values())
    filled = " OR ".join(f"{slot} IS NOT NULL" for slot in slots.values())
    return df.sparkSession.sql(
        f"SELECT column_no, {filled} AS present, count(1) AS n FROM {{narrow}} "
        f"UNPIVOT INCLUDE NULLS (({names}) FOR column_no IN ({', '.join(sets)})) "
        f"GROUP BY column_no, {names}",
        narrow=narrow,
    )


def _metrics_of(frequencies: DataFrame, names: list[str]) -> DataFrame:
    stats = frequencies.groupBy("column_no").agg(
        F.expr("sum(n)").alias("total"),
        F.expr("sum(n) FILTER (WHERE present)").alias("filled"),
        F.expr("count_if(present)").alias("distinct_values"),
        F.expr("count_if(present AND n = 1)").alias("once"),
        F.expr("sum(n * ln(n)) FILTER (WHERE present)").alias("n_log_n"),
    )
    all_names = f"array({', '.join(C.text(name) for name in names)})"
    name = f"get({all_names}, CAST(column_no AS int))"
    rows = [
        f"struct('{metric}', {name}, '', 'Column', {name}, '{metric}', {value}, 0L, 0.0d)"
        for metric, value in METRICS.items()
    ]
    return stats.selectExpr(f"inline(array({', '.join(rows)}))").toDF(*COLUMNS)


def histogram(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(value, n, ratio) of a column, nulls as a null value; the `top` most frequent if given.

    Values are counted by their frequency keys, so a long text is compared by its digest and
    travels once for each task that has it.  The total is a count of its own, which reads no
    column of a columnar table.
    """
    value, dtype = Scan(df).column(column)
    key = value if C.is_nested(dtype) else C.frequency_key(value, dtype)[1]
    bins = df.groupBy(F.expr(key).alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.any_value(F.expr(value)).alias("value")
    ).select("value", "n")
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    bins = bins.withColumn("ratio", F.col("n") / total.cast("double"))
    return bins if top is None else bins.orderBy(F.desc("n"), F.asc("value")).limit(top)
