"""Metrics that need one look at each row: counts, extremes, moments, sketches, predicates.

All metrics of a table share one scan.  Each metric is a set of *mergeable* partial
aggregates, deduplicated by key, so the scan is aggregated as a tree: each input partition becomes
one row, MERGE_WIDTH neighbouring ones fold into the next, in as many levels as the number of
partitions needs.  No task ever merges the sketches of more than a bounded number, and as rows
fold in the order of their values or by sums without rounding, two runs over the same partitions
give the same bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal, InvalidOperation
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions import columns as C, patterns

# Partial results that one task merges, and the most levels of such merges before the last one.
MERGE_WIDTH, MAX_LEVELS = 64, 4
# Columns looked at per scan: expression lists stay within what one task can generate, and
# a columnar source is still read once in all, since batches share no columns.
COLUMNS_PER_SCAN = 100
# Distinct-count sketch with 2^12 registers: about 1.6 % standard error.
DISTINCT_SKETCH_LOG2_K = 12
# A quantile summary is so many values, each of which stands for as many rows; a power of two, so
# that shares of rows are exact.  A partition is summarised with an error in rank of half a value's
# share and 1 / QUANTILE_ACCURACY of its rows, and each merge adds half a share: for up to 64
# partitions no more than QUANTILE_POINTS and for up to 4,096 half as much again, in shares,
# 0.21 % and 0.3 %.
QUANTILE_POINTS, QUANTILE_ACCURACY = 512, 10_000

# The quantiles a profile reports.
PROFILE_QUANTILES = (0.1, 0.5, 0.9)


class Request(NamedTuple):
    """One metric wanted: what, of which column, with which parameter ("" if none)."""

    metric: str
    column: str
    params: str = ""


class Unavailable(Exception):
    """The metric cannot be computed for this column; the text says why."""


class Scan:
    """Collects the partial aggregates that the metrics of one scan need."""

    def __init__(self, df: DataFrame, checked: dict[str, bool] | None = None):
        self.df = df
        self._checked = {} if checked is None else checked
        self._types = {f.name: f.dataType for f in df.schema.fields}
        self._folded = {f.name.lower(): f.name for f in df.schema.fields}
        self._case = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
        self._kept: dict[tuple, tuple[str, str, str]] = {}
        self._value_types: dict[str, str] = {}
        self._inputs: tuple[dict[str, str], dict[str, str]] = ({}, {})
        self._results: dict[str, str] = {}

    def column(self, column: str) -> tuple[str, T.DataType]:
        """A column as SQL, and its type."""
        if column not in self._types and not self._case:
            column = self._folded.get(column.lower(), column)
        if column not in self._types:
            raise Unavailable(f"no column {column}")
        return C.name(column), self._types[column]

    def atomic(self, column: str) -> tuple[str, T.DataType]:
        value, dtype = self.column(column)
        if C.is_nested(dtype):
            raise Unavailable(f"column {column} of type {dtype.simpleString()} is nested")
        return value, dtype

    def keep(self, key: tuple, partial: str, merge: str) -> str:
        """Adds a partial aggregate once per key; returns the name of its merged value.

        `merge` is an aggregate over partial results, written {}, whose value is one of them again.
        """
        if key not in self._kept:
            alias = f"s{len(self._kept)}"
            self._kept[key] = alias, partial, merge.replace("{}", f"parts.{alias}")
        return self._kept[key][0]

    def run(self) -> DataFrame:
        """One row with every merged aggregate."""
        rows = self.df
        for level in (self._value_types, *self._inputs):
            if level:
                rows = rows.selectExpr("*", *[f"{sql} AS {alias}" for sql, alias in level.items()])
        partial = ", ".join(f"{partial} AS {alias}" for alias, partial, _ in self._kept.values())
        merged = [f"{merge} AS {alias}" for alias, _, merge in self._kept.values()]
        parts = rows.groupBy(F.expr("spark_partition_id()").alias("bucket")).agg(
            F.expr(f"struct({partial})").alias("parts")
        )
        for _ in range(merge_levels(input_partitions(self.df))):
            parts = parts.groupBy(F.expr(next_bucket("bucket")).alias("bucket")).agg(
                F.expr(f"struct({', '.join(merged)})").alias("parts")
            )
        results = [f"{sql} AS {alias}" for sql, alias in self._results.items()]
        return parts.selectExpr(*merged).selectExpr("*", *results)

    def passes(self, sql: str, check: Callable[[], object]) -> bool:
        """Whether a check of a rule's text raises nothing; each text is checked once."""
        if sql not in self._checked:
            try:
                check()
                self._checked[sql] = True
            except Exception:
                self._checked[sql] = False
        return self._checked[sql]

    # -- shared partial aggregates

    def total(self) -> str:
        return self.keep(("total",), "count(1)", "coalesce(sum({}), 0)")

    def present(self, column: str) -> str:
        value, _ = self.column(column)
        return self.keep(("present", value), f"count({value})", "coalesce(sum({}), 0)")

    def matching(self, predicate: str) -> str:
        """Rows that meet a predicate; null counts as not met."""
        return self.keep(("if", predicate), f"count_if({predicate})", "coalesce(sum({}), 0)")

    def fraction(self, predicate: str) -> str:
        return ratio(self.matching(predicate), self.total())

    def _value_type(self, value: str) -> str:
        """The type of each value of a text column, worked out once per row."""
        sql = C.text_value_type(value)
        return self._value_types.setdefault(sql, f"__value_type{len(self._value_types)}")

    def input(self, sql: str, level: int = 0) -> str:
        """A per-row input of aggregates, which evaluate a plain column much faster.

        One of level 1 may look at those of level 0.
        """
        return self._inputs[level].setdefault(sql, f"__input{level}_{len(self._inputs[level])}")

    def result(self, sql: str) -> str:
        """A value over merged aggregates that several metrics need."""
        return self._results.setdefault(sql, f"__result{len(self._results)}")

    def type_count(self, column: str, value_type: str) -> str:
        """Non-null values of a type; Unknown counts the nulls."""
        value, dtype = self.column(column)
        if value_type == "Unknown":
            return f"({self.total()} - {self.present(column)})"
        declared = C.declared_type(dtype)
        if declared is not None:
            return self.present(column) if value_type == declared else "0L"
        if value_type == "String":  # what is none of the others
            others = (self.type_count(column, t) for t in ("Integral", "Fractional", "Boolean"))
            return f"({self.present(column)} - {' - '.join(others)})"
        return self.matching(f"{self._value_type(C.plain_text(value, dtype))} = {C.text(value_type)}")

    def number_count(self, column: str) -> str:
        """Rows with a number."""
        if C.is_numeric(self.column(column)[1]):
            return self.present(column)
        return f"({self.type_count(column, 'Integral')} + {self.type_count(column, 'Fractional')})"

    def number(self, column: str) -> str:
        """The column as a double per row; text counts where it is written as a number."""
        value, dtype = self.atomic(column)
        if C.is_numeric(dtype):
            return value if isinstance(dtype, T.DoubleType) else self.input(f"CAST({value} AS double)")
        if not C.is_text(dtype):
            raise Unavailable(f"column {column} of type {dtype.simpleString()} is not numeric")
        value = C.plain_text(value, dtype)
        found = self._value_type(value)
        return self.input(
            f"if({found} IN ('Integral', 'Fractional'), try_cast({value} AS double), NULL)"
        )

    def if_numeric(self, column: str, value: str) -> str:
        """Keeps a numeric metric only if the column as a whole is numeric."""
        if C.is_numeric(self.column(column)[1]):
            return value
        counts = (self.type_count(column, t) for t in ("Integral", "Fractional", "Boolean", "String"))
        return f"if({column_type(*counts)} IN ('Integral', 'Fractional'), {value}, NULL)"


def next_bucket(bucket: str) -> str:
    """The row into which a partial result is merged, by the number of its partition or bucket."""
    return f"{bucket} div {MERGE_WIDTH}"


def merge_levels(partitions: int) -> int:
    """Levels after which at most MERGE_WIDTH partial results of so many partitions are left."""
    levels = 0
    while partitions > MERGE_WIDTH ** (levels + 1) and levels < MAX_LEVELS:
        levels += 1
    return levels


def input_partitions(df: DataFrame) -> int:
    """About how many partitions a scan of df has, by the size that Spark expects of it.

    A size that Spark does not know is taken for a very large one.
    """
    query = df._jdf.queryExecution()
    size = int(str(query.optimizedPlan().stats().sizeInBytes()))
    return size // query.sparkSession().sessionState().conf().filesMaxPartitionBytes() + 1


def column_type(integral: str, fractional: str, boolean: str, other: str) -> str:
    """The type of a column from the number of values of each type."""
    return (
        f"CASE WHEN {other} > 0 OR ({boolean} > 0 AND {integral} + {fractional} > 0) THEN 'String'"
        f" WHEN {fractional} > 0 THEN 'Fractional'"
        f" WHEN {integral} > 0 THEN 'Integral'"
        f" WHEN {boolean} > 0 THEN 'Boolean' ELSE 'Unknown' END"
    )


def ratio(part: str, whole: str) -> str:
    return f"try_divide(CAST({part} AS double), CAST({whole} AS double))"


# -- metrics: each yields (reported name, value over merged aggregates) and, where there are any,
# the number of rows on which it failed, and by how much the value may be off

Reported = Iterator[tuple[str, ...]]


def _size(scan: Scan, column: str, params: str) -> Reported:
    yield "Size", scan.total()


def _completeness(scan: Scan, column: str, params: str) -> Reported:
    yield "Completeness", ratio(scan.present(column), scan.total())


def _distinct_estimate(scan: Scan, column: str) -> str:
    value, dtype = scan.atomic(column)
    # the sketch takes integers as they are; it would skip an empty text, so texts are hashed
    keys = value if isinstance(dtype, (T.IntegerType, T.LongType)) else None
    keys = keys or scan.input(C.sketch_hash(value, dtype))
    partial = f"hll_sketch_agg({keys}, {DISTINCT_SKETCH_LOG2_K})"
    sketch = scan.keep(("distinct", value), partial, "hll_union_agg({})")
    return f"hll_sketch_estimate({sketch})"


def _approx_count_distinct(scan: Scan, column: str, params: str) -> Reported:
    estimate = _distinct_estimate(scan, column)
    yield "ApproxCountDistinct", f"if({scan.total()} > 0, {estimate}, NULL)"


def _approx_distinctness(scan: Scan, column: str, params: str) -> Reported:
    estimate = f"least({_distinct_estimate(scan, column)}, {scan.present(column)})"
    yield "ApproxDistinctness", ratio(estimate, scan.total())


def _quantile(scan: Scan, column: str, rank: float) -> str:
    """The value of the summary whose share of the rows holds the rank."""
    x = scan.number(column)
    ranks = ",".join(str((i + 0.5) / QUANTILE_POINTS) for i in range(QUANTILE_POINTS))
    partial = (
        f"struct(count({x}) AS n, percentile_approx({x}, CAST(split('{ranks}', ',') AS array<double>),"
        f" {QUANTILE_ACCURACY}) AS points)"
    )
    summary = scan.keep(("quantile", column), partial, _MERGED_QUANTILES)
    at = min(int(rank * QUANTILE_POINTS), QUANTILE_POINTS - 1)
    return scan.if_numeric(column, f"get({summary}.points, {at})")


# Of partial summaries all values with the rows that each stands for, times QUANTILE_POINTS, in
# order; then the value at the middle of each share of the rows.
_SHARES = f"CAST(least({QUANTILE_POINTS}, (2 * (a.c + e.w) + n) div (2 * n)) AS int)"
_MERGED_QUANTILES = (
    "transform(array(collect_list({}) FILTER (WHERE {}.n > 0)), parts ->"
    " transform(array(aggregate(parts, 0L, (a, part) -> a + part.n)), n -> struct(n AS n, if(n > 0,"
    "  aggregate(sort_array(flatten(transform(parts, part -> transform(part.points, v -> struct(v AS v, part.n AS w))))),"
    "   struct(0L AS c, CAST(array() AS array<double>) AS out),"
    f"   (a, e) -> struct(a.c + e.w AS c, if({_SHARES} > size(a.out),"
    f"    concat(a.out, array_repeat(e.v, {_SHARES} - size(a.out))), a.out) AS out), a -> a.out),"
    "  CAST(NULL AS array<double>)) AS points))[0])[0]"
)


def _approx_quantile(scan: Scan, column: str, params: str) -> Reported:
    yield f"ApproxQuantile-{params}", _quantile(scan, column, float(params))


def _approx_quantiles(scan: Scan, column: str, params: str) -> Reported:
    for rank in PROFILE_QUANTILES:
        yield f"ApproxQuantiles-{rank}", _quantile(scan, column, rank)


def _data_type(scan: Scan, column: str, params: str) -> Reported:
    scan.atomic(column)
    total = scan.total()
    yield "Histogram.bins", f"if({total} > 0, {len(patterns.VALUE_TYPES)}, NULL)"
    for value_type in patterns.VALUE_TYPES:
        found = scan.type_count(column, value_type)
        yield f"Histogram.abs.{value_type}", f"if({total} > 0, {found}, NULL)"
        yield f"Histogram.ratio.{value_type}", ratio(found, total)


def _type_ratio(scan: Scan, column: str, params: str) -> Reported:
    scan.atomic(column)
    if params == "Null":
        yield "DataType", ratio(scan.type_count(column, "Unknown"), scan.total())
    elif params == "Numeric":
        found = (scan.type_count(column, t) for t in ("Integral", "Fractional"))
        yield "DataType", ratio(f"({' + '.join(found)})", scan.present(column))
    else:
        yield "DataType", ratio(scan.type_count(column, params), scan.present(column))


def _maximum(scan: Scan, column: str, params: str) -> Reported:
    value = scan.keep(("max", column), f"max({scan.number(column)})", "max({})")
    yield "Maximum", scan.if_numeric(column, value)


def _minimum(scan: Scan, column: str, params: str) -> Reported:
    value = scan.keep(("min", column), f"min({scan.number(column)})", "min({})")
    yield "Minimum", scan.if_numeric(column, value)


# A double is cut into whole multiples of these powers of two, LIMB_BITS apart.  Sums of whole
# numbers do not depend on their order; 2^(63 - LIMB_BITS) rows can be added by one task.
LIMB_BITS = 32
LIMBS = tuple(range(64, -97, -LIMB_BITS))
# What is larger is added as doubles; what is smaller than the last power is rounded, row by row.
LARGEST = 2.0 ** (LIMBS[0] + LIMB_BITS - 1)
# Half a unit in the last place of a double, relative to it.
HALF_UNIT = 2.0**-53


def _sum_of(scan: Scan, column: str) -> str:
    """The sum, the same in every bit however the rows are dealt out; null without a number."""
    value, dtype = scan.atomic(column)
    total = "CAST(sum({}) AS decimal(38,0))"
    if isinstance(dtype, T.LongType):
        # Halves of 32 bits, so that neither sum overflows.
        partial = (
            f"struct(CAST(sum(shiftright({value}, 32)) AS decimal(38,0)) AS high,"
            f" CAST(sum({value} & 4294967295) AS decimal(38,0)) AS low)"
        )
        merge = f"struct({total.format('{}.high')} AS high, {total.format('{}.low')} AS low)"
        parts = scan.keep(("exact sum", column), partial, merge)
        return f"CAST({parts}.high * 4294967296BD + {parts}.low AS double)"
    if C.is_integral(dtype):
        partial = f"CAST(sum(CAST({value} AS bigint)) AS decimal(38,0))"
        return f"CAST({scan.keep(('exact sum', column), partial, total.format('{}'))} AS double)"
    if isinstance(dtype, T.DecimalType):
        # Wholes and fractions apart, so that a sum has all digits for the wholes.
        whole, wide = f"CAST(floor({value}) AS decimal(38,0))", f"decimal(38,{dtype.scale})"
        partial = (
            f"struct(try_sum({whole}) AS whole, CAST(sum({value} - floor({value})) AS {wide}) AS part)"
        )
        merge = f"struct(try_sum({{}}.whole) AS whole, CAST(sum({{}}.part) AS {wide}) AS part)"
        parts = scan.keep(("exact sum", column), partial, merge)
        return f"(CAST({parts}.whole AS double) + CAST({parts}.part AS double))"
    x = scan.number(column)
    common = scan.input(f"if(abs({x}) < {LARGEST!r}d, {x}, if({x} IS NULL, NULL, 0.0d))", 1)
    # How often each power goes into a value; less what the one before has taken.
    whole = [f"rint({common} * {2.0**-power!r}d)" for power in LIMBS]
    limbs = [whole[0], *[f"{b} - {a} * {2.0**LIMB_BITS!r}d" for a, b in zip(whole, whole[1:])]]
    fields = [(f"l{i}", f"CAST(sum(CAST({limb} AS bigint)) AS decimal(38,0))") for i, limb in enumerate(limbs)]
    partial = ", ".join(f"{sql} AS {name}" for name, sql in fields)
    merge = ", ".join(f"{total.format('{}.' + name)} AS {name}" for name, _ in fields)
    rest = f"sum(if(abs({x}) < {LARGEST!r}d, NULL, {x}))"
    parts = scan.keep(
        ("exact sum", column), f"struct({partial}, {rest} AS rest)", f"struct({merge}, sum({{}}.rest) AS rest)"
    )
    exact = _from_limbs([f"{parts}.l{i}" for i in range(len(LIMBS))])
    return scan.result(f"{exact} + coalesce({parts}.rest, 0.0d)")


def _from_limbs(limbs: list[str]) -> str:
    """The double that limbs, the highest first, stand for.

    From the lowest limb on, what exceeds half a limb either way is carried over.  So when the
    digits are added as doubles, from the highest one on, none cancels those before it.
    """
    base, half = f"{2**LIMB_BITS}BD", f"{2 ** (LIMB_BITS - 1)}BD"
    digit = f"pmod(a.carry + limb + {half}, {base}) - {half}"
    zero = "struct(CAST(0 AS decimal(38,0)) AS carry, CAST(array() AS array<double>) AS digits)"
    digits = (
        f"aggregate(array({', '.join(reversed(limbs))}), {zero}, (a, limb) -> struct("
        f"CAST((a.carry + limb - ({digit})) / {base} AS decimal(38,0)) AS carry,"
        f" concat(a.digits, array(CAST({digit} AS double))) AS digits),"
        " a -> concat(a.digits, array(CAST(a.carry AS double))))"
    )
    return (
        f"aggregate(reverse({digits}), 0.0d, (sum, digit) -> sum * {2.0**LIMB_BITS!r}d + digit)"
        f" * {2.0**LIMBS[-1]!r}d"
    )


def _slack_of(scan: Scan, column: str) -> str:
    """What a sum may be off because its values are doubles: half a unit in the last place of each."""
    value, dtype = scan.atomic(column)
    if C.is_integral(dtype) or isinstance(dtype, T.DecimalType):
        return "0.0d"
    amounts = scan.keep(("amounts", column), f"sum(abs({scan.number(column)}))", "sum({})")
    return f"({amounts} * {HALF_UNIT!r}d)"


def _sum(scan: Scan, column: str, params: str) -> Reported:
    yield "Sum", scan.if_numeric(column, _sum_of(scan, column)), "0L", _slack_of(scan, column)


def _mean(scan: Scan, column: str, params: str) -> Reported:
    count = scan.number_count(column)
    mean, slack = (ratio(value, count) for value in (_sum_of(scan, column), _slack_of(scan, column)))
    yield "Mean", scan.if_numeric(column, mean), "0L", slack


def _standard_deviation(scan: Scan, column: str, params: str) -> Reported:
    x = scan.number(column)
    partial = f"struct(count({x}) AS n, avg({x}) AS mx, var_pop({x}) * count({x}) AS sxx)"
    moments = scan.keep(("moments", column), partial, _fold(("mx",), ("sxx",)))
    yield "StandardDeviation", scan.if_numeric(column, f"sqrt({ratio(moments + '.sxx', moments + '.n')})")


def _correlation(scan: Scan, column: str, params: str) -> Reported:
    x, y = scan.number(column), scan.number(params)
    x, y = f"if({y} IS NULL, NULL, {x})", f"if({x} IS NULL, NULL, {y})"
    partial = (
        f"struct(count({x}) AS n, avg({x}) AS mx, avg({y}) AS my, var_pop({x}) * count({x}) AS sxx,"
        f" var_pop({y}) * count({x}) AS syy, covar_pop({x}, {y}) * count({x}) AS sxy)"
    )
    merge = _fold(("mx", "my"), ("sxx", "syy", "sxy"))
    moments = scan.keep(("comoments", column, params), partial, merge)
    value = ratio(f"{moments}.sxy", f"sqrt({moments}.sxx * {moments}.syy)")
    yield "Correlation", scan.if_numeric(column, scan.if_numeric(params, value))


def _fold(means: tuple[str, ...], squares: tuple[str, ...]) -> str:
    """Merges the moments of partial results: (n, means, sums of squared deviations).

    Merging two parts moves the mean by step * n_b / n and adds step_x * step_y * n_a * n_b / n
    to a sum of products; a part without values has null means and is left out.
    """

    def step(axis: str) -> str:
        return f"(b.m{axis} - a.m{axis})"

    fields = ["a.n + b.n AS n"]
    fields += [f"a.{m} + {step(m[1])} * b.n / (a.n + b.n) AS {m}" for m in means]
    fields += [
        f"a.{s} + b.{s} + {step(s[1])} * {step(s[2])} * a.n * (b.n / (a.n + b.n)) AS {s}"
        for s in squares
    ]
    zero = ", ".join(["0L AS n", *[f"0.0d AS {field}" for field in means + squares]])
    return (
        "aggregate(collect_list({}) FILTER (WHERE {}.n > 0), "
        f"struct({zero}), (a, b) -> struct({', '.join(fields)}))"
    )


def _text(scan: Scan, column: str) -> str:
    value, dtype = scan.column(column)
    if not C.is_text(dtype):
        raise Unavailable(f"column {column} of type {dtype.simpleString()} is not text")
    return value


def _min_length(scan: Scan, column: str, params: str) -> Reported:
    length = f"min(char_length({_text(scan, column)}))"
    yield "MinLength", scan.keep(("shortest", column), length, "min({})")


def _max_length(scan: Scan, column: str, params: str) -> Reported:
    length = f"max(char_length({_text(scan, column)}))"
    yield "MaxLength", scan.keep(("longest", column), length, "max({})")


def _pattern_match(scan: Scan, column: str, params: str) -> Reported:
    value, dtype = scan.atomic(column)
    subject = C.plain_text(value, dtype) if C.is_text(dtype) else f"CAST({value} AS string)"
    found = f"{subject} RLIKE {C.text(params)}"
    # constant folding compiles the pattern without starting a job
    compiled = f"'' RLIKE {C.text(params)}"
    if not scan.passes(compiled, lambda: scan.df.sparkSession.sql(f"SELECT {compiled}").collect()):
        raise Unavailable(f"bad pattern {params}")
    if params in patterns.NEEDED:
        found = f"contains({subject}, {C.text(patterns.NEEDED[params])}) AND {found}"
    yield "PatternMatch", scan.fraction(found)


def _decimals(value: str) -> int:
    """Decimals of a number, without zeros at its end; 0 for what is no number."""
    try:
        _, digits, exponent = Decimal(value.strip()).as_tuple()
    except InvalidOperation:
        return 0
    if not isinstance(exponent, int) or not any(digits):
        return 0
    zeros = next(i for i, digit in enumerate(reversed(digits)) if digit)
    return max(0, -exponent - zeros)


def _literal(value: str, dtype: T.DataType) -> str:
    """A rule's text as a value of the column's type; null if it is none.

    A number with more decimals than the column has is none of its values; a cast would round it.
    """
    if C.is_text(dtype):
        return C.text(value)
    if isinstance(dtype, T.DecimalType) and _decimals(value) > dtype.scale:
        return f"CAST(NULL AS {dtype.simpleString()})"
    return f"try_cast({C.text(value)} AS {dtype.simpleString()})"


def _histogram_ratio(scan: Scan, column: str, params: str) -> Reported:
    value, dtype = scan.atomic(column)
    yield "HistogramRatio", scan.fraction(f"{value} = {_literal(params, dtype)}")


def _contained_in(scan: Scan, column: str, params: str) -> Reported:
    value, dtype = scan.atomic(column)
    allowed = ", ".join(_literal(item.strip(), dtype) for item in params.split(","))
    yield "Compliance", scan.fraction(f"{value} IS NULL OR {value} IN ({allowed})")


def _sign(condition: str) -> Callable[[Scan, str, str], Reported]:
    def metric(scan: Scan, column: str, params: str) -> Reported:
        value, dtype = scan.atomic(column)
        if not (C.is_numeric(dtype) or C.is_text(dtype)):
            raise Unavailable(f"column {column} of type {dtype.simpleString()} is not numeric")
        number = f"try_cast({value} AS double)" if C.is_text(dtype) else value
        yield "Compliance", scan.fraction(f"{value} IS NULL OR {number} {condition}")

    return metric


def _comparison(operator: str) -> Callable[[Scan, str, str], Reported]:
    def metric(scan: Scan, column: str, params: str) -> Reported:
        left, right = _comparable(scan, column, params)
        yield "Compliance", scan.fraction(f"{left} {operator} {right}")

    return metric


def _comparable(scan: Scan, a: str, b: str) -> tuple[str, str]:
    """Both columns in a common type, without a cast that can fail on a row."""
    (left, left_type), (right, right_type) = scan.atomic(a), scan.atomic(b)

    def cast(value: str, dtype: T.DataType) -> str:
        return f"try_cast({value} AS {'double' if C.is_numeric(dtype) else dtype.simpleString()})"

    if C.is_text(left_type) and not C.is_text(right_type):
        return cast(left, right_type), right
    if C.is_text(right_type) and not C.is_text(left_type):
        return left, cast(right, left_type)
    numbers = C.is_numeric(left_type) and C.is_numeric(right_type)
    times = isinstance(left_type, T.DatetimeType) and isinstance(right_type, T.DatetimeType)
    if numbers or times or type(left_type) is type(right_type):
        return left, right
    raise Unavailable(
        f"cannot compare {a} {left_type.simpleString()} with {b} {right_type.simpleString()}"
    )


def _satisfies(scan: Scan, column: str, params: str) -> Reported:
    """The share of rows on which a predicate is true; null if it cannot be told on some row.

    try_to_binary turns any error of its argument into null, so a row is one of three: true, not
    true, failed.  The condition before it, which is always met, keeps parts that occur in several
    predicates from being computed ahead of it, where their errors would not be caught.
    """
    predicate = f"CAST(({params}) AS boolean)"
    # analysed here, not run
    if not scan.passes(predicate, lambda: scan.df.selectExpr(f"count_if({predicate})")):
        raise Unavailable(f"bad predicate {params}")
    outcome = scan.input(
        f"if(spark_partition_id() >= 0, try_to_binary(if({predicate}, '01', '00'), 'hex'), NULL)"
    )
    failed = scan.matching(f"{outcome} IS NULL")
    yield "Compliance", f"if({failed} > 0, NULL, {scan.fraction(f'{outcome} = X{chr(39)}01{chr(39)}')})", failed


METRICS: dict[str, Callable[[Scan, str, str], Reported]] = {
    "Size": _size,
    "Completeness": _completeness,
    "ApproxCountDistinct": _approx_count_distinct,
    "ApproxDistinctness": _approx_distinctness,
    "ApproxQuantile": _approx_quantile,
    "ApproxQuantiles": _approx_quantiles,
    "DataType": _data_type,
    "TypeRatio": _type_ratio,
    "Maximum": _maximum,
    "Minimum": _minimum,
    "Mean": _mean,
    "Sum": _sum,
    "StandardDeviation": _standard_deviation,
    "Correlation": _correlation,
    "MinLength": _min_length,
    "MaxLength": _max_length,
    "PatternMatch": _pattern_match,
    "HistogramRatio": _histogram_ratio,
    "ContainedIn": _contained_in,
    "NonNegative": _sign(">= 0"),
    "Positive": _sign("> 0"),
    "LessThan": _comparison("<"),
    "LessThanOrEqualTo": _comparison("<="),
    "GreaterThan": _comparison(">"),
    "GreaterThanOrEqualTo": _comparison(">="),
    "Satisfies": _satisfies,
}


# The long metrics table.
COLUMNS = ("metric", "column", "params", "entity", "instance", "name", "value", "failed", "slack")


def _row(request: Request, name: str, value: str, failed: str = "0L", slack: str = "0.0d") -> str:
    """One row of the long metrics table."""
    if request.metric == "Size":
        entity, instance = "Dataset", "*"
    elif request.metric == "Correlation":
        entity, instance = "Multicolumn", f"{request.column},{request.params}"
    else:
        entity, instance = "Column", request.column
    cells = ", ".join(C.text(cell) for cell in (*request, entity, instance, name))
    # + 0.0 turns -0.0 into 0.0
    return f"struct({cells}, CAST({value} AS double) + 0.0d, CAST({failed} AS bigint), CAST({slack} AS double))"


def scan_metrics(
    df: DataFrame, requests: Iterable[Request]
) -> tuple[list[DataFrame], dict[Request, str]]:
    """Long metrics, one lazy frame per batch of columns, and why a request has none."""
    requests = list(dict.fromkeys(requests))
    names = list(dict.fromkeys(request.column for request in requests))
    problems: dict[Request, str] = {}
    frames = []
    checked: dict[str, bool] = {}
    for start in range(0, len(names), COLUMNS_PER_SCAN):
        batch = set(names[start : start + COLUMNS_PER_SCAN])
        scan, rows = Scan(df, checked), []
        for request in requests:
            if request.column in batch:
                try:
                    found = list(METRICS[request.metric](scan, request.column, request.params))
                except Unavailable as reason:
                    problems[request] = str(reason)
                    continue
                rows += [_row(request, *cells) for cells in found]
        if rows:
            frames.append(
                scan.run()
                .selectExpr(f"inline(array({', '.join(rows)}))")
                .toDF(*COLUMNS)
            )
    return frames, problems
