"""SQL expressions that depend on the Spark type of a column.

Expressions are built as SQL text: a profile has hundreds of them, and one parsed text is
far cheaper to hand to Spark than a tree of Column calls.
"""

from __future__ import annotations

from pyspark.sql import types as T

from tidemark.functions import patterns

# Texts longer than this enter a frequency table as their digest.
LONG_TEXT_BYTES = 64


def name(column: str) -> str:
    """A column name as SQL, whatever characters it holds."""
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def any_of(values) -> str:
    return "(" + ", ".join(text(value) for value in values) + ")"


def is_integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def is_fractional(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType))


def is_numeric(dtype: T.DataType) -> bool:
    return is_integral(dtype) or is_fractional(dtype)


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(
        dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.UserDefinedType)
    )


def declared_type(dtype: T.DataType) -> str | None:
    """The value type every non-null value has; None where it depends on the value."""
    if is_text(dtype):
        return None
    if is_integral(dtype):
        return "Integral"
    if is_fractional(dtype):
        return "Fractional"
    if isinstance(dtype, T.BooleanType):
        return "Boolean"
    return "String"


def text_value_type(value: str) -> str:
    """The value type of one text: Integral, Fractional, Boolean or String; null stays null."""
    return (
        f"CASE WHEN {value} IS NULL THEN NULL"
        f" WHEN left({value}, 1) NOT IN {any_of(patterns.LITERAL_STARTS)} THEN 'String'"
        f" WHEN {value} RLIKE {text(patterns.INTEGRAL)} THEN 'Integral'"
        f" WHEN {value} RLIKE {text(patterns.FRACTIONAL)} THEN 'Fractional'"
        f" WHEN {value} IN {any_of(patterns.BOOLEAN)} THEN 'Boolean'"
        " ELSE 'String' END"
    )


def is_collated(dtype: T.DataType) -> bool:
    """Text of which different bytes may be equal."""
    return getattr(dtype, "collation", "UTF8_BINARY") != "UTF8_BINARY"


def plain_text(value: str, dtype: T.DataType) -> str:
    """A text by its bytes, as patterns and value types look at it, whatever its collation."""
    return f"collate({value}, 'UTF8_BINARY')" if is_collated(dtype) else value


def sketch_hash(value: str, dtype: T.DataType) -> str:
    """What the distinct-count sketch takes: a 64-bit hash; null stays null, -0.0 equals 0.0.

    A collated text is left to the sketch, which heeds the collation but skips empty texts; the
    mark that prevents this stands in front, where blanks at the end stay at the end.
    """
    if is_collated(dtype):
        return f"concat('.', {value})"
    hashed = f"{value} + 0.0d" if isinstance(dtype, (T.FloatType, T.DoubleType)) else value
    return f"if({value} IS NULL, NULL, xxhash64({hashed}))"


def frequency_key(value: str, dtype: T.DataType) -> tuple[str, str]:
    """(Spark type name, key): equal keys if and only if equal values.

    Keys share as few types as possible so that columns can be counted together.  A long
    text is replaced by its SHA-256 and length, which is longer than any short text and so
    never equals one; whole documents then need not be shuffled to be counted.  A collated
    text has no digest that heeds its collation and stays as it is.
    """
    if is_collated(dtype):
        return dtype.simpleString(), value
    if is_integral(dtype):
        return "bigint", f"CAST({value} AS bigint)"
    if isinstance(dtype, T.BooleanType):
        return "bigint", f"CAST({value} AS bigint)"
    if isinstance(dtype, T.DateType):
        return "bigint", f"CAST(unix_date({value}) AS bigint)"
    if isinstance(dtype, T.TimestampType):
        return "bigint", f"unix_micros({value})"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "double", f"CAST({value} AS double)"
    if is_text(dtype):
        size = f"octet_length({value})"
        digest = f"concat(sha2(CAST({value} AS binary), 256), ':', {size})"
        return "string", f"if({size} <= {LONG_TEXT_BYTES}, {value}, {digest})"
    return dtype.simpleString(), value
