"""Rules files, landed files and result files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions import columns as C
from tidemark.operators.rules import KEYS, RULES

# File formats by the ending of a path; a landed file may also be a folder of part files.
FORMATS = {"csv": "csv", "txt": "csv", "parquet": "parquet", "json": "json", "orc": "orc"}
# Of these every scan reads and parses all columns.
ROW_FORMATS = ("csv", "json")
# What a compressed file without another ending holds: no Parquet file is compressed as a whole.
COMPRESSED_FORMAT = "csv"
# Endings of compressed files that Spark opens by themselves.
COMPRESSIONS = ("gz", "bz2", "deflate", "lz4", "snappy", "zst", "zstd")


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A `;`-delimited rules file, its columns bound by name and read as text.

    Rule columns the file leaves out are null; columns that are no rule stay, so that
    verification can report them.
    """
    rules = spark.read.option("sep", ";").option("header", True).csv(path)
    rules = rules.toDF(*[column.strip() for column in rules.columns])
    for column in KEYS:
        if column not in rules.columns:
            raise ValueError(f"rules file {path} has no column {column}")
    missing = [rule for rule in RULES if rule not in rules.columns]
    return rules.select(
        *KEYS,
        *[c if c in rules.columns else F.lit(None).cast("string").alias(c) for c in RULES],
        *[c for c in rules.columns if c not in KEYS and c not in RULES],
    ) if missing else rules


def interface_schema(
    spark: SparkSession, table: str | None, schema: T.StructType | None = None
) -> T.StructType | None:
    """The schema of the catalog table if it exists, else the given one."""
    if table is not None and spark.catalog.tableExists(table):
        return spark.table(table).schema
    return schema


def read_interface(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    fmt: str | None = None,
    table: str | None = None,
    schema: T.StructType | str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Landed files or folders of files of one interface with their declared schema.

    CSV columns are bound to the declared ones by the header, or by place where the options say
    that there is none.  A CSV file of which no schema is known is read once more to infer one.
    Paths of several formats are read as one table, by column name.
    """
    paths = [path] if isinstance(path, str) else list(path)
    declared = interface_schema(spark, table, schema)
    if isinstance(declared, str):
        declared = T.StructType.fromDDL(declared)
    by_format: dict[str, list[str]] = {}
    for one in paths:
        by_format.setdefault(fmt or format_of(one), []).append(one)
    parts = []
    for kind, own in by_format.items():
        given = {**({"header": "true"} if kind == "csv" else {}), **(options or {})}
        reader = spark.read.format(kind).options(**given)
        if kind == "csv" and declared is not None and str(given["header"]).lower() == "true":
            parts.append(_bound_by_header(spark, own, declared, given))
        elif declared is not None:
            parts.append(reader.schema(declared).load(own))
        elif kind == "csv" and "inferSchema" not in given:
            parts.append(reader.option("inferSchema", True).load(own))
        else:
            parts.append(reader.load(own))
    return reduce(DataFrame.unionByName, parts)


def format_of(path: str) -> str:
    """The format of a landed file by its ending, one of compression aside.

    Without a known ending it is CSV if compressed, else Parquet.
    """
    endings = path.rstrip("/").rsplit("/", 1)[-1].lower().split(".")[1:]
    other = "parquet"
    if endings and endings[-1] in COMPRESSIONS:
        endings.pop()
        other = COMPRESSED_FORMAT
    return FORMATS.get(endings[-1] if endings else "", other)


def _bound_by_header(
    spark: SparkSession, paths: list[str], declared: T.StructType, options: dict[str, str]
) -> DataFrame:
    """CSV files with the declared columns, wherever they stand in a file; others are left out.

    A declared column that a file lacks is an error, and so is a part file with another header
    than the first of its folder.
    """
    exact = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    folded = (lambda name: name) if exact else str.lower
    types = {folded(field.name): field.dataType for field in declared.fields}
    by_header: dict[tuple, list[str]] = {}
    for path in paths:
        header = spark.read.format("csv").options(**{**options, "inferSchema": "false"}).load(path).columns
        by_header.setdefault(tuple(header), []).append(path)
    parts = []
    for header, own in by_header.items():
        if not header:  # an empty file has no header, and no rows
            parts.append(spark.createDataFrame([], declared))
            continue
        found = {folded(name) for name in header}
        missing = [field.name for field in declared.fields if folded(field.name) not in found]
        if missing:
            raise ValueError(f"{own[0]} has no column {', '.join(missing)}")
        in_file = T.StructType([T.StructField(c, types.get(folded(c), T.StringType())) for c in header])
        rows = spark.read.format("csv").options(**options).option("enforceSchema", False).schema(in_file).load(own)
        parts.append(rows.select(*[F.col(C.name(field.name)).alias(field.name) for field in declared.fields]))
    return reduce(DataFrame.unionByName, parts)


def landed_files(
    spark: SparkSession, folder: str, names: Sequence[str], pattern: str = r"^([^.]+)"
) -> DataFrame:
    """(interface, path): the landed files or folders of the requested interfaces.

    Only the entries of the folder itself are listed, no content is read.  The first group of
    `pattern`, applied to an entry, is the interface name.
    """
    base = folder.rstrip("/")
    at = spark._jvm.org.apache.hadoop.fs.Path(base)
    listed = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    entries = pa.table({"entry": pa.array([one.getPath().getName() for one in listed], pa.string())})
    return (
        spark.createDataFrame(entries)
        .where(~F.col("entry").rlike(r"^[._]"))
        .select(
            F.regexp_extract("entry", pattern, 1).alias("interface"),
            F.concat(F.lit(base + "/"), "entry").alias("path"),
        )
        .where(F.col("interface").isin(list(names)))
    )


def write_single_csv(df: DataFrame, path: str, *order: str) -> None:
    """A result as a folder with one CSV part file, with a header.

    Results have a row per metric or rule, so one task writes them; repartition rather than
    coalesce leaves the work before it as parallel as it was.
    """
    rows = df.repartition(1)
    if order:
        rows = rows.sortWithinPartitions(*order)
    rows.write.mode("overwrite").option("header", True).csv(path)


def publish(spark: SparkSession, aside: Mapping[str, str]) -> None:
    """Moves results that were written aside to their places, all or none.

    What stood there before is kept until all are in place, and is put back if a move fails.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def at(path: str):
        return jvm.org.apache.hadoop.fs.Path(path)

    def move(source: str, target: str) -> None:
        if not at(source).getFileSystem(conf).rename(at(source), at(target)):
            raise OSError(f"cannot move {source} to {target}")

    moved, earlier = [], []
    try:
        for source, target in aside.items():
            if at(target).getFileSystem(conf).exists(at(target)):
                move(target, f"{source}.earlier")
                earlier.append((f"{source}.earlier", target))
            move(source, target)
            moved.append(target)
    except Exception:
        for target in moved:
            at(target).getFileSystem(conf).delete(at(target), True)
        for source, target in earlier:
            move(source, target)
        raise


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def profile_path(out: str, interface: str) -> str:
    return f"{out.rstrip('/')}/{interface}.profile.csv"


def verification_path(out: str, interface: str) -> str:
    return f"{out.rstrip('/')}/{interface}.verification.csv"
