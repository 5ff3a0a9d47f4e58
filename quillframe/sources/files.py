"""CSV, JSON, text and labelled-folder readers."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing marker: NaN becomes null in every float column."""
    floats = {f.name: F.when(~F.isnan(f.name), F.col(f.name))
              for f in df.schema.fields if isinstance(f.dataType, (FloatType, DoubleType))}
    return df.withColumns(floats) if floats else df


def read_csv(spark: SparkSession, path: str, schema: str | StructType | None = None, header: bool = True,
             sep: str = ",", timestamp_format: str | None = None) -> DataFrame:
    """Delimited scan; an empty field is null. Without a schema it is inferred once, from the data."""
    r = spark.read.option("header", header).option("sep", sep)
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return nan_to_null(r.csv(path))


def convert(df: DataFrame, converters: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Per-column converters given as column -> expression functions."""
    return df.withColumns({c: f(F.col(c)) for c, f in converters.items()})


def duration_seconds(c: Column) -> Column:
    """'h:m:s' to seconds; anything else is null."""
    p = F.split(c, ":")
    num = [F.try_element_at(p, F.lit(i)).try_cast("bigint") for i in (1, 2, 3)]
    return F.when(F.size(p) == 3, num[0] * 3600 + num[1] * 60 + num[2])


def quarantine(spark: SparkSession, path: str, schema: StructType, **options: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected raw lines) of a one-record-per-line CSV load."""
    fields = [*schema.fields, StructField(CORRUPT, StringType())]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    rows = spark.read.text(path).select(F.from_csv("value", ddl, opts).alias("r")).select("r.*")
    good = rows.filter(F.col(CORRUPT).isNull()).select(*schema.fieldNames())
    bad = rows.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    return good, bad


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a pinned schema; a broken line keeps its text in the corrupt column."""
    return spark.read.schema(f"{schema}, {CORRUPT} string").option(
        "columnNameOfCorruptRecord", CORRUPT).json(path)


def read_lines(spark: SparkSession, path: str, line_sep: str = "\n") -> DataFrame:
    """(line, path) for every file matching a path or glob."""
    return spark.read.option("lineSep", line_sep).text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"))


def partition_value(path: Column, key: str) -> Column:
    """Value of ``key=...`` in a file path."""
    return F.regexp_extract(path, rf"/{key}=([^/]+)/", 1)


def labelled_folders(spark: SparkSession, root: str, classes: list[str], min_rows: int = 0,
                     max_rows: int | None = None) -> DataFrame:
    """(class, label, line): one folder per class, label = position of the class in sorted order.

    Unreadable files are skipped. With bounds given, the row count of every class is checked first.
    """
    frames = []
    for label, name in enumerate(sorted(classes)):
        part = (spark.read.option("ignoreCorruptFiles", True).option("lineSep", "\n").text(f"{root}/{name}")
                .select(F.lit(name).alias("class"), F.lit(label).alias("label"), F.col("value").alias("line")))
        frames.append(part)
    rows = reduce(DataFrame.unionByName, frames)
    if min_rows or max_rows is not None:
        sizes = rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
        wrong = F.col("n") < min_rows
        if max_rows is not None:
            wrong = wrong | (F.col("n") > max_rows)
        bad = sizes.filter(wrong).limit(1).collect()
        if bad:
            raise ValueError(f"class {bad[0]['class']} has {bad[0]['n']} rows")
    return rows
