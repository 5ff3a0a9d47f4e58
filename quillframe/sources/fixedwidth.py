"""Fixed-width files described by a data dictionary."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Dictionary storage types and the column types they load as.
STORAGE_TYPES = {"byte": "tinyint", "int": "int", "long": "bigint", "float": "float", "double": "double"}
ENTRY = re.compile(r'_column\((\d+)\)\s+(\S+)\s+(\S+)\s+(\S+)\s*(?:"([^"]*)")?')


@dataclass(frozen=True)
class Field:
    start: int
    end: int | None  # exclusive, 1-based; None = to the end of the line
    type: str
    name: str
    description: str


def parse_dictionary(lines: list[str]) -> list[Field]:
    """Fields of a dictionary file (a few hundred lines). A field ends where the next one starts."""
    found = [m for m in map(ENTRY.search, lines) if m]
    starts = [int(m[1]) for m in found]
    ends = [*starts[1:], None]
    return [
        Field(int(m[1]), end, "string" if m[2].startswith("str") else STORAGE_TYPES[m[2]], m[3].lower(), m[5] or "")
        for m, end in zip(found, ends)
    ]


def read_fixed_width(spark: SparkSession, path: str, fields: list[Field]) -> DataFrame:
    """Cut and cast every line; a blank or malformed field is null."""
    value = F.col("value")
    cols = []
    for f in fields:
        raw = F.trim(value.substr(F.lit(f.start), F.lit(f.end - f.start) if f.end else F.length(value)))
        present = F.when(raw != "", raw)
        cols.append((present if f.type == "string" else present.try_cast(f.type)).alias(f.name))
    return spark.read.text(path).select(*cols)
