"""Column selection, masks, recodes and positional selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

from quillframe.plans.ordered import scan

WORDS_IN_PATTERN = 200


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def select_by_type(df: DataFrame, kind: type[DataType]) -> DataFrame:
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, kind)])


def reindex_columns(df: DataFrame, names: list[str], missing_type: str = "double") -> DataFrame:
    """Columns in the given order; a name the frame lacks becomes a null column."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(missing_type).alias(c) for c in names])


def chained(first: str, *steps: tuple[str, str]) -> Column:
    """``a < b <= c``: each operator between neighbours, all of them joined by AND."""
    terms, left = [], first
    for op, right in steps:
        terms.append(F.expr(f"({left}) {op} ({right})"))
        left = right
    return reduce(lambda a, b: a & b, terms)


def row_mean(cols: list[str]) -> Column:
    """Mean over the columns of a row, nulls left out."""
    arr = F.filter(F.array(*[F.col(c).cast("double") for c in cols]), lambda x: x.isNotNull())
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(arr), F.lit(0))


def keep_cells(df: DataFrame, test, cols: list[str] | None = None) -> DataFrame:
    """Numeric cells that pass ``test`` stay, the others become null."""
    return df.withColumns({c: F.when(test(F.col(c)), F.col(c)) for c in cols or numeric_columns(df)})


def ordinal_codes(df: DataFrame, col: str, out: str) -> DataFrame:
    """Position of each value among the sorted distinct values, from 0; null stays null."""
    levels = df.select(col).filter(F.col(col).isNotNull()).distinct()
    coded = scan(levels, [], [col], {"_rn": ("row_number",)})
    return df.join(coded.select(col, (F.col("_rn") - 1).cast("int").alias(out)), col, "left")


def positional(df: DataFrame, order: list[str], start: int = 0, stop: int | None = None, step: int = 1) -> DataFrame:
    """Rows ``start:stop:step`` of the frame in the given order (unique, ascending)."""
    rows = scan(df, [], order, {"_rn": ("row_number",)})
    pos = F.col("_rn") - 1
    keep = (pos >= start) & (F.pmod(pos - start, F.lit(step)) == 0)
    if stop is not None:
        keep = keep & (pos < stop)
    return rows.filter(keep).drop("_rn")


def contains_any(df: DataFrame, col: str, words: list[str]) -> DataFrame:
    """Rows whose text holds any of the words; words are split over several patterns when many."""
    tests = []
    for i in range(0, len(words), WORDS_IN_PATTERN):
        part = "|".join(r"\Q" + w.replace(r"\E", r"\E\\E\Q") + r"\E" for w in words[i : i + WORDS_IN_PATTERN])
        tests.append(F.col(col).rlike(part))
    return df.filter(reduce(lambda a, b: a | b, tests, F.lit(False)))


def transpose(df: DataFrame, index: str, labels: list, block: int = 500) -> DataFrame:
    """Columns become rows. ``labels`` are the index values that become columns; null cells stay null.

    The (column, label, value) cells are pivoted in blocks of labels, and the blocks, one row per column each, are put side
    by side, so neither a pivot nor its code grows with the number of labels.
    """
    values = [c for c in df.columns if c != index]
    text = df.select(F.col(index).alias("_i"), *[F.col(c).cast("string").alias(c) for c in values])
    cells = text.unpivot(["_i"], values, "column_name", "_v")
    out = df.sparkSession.createDataFrame([(c,) for c in values], "column_name string")
    for i in range(0, len(labels), block):
        some = labels[i : i + block]
        wide = cells.filter(F.col("_i").isin(some)).groupBy("column_name").pivot("_i", some).agg(F.first("_v"))
        out = out.join(wide, "column_name", "left")
    return out


def minus_row(df: DataFrame, row: DataFrame, cols: list[str]) -> DataFrame:
    """Subtract the columns of a one-row frame from every row."""
    ref = row.select(F.struct(*cols)).scalar()
    return df.withColumns({c: F.col(c) - ref[c] for c in cols})


def centre(df: DataFrame, cols: list[str]) -> DataFrame:
    """Subtract each column's mean."""
    return minus_row(df, df.agg(*[F.avg(c).alias(c) for c in cols]), cols)
