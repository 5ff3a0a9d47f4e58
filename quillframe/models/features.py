"""Feature preparation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.operators import missing
from quillframe.operators.binning import count_edges
from quillframe.operators.project import ordinal_codes
from quillframe.plans.quantiles import quantile_edges, quantiles
from quillframe.plans.seeded import uniform


def flag(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Two-valued text columns to boolean: true for the given word."""
    return df.withColumns({c: F.col(c) == yes for c, yes in cols.items()})


@dataclass(frozen=True)
class Scaler:
    """Means and population deviations fitted on one frame, to apply to any other."""

    stats: dict[str, tuple[float, float]]

    @staticmethod
    def fit(df: DataFrame, cols: list[str]) -> Scaler:
        r = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
        return Scaler({c: (r[f"m_{c}"], r[f"s_{c}"]) for c in cols})

    def transform(self, df: DataFrame) -> DataFrame:
        """A constant column is only centred."""
        return df.withColumns({c: (F.col(c) - m) / (s or 1.0) for c, (m, s) in self.stats.items()})


def dummies(df: DataFrame, col: str, levels: list, prefix: str | None = None) -> DataFrame:
    """One 0/1 column per level."""
    return df.withColumns({f"{prefix or col}_{v}": F.coalesce((F.col(col) == v).cast("int"), F.lit(0)) for v in levels})


def label_index(df: DataFrame, col: str, out: str) -> DataFrame:
    return ordinal_codes(df, col, out)


def quantile_bins(df: DataFrame, col: str, q: int, out: str) -> DataFrame:
    """Right-closed bins of equal size by exact quantiles; the lowest value belongs to bin 0."""
    edges = quantile_edges(df, col, [i / q for i in range(1, q)])
    return df.withColumn(out, count_edges(F.col(col), edges, inclusive=False))


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)


@dataclass(frozen=True)
class OrderCleaner:
    """A fitted cleaning pipeline: encode, impute by group median, derive, drop."""

    medians: DataFrame
    keys: list[str]
    col: str

    @staticmethod
    def fit(df: DataFrame, keys: list[str], col: str) -> OrderCleaner:
        return OrderCleaner(quantiles(df, keys, col, {"_median": 0.5}), keys, col)

    def transform(self, df: DataFrame, text: list[str], derived: dict[str, Column]) -> DataFrame:
        filled = df.join(self.medians, self.keys, "left").withColumn(self.col, F.coalesce(self.col, "_median")).drop("_median")
        for c in text:
            filled = missing.impute_mode(filled, c)
            filled = ordinal_codes(filled, c, f"{c}_code")
        return filled.withColumns(derived).drop(*text)


def folds(df: DataFrame, k: int, seed: int, *ids: str, out: str = "fold") -> DataFrame:
    return df.withColumn(out, F.floor(uniform(seed, *ids) * k).cast("int"))


def radial(df: DataFrame, vec: str, out: str = "features") -> DataFrame:
    """All elements x of an array and exp(-|x|^2), the radial feature that makes concentric classes linearly separable."""
    x = F.col(vec).cast("array<double>")
    square = F.aggregate(x, F.lit(0.0), lambda total, e: total + e * e)
    return df.withColumn(out, array_to_vector(F.concat(x, F.array(F.exp(-square)))))
