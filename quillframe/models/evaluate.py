"""Evaluation of predictions as table operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.operators.binning import digitize
from quillframe.plans.ordered import scan, with_group_stats


def accuracy(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, y: str, yhat: str, classes: list) -> DataFrame:
    """Actual classes as rows, predicted ones as columns."""
    return df.groupBy(F.col(y).alias("actual")).pivot(yhat, classes).agg(F.count(F.lit(1))).fillna(0)


def class_report(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """(class, precision, recall, f1, support); an undefined ratio is 0."""
    pairs = df.groupBy(y, yhat).agg(F.count(F.lit(1)).alias("n"))
    both = pairs.select(F.explode(F.array(
        F.struct(F.col(y).alias("class"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted"), F.lit(0).cast("bigint").alias("hit")),
        F.struct(F.col(yhat).alias("class"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("predicted"),
                 F.when(F.col(y) == F.col(yhat), F.col("n")).otherwise(0).alias("hit")))).alias("s")).select("s.*")
    t = both.groupBy("class").agg(F.sum("actual").alias("support"), F.sum("predicted").alias("_p"), F.sum("hit").alias("_h"))
    zero = F.lit(0.0)
    t = t.withColumn("precision", F.coalesce(F.try_divide("_h", "_p"), zero)).withColumn("recall", F.coalesce(F.try_divide("_h", "support"), zero))
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return t.withColumn("f1", F.coalesce(f1, zero)).drop("_p", "_h")


def roc_points(df: DataFrame, score: str, label: str, keys: list[str] = ()) -> DataFrame:
    """(keys, threshold, tpr, fpr, pos, neg, ...): one point per distinct score, from the highest down."""
    keys = list(keys)
    g = df.groupBy(*keys, F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")).withColumn("_o", -F.col("threshold"))
    c = scan(g, keys, ["_o"], {"tp": ("sum", "_pos"), "fp": ("sum", "_neg")})
    s = with_group_stats(c, keys, {"P": F.sum("_pos"), "N": F.sum("_neg")})
    return s.withColumns({"tpr": F.col("tp") / F.col("P"), "fpr": F.col("fp") / F.col("N")}).drop("_o")


def auc(points: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Area under the curve by trapezoids, ties in one step."""
    step = F.col("_neg") * (F.col("tp") - F.col("_pos") / 2)
    return points.groupBy(*keys).agg((F.sum(step) / (F.max("P") * F.max("N"))).alias("auc"))


def mean_curve(points: DataFrame, fold: str, steps: int = 100) -> DataFrame:
    """(i, x, tpr): curves of the folds interpolated at even positions and averaged; starts at 0, ends at 1."""
    vertical = points.groupBy(fold, "fpr").agg(F.min("tpr").alias("lo"), F.max("tpr").alias("hi"))
    start = points.select(fold).distinct().select(fold, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("lo"), F.lit(0.0).alias("hi"))
    known = vertical.unionAll(start).groupBy(fold, "fpr").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(i / (steps - 1)).alias("x")) for i in range(steps)])
    asked = points.select(fold).distinct().withColumn("g", F.explode(grid)).select(fold, F.col("g.i").alias("i"), F.col("g.x").alias("fpr"))
    k = known.select(fold, "fpr", F.lit(-1).alias("i"), F.struct(F.col("fpr").alias("x"), F.col("hi").alias("y")).alias("left"),
                     F.struct(F.col("fpr").alias("x"), F.col("lo").alias("y")).alias("right"))
    merged = k.unionByName(asked, allowMissingColumns=True)
    near = scan(merged, [fold], ["fpr", "i"], {"a": ("last", "left"), "b": ("next", "right")}).filter("i >= 0")
    x0, y0, x1, y1 = F.col("a.x"), F.col("a.y"), F.col("b.x"), F.col("b.y")
    y = F.when(F.col("b").isNull(), y0).otherwise(y0 + (y1 - y0) * (F.col("fpr") - x0) / (x1 - x0))
    return near.groupBy("i").agg(F.max("fpr").alias("x"), F.avg(y).alias("tpr")).withColumn(
        "tpr", F.when(F.col("i") == 0, 0.0).when(F.col("i") == steps - 1, 1.0).otherwise(F.col("tpr")))


def judgement(df: DataFrame, prob: str, outcome: str, bins: int = 10) -> DataFrame:
    """Calibration (lower is better) and discrimination (higher is better) over probability bins [a, b)."""
    b = digitize(F.col(prob), [i / bins for i in range(bins + 1)])
    g = df.groupBy(b.alias("_b")).agg(F.count(F.lit(1)).alias("n"), F.avg(prob).alias("p"), F.avg(outcome).alias("o"))
    g = with_group_stats(g, [], {"_N": F.sum("n"), "_base": F.sum(F.col("n") * F.col("o")) / F.sum("n")})
    return g.agg((F.sum(F.col("n") * F.pow(F.col("p") - F.col("o"), 2)) / F.max("_N")).alias("calibration"),
                 (F.sum(F.col("n") * F.pow(F.col("o") - F.col("_base"), 2)) / F.max("_N")).alias("discrimination"))


def rate_table(df: DataFrame, prob: str, outcome: str) -> DataFrame:
    """(pred_prob, count, true_prob)."""
    return df.groupBy(F.col(prob).alias("pred_prob")).agg(F.count(F.lit(1)).alias("count"), F.avg(outcome).alias("true_prob"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """(label, n, share, ratio to an even share)."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    s = with_group_stats(n, [], {"_N": F.sum("n"), "_k": F.count(F.lit(1))})
    return s.select(label, "n", (F.col("n") / F.col("_N")).alias("share"), (F.col("n") * F.col("_k") / F.col("_N")).alias("ratio"))
