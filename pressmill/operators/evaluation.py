"""Evaluation of predictions: confusion, class metrics, threshold grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def class_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per class: support, precision, recall, f1 (0 where undefined), from one aggregated confusion table."""
    c = confusion(df, actual, predicted)
    each = c.select(F.col("actual").alias("label")).union(c.select("predicted")).distinct()
    rows = each.crossJoin(c)  # at most classes cubed
    hit, said, true = (F.sum(F.when(t, F.col("n")).otherwise(0)) for t in ((F.col("actual") == F.col("label")) & (F.col("predicted") == F.col("label")), F.col("predicted") == F.col("label"), F.col("actual") == F.col("label")))
    m = rows.groupBy("label").agg(hit.alias("hit"), said.alias("said"), true.alias("support"))
    p, r = F.coalesce(F.try_divide(F.col("hit").cast("double"), "said"), F.lit(0.0)), F.coalesce(F.try_divide(F.col("hit").cast("double"), "support"), F.lit(0.0))
    return m.select("label", "support", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"))


def summary(df: DataFrame, actual: str, predicted: str, classes: tuple[str, ...] = ("Positif", "Netral", "Negatif"), neutral: str = "Netral", negative: str = "Negatif") -> DataFrame:
    """One row: accuracy, macro_f1 over the classes, predicted per actual negatives, and the figures of always saying the neutral class."""
    c = confusion(df, actual, predicted)
    n = F.col("n")
    total = lambda test: F.coalesce(F.sum(F.when(test, n)), F.lit(0)).cast("double")
    is_, said = (lambda k: F.col("actual") == k), (lambda k: F.col("predicted") == k)
    sums = [F.sum("n").alias("total"), total(F.col("actual") == F.col("predicted")).alias("correct")]
    for i, k in enumerate(classes):
        sums += [total(is_(k) & said(k)).alias(f"hit{i}"), total(said(k)).alias(f"said{i}"), total(is_(k)).alias(f"true{i}")]
    of = c.agg(*sums)
    f1 = sum((F.coalesce(F.try_divide(2 * F.col(f"hit{i}"), F.col(f"said{i}") + F.col(f"true{i}")), F.lit(0.0)) for i in range(len(classes))), F.lit(0.0)) / len(classes)
    calm, bad = classes.index(neutral), classes.index(negative)
    ratio = F.when(F.col(f"true{bad}") > 0, F.col(f"said{bad}") / F.col(f"true{bad}")).when(F.col(f"said{bad}") == 0, 0.0)
    always = F.coalesce(F.try_divide(2 * F.col(f"true{calm}"), F.col("total") + F.col(f"true{calm}")), F.lit(0.0)) / len(classes)
    return of.select("total", (F.col("correct") / F.col("total")).alias("accuracy"), f1.alias("macro_f1"), ratio.alias("negative_ratio"), (F.col(f"true{calm}") / F.col("total")).alias("always_accuracy"), always.alias("always_macro_f1"))


def threshold_grid(df: DataFrame, score: str, margin: str, correct: str, scores: list[float], margins: list[float]) -> DataFrame:
    """Coverage and precision of accepting rows at each pair of thresholds, in one pass over df."""
    grid = F.array(*(F.struct(F.lit(s).alias("min_score"), F.lit(m).alias("min_margin")) for s in scores for m in margins))
    each = df.select(F.col(score).alias("s"), F.col(margin).alias("m"), F.col(correct).alias("c"), F.explode(grid).alias("g"))
    taken = (F.col("s") >= F.col("g.min_score")) & (F.col("m") >= F.col("g.min_margin"))
    out = each.groupBy("g.min_score", "g.min_margin").agg(F.count("*").alias("n"), F.count_if(taken).alias("accepted"), F.count_if(taken & F.col("c")).alias("right"))
    return out.select("min_score", "min_margin", "accepted", (F.col("accepted") / F.col("n")).alias("coverage"), F.coalesce(F.try_divide(F.col("right").cast("double"), "accepted"), F.lit(0.0)).alias("precision"))
