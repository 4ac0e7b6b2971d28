"""Samples of classes and of rows per class."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_class(df: DataFrame, label_col: str, order_col: str, n: int) -> DataFrame:
    """The first ``n`` rows of each class in ``order_col`` order.

    The rank filter lets Spark drop all but ``n`` rows per class in every map task, so a class
    that holds most of the table does not land in one task.
    """
    window = Window.partitionBy(label_col).orderBy(order_col)
    return df.withColumn("__n", F.row_number().over(window)).filter(F.col("__n") <= n).drop("__n")


def sample_per_class(
    df: DataFrame, label_col: str, order_col: str, n_classes: int = 0, n: int = 0, seed: int = 0
) -> DataFrame:
    """``n_classes`` classes in seeded hash order, the first ``n`` rows of each; 0 means all."""
    rows = df
    if n_classes:
        labels = df.select(label_col).distinct()
        order = F.md5(F.concat_ws(":", F.lit(seed), F.col(label_col).cast("string")))
        chosen = labels.orderBy(order, label_col).limit(n_classes)
        rows = rows.join(chosen, label_col, "left_semi")
    return first_per_class(rows, label_col, order_col, n) if n else rows
