"""Image files with a class label in their name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingofold.functions.text import label_from_path
from lingofold.operators.sampling import first_per_class


def read_image_dir(
    spark: SparkSession, path: str, n_per_class: int | None = None, pattern: str | None = None
) -> DataFrame:
    """Regular files below class folders -> (path, label, content).

    ``n_per_class`` keeps the first files of each class in path order; the choice itself reads
    names only.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path).withColumn("label", label_from_path(F.col("path")))
    if n_per_class:
        chosen = first_per_class(files.select("path", "label"), "label", "path", n_per_class)
        files = files.join(chosen.select("path"), "path", "left_semi")
    return files.select("path", "label", "content")
