"""Corpora: class maps, wide and aligned parallel texts, golden segments, code tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_class_map(lines: DataFrame, column: str = "value") -> DataFrame:
    """``label word word ...`` lines -> (label, description) with single blanks."""
    parts = F.split(F.btrim(F.col(column), F.lit(" \t\r")), "[ \t\r]+")
    return lines.filter(F.btrim(F.col(column), F.lit(" \t\r")) != "").select(
        F.get(parts, F.lit(0)).alias("label"),
        F.array_join(F.slice(parts, F.lit(2), F.size(parts)), " ").alias("description"),
    )


def read_class_map(spark: SparkSession, path: str) -> DataFrame:
    return parse_class_map(spark.read.text(path))


def read_parallel_wide(df: DataFrame, langs: list[str], id_col: str = "id") -> DataFrame:
    """One column per ``sentence_<lang>_<script>`` -> rows (id, lang, script, sentence).

    ``langs`` may be ``lang`` or ``lang_script``; the first column with the prefix is used and
    a language without a column is an error, found before any data is read.
    """
    chosen = []
    for lang in langs:
        found = [c for c in df.columns if c.startswith(f"sentence_{lang}")]
        if not found:
            raise ValueError(f"no column sentence_{lang}* in the corpus")
        chosen.append(found[0])
    long = df.unpivot(id_col, list(dict.fromkeys(chosen)), "__column", "sentence")
    return long.select(
        F.col(id_col),
        F.split_part("__column", F.lit("_"), F.lit(2)).alias("lang"),
        F.split_part("__column", F.lit("_"), F.lit(3)).alias("script"),
        "sentence",
    )


def read_aligned_pairs(
    df: DataFrame, idx_col: str = "idx", first: str = "sentence1", second: str = "sentence2"
) -> DataFrame:
    """Two aligned columns -> rows (side 1 or 2, idx, text); ``idx`` is given, never invented."""
    return (
        df.unpivot(idx_col, [first, second], "__column", "text")
        .select(
            F.when(F.col("__column") == first, 1).otherwise(2).alias("side"),
            F.col(idx_col).alias("idx"),
            "text",
        )
    )


GOLDEN_TYPE = "map<string,array<struct<title:string,text:string,target:array<string>>>>"


def read_golden_segments(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """``{"en": [{title, text, target}]}`` files -> (lang, case_id, title, text, target).

    Large collections hold one such object per line: without ``whole_files`` Spark splits the files.
    """
    files = spark.read.text(path, wholetext=whole_files)
    cases = files.select(F.explode(F.from_json("value", GOLDEN_TYPE)).alias("lang", "cases"))
    return cases.select("lang", F.posexplode("cases").alias("case_id", "c")).select(
        "lang", "case_id", "c.title", "c.text", "c.target"
    )


def read_macrolanguages(spark: SparkSession, path: str) -> DataFrame:
    """The published tab-separated ISO 639-3 macrolanguage table -> (macro, member)."""
    rows = spark.read.option("sep", "\t").option("header", True).schema(
        "macro string, member string, status string"
    ).csv(path)
    return rows.filter("status = 'A'").select("macro", "member")
