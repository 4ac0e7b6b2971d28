"""Request files and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Alternative names a field may arrive under.
FIELD_ALIASES = {"SRC_LANG": ("LANG_ID",), "LANG_ID": ("SRC_LANG",)}


def request_schema(fields: dict[str, str]) -> T.StructType:
    names = list(fields)
    for name in fields:
        names += [a for a in FIELD_ALIASES.get(name, ()) if a not in names]
    types = {**{a: fields[n] for n in fields for a in FIELD_ALIASES.get(n, ())}, **fields}
    element = ", ".join(f"{n}: array<{types[n]}>" for n in names)
    return T._parse_datatype_string(f"data array<struct<{element}>>")


def unpack_requests(df: DataFrame, fields: dict[str, str], lists: tuple[str, ...] = ()) -> DataFrame:
    """``data`` array -> one row per request, first value of each field (whole list for ``lists``)."""
    known = set(df.schema["data"].dataType.elementType.names)
    rows = df.select("*", F.posexplode("data").alias("request_id", "__r")).drop("data")
    for name in fields:
        sources = [n for n in (name, *FIELD_ALIASES.get(name, ())) if n in known]
        values = [
            F.col(f"__r.{n}") if name in lists else F.get(F.col(f"__r.{n}"), F.lit(0))
            for n in sources
        ]
        rows = rows.withColumn(name.lower(), F.coalesce(*values))
    return rows.drop("__r")


def read_requests(
    spark: SparkSession,
    path: str,
    fields: dict[str, str],
    lists: tuple[str, ...] = (),
    multi_line: bool = True,
) -> DataFrame:
    """``{"data": [{FIELD: [value]}]}`` files -> rows keyed by ``(file, request_id)``.

    ``fields`` maps field names to Spark types. A field that is missing in a request is null.
    Large feeds hold one such object per line: ``multi_line=False`` lets Spark split the files.
    """
    raw = (
        spark.read.option("multiLine", multi_line)
        .schema(request_schema(fields))
        .json(path)
        .select("data", F.col("_metadata.file_path").alias("file"))
    )
    return unpack_requests(raw, fields, lists)


def split_results(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a result, rows with an error)."""
    return df.filter("error is null").drop("error"), df.filter("error is not null").select(
        *[c for c in df.columns if c.endswith("_id")], "error"
    )


def write_results(
    df: DataFrame,
    ok_path: str,
    err_path: str,
    partition_by: str | None = None,
    mode: str = "errorifexists",
    staging_path: str | None = None,
) -> None:
    """Write every row to exactly one of two tables.

    The rows are computed once: with ``staging_path`` they are written there first and both
    tables are filled from it, otherwise the evaluated rows are persisted for the two writes.
    """
    if staging_path:
        df.write.mode("overwrite").parquet(staging_path)
        rows = df.sparkSession.read.schema(df.schema).parquet(staging_path)
    else:
        rows = df.persist()
    ok, err = split_results(rows)
    writer = ok.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(ok_path)
    err.write.mode(mode).parquet(err_path)
    if not staging_path:
        rows.unpersist()
