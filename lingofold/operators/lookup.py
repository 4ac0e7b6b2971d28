"""Joins against lookup tables of unknown size."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 128 << 20
ROW_OVERHEAD = 32
#: Keys followed by the frequency sketch, and hot keys at the most.
TRACKED_KEYS = 65_536
MAX_HOT_KEYS = 4_096


def _width(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(field.dataType, T.ArrayType):
        return F.greatest(F.size(column), F.lit(0)) * 8
    return F.lit(8)


def measured_bytes(table: DataFrame) -> int:
    """Size of the rows in memory, summed over the table in one pass."""
    width = reduce(add, [_width(f) for f in table.schema.fields], F.lit(ROW_OVERHEAD))
    return table.agg(F.sum(width.cast("bigint")).alias("b")).first()["b"] or 0


def hot_hashes(rows: DataFrame, on: list[str], most: int = MAX_HOT_KEYS) -> list[int]:
    """Hashes of the keys that alone fill half a shuffle partition, from one pass over ``rows``.

    Frequent-item sketches of the tasks are merged, so neither keys nor rows are collected. An
    estimate decides only which way a row takes, never the result.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.select(F.xxhash64(*on).alias("k")).agg(
        F.expr(f"approx_top_k(k, {most}, {TRACKED_KEYS})").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    return [item["item"] for item in found["top"] if item["count"] * 2 * parts > found["n"]]


def skew_join(
    rows: DataFrame, table: DataFrame, on: list[str], how: str = "left", salt_by: list[str] | None = None,
    max_hot_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Shuffle join to a table with unique ``on`` in which no key of ``rows`` is too large for a task.

    Only the table rows of hot keys are broadcast (``MAX_HOT_KEYS`` rows, and not more than
    ``max_hot_bytes``); the rows of a hot key are dealt over all tasks by ``salt_by`` and take their
    values from there. All other rows meet the table in a plain join. No row of the table is copied,
    and without hot keys this is the plain join. Null keys match nothing, also in ``on`` of the table.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"no such join: {how}")
    hot = hot_hashes(rows, on)
    values = [c for c in table.columns if c not in on]
    if hot:
        own = table.where(F.xxhash64(*on).isin(hot))
        if measured_bytes(own) > max_hot_bytes:
            hot = []
    if not hot:
        return rows.join(table, on, how)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    others = [c for c in rows.columns if c not in on]
    spread = F.pmod(F.xxhash64(*(salt_by or others or on)), F.lit(parts)) + 1
    marked = rows.withColumn(
        "__salt", F.when(F.xxhash64(*on).isin(hot), spread).otherwise(F.lit(0)).cast("int")
    )
    cold_table = table.select(
        *on, F.struct(*values, F.lit(True).alias("__met")).alias("__cold"), F.lit(0).alias("__salt")
    )
    hot_table = own.select(*on, F.struct(*values, F.lit(True).alias("__met")).alias("__hot"))
    joined = marked.join(cold_table, [*on, "__salt"], "left").join(F.broadcast(hot_table), on, "left")
    joined = joined.select(*on, *others, F.coalesce("__cold", "__hot").alias("__v"))
    if how == "inner":
        joined = joined.where("__v.__met")
    return joined.select(*on, *others, *[F.col(f"__v.{c}").alias(c) for c in values])


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "left",
    max_broadcast_bytes: int = BROADCAST_BYTES,
    salt_by: list[str] | None = None,
) -> DataFrame:
    """Join many rows to a table with unique ``on``, e.g. tokens to a lexicon.

    The table is measured first: below the bound it is broadcast, a larger one is joined by
    ``skew_join``, which broadcasts the rows of hot keys only.
    """
    if measured_bytes(table) <= max_broadcast_bytes:
        return rows.join(F.broadcast(table), on, how)
    return skew_join(rows, table, on, how, salt_by)
