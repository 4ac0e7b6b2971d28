"""Words, byte words and size-checked joins shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lingofold.operators.lookup import measured_bytes
from lingofold.session import ship_package

BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
BROADCAST_BYTES = 64 << 20
CACHED_WORDS = 100_000
ROWS_PER_STEP = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: str | Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    trimmed = F.btrim(text_or_empty(text), F.lit(BLANK_CHARS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, BLANKS))).cast("bigint")


def byte_words(text: str | None) -> list[bytes]:
    """The same words as UTF-8 (``bytes.split`` splits at exactly these six blanks)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


class WordHashes(dict):
    """64-bit hashes of byte words, remembered in a table of bounded size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def only_keys(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose ``on`` is in ``keys``: broadcast when the measured keys are small, else shuffled."""
    keys = keys.select(*on)
    if measured_bytes(keys) <= BROADCAST_BYTES:
        keys = F.broadcast(keys)
    return rows.join(keys, on, "left_semi")


def attach(rows: DataFrame, table: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join to a table that is unique on ``on``; a large one is shuffled, and Spark splits skew."""
    if measured_bytes(table) <= BROADCAST_BYTES:
        table = F.broadcast(table)
    return rows.join(table, on, how)


def whole_rows(docs: DataFrame, **columns: Column) -> DataFrame:
    """``row``, a struct of all columns, and the given ones: no name can clash with those of ``docs``."""
    return docs.select(F.expr("struct(*)").alias("row"), *[c.alias(name) for name, c in columns.items()])


def given_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what Arrow held of earlier ones goes back to the system, as workers live on."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def map_batches(rows: DataFrame, fn, schema: str, step: int = ROWS_PER_STEP) -> DataFrame:
    """Apply ``fn(dict of python lists) -> dict of lists`` to ``step`` rows of an Arrow batch at a time,
    in place (no shuffle)."""
    ship_package(rows.sparkSession)
    target = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(batches):
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                out = fn(part.to_pydict())
                arrays = [pa.array(out[f.name], f.type) for f in target]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return rows.mapInArrow(run, schema)


def labelled(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` with a column ``label``; of several labels the smallest holds, null ones do not count."""
    marks = labels.where(F.col(label).isNotNull()).groupBy(F.col("doc_id").alias(id_col)).agg(
        F.min(label).alias("label")
    )
    return docs.drop("label").join(marks, id_col)
