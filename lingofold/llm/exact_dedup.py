"""Exact deduplication with an extendible-hash index on shared files."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingofold.llm.common import BLANKS, text_or_empty, whole_rows
from lingofold.session import stage_table

KEY_BITS = 63
SLOT_BITS = 16
BUCKET_KEYS = 50_000


def normalised(text: str) -> Column:
    return F.regexp_replace(text_or_empty(text), BLANKS, " ")


def directory(slots: dict[int, int], slot_bits: int, bucket_keys: int) -> dict[int, tuple[int, int]]:
    """Slot -> (first slot of its bucket, local depth).

    Starts with one bucket of depth 0. A bucket with more than ``bucket_keys`` keys is split by
    its next bit; the directory doubles whenever the deepest bucket does. ``slots`` holds at most
    ``2 ** slot_bits`` counts, whatever the size of the corpus; a slot that is still too large is
    split by as many further bits as its keys, which are hashes, need on average.
    """
    entries, waiting = {}, [(0, 0, slots)]
    while waiting:
        start, depth, held = waiting.pop()
        count = sum(held.values())
        if count <= bucket_keys or depth == slot_bits:
            more = max(math.ceil(math.log2(count / bucket_keys)), 0) if count else 0
            entries.update({slot: (start, depth + more) for slot in held})
            continue
        middle = start + (1 << (slot_bits - depth - 1))
        waiting.append((start, depth + 1, {s: n for s, n in held.items() if s < middle}))
        waiting.append((middle, depth + 1, {s: n for s, n in held.items() if s >= middle}))
    return entries


def build_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    key_bits: int = KEY_BITS,
    slot_bits: int = SLOT_BITS,
    bucket_keys: int = BUCKET_KEYS,
) -> tuple[DataFrame, DataFrame]:
    """(index, rows), both written to the shared folder.

    ``index``: one row per distinct text (bucket, local_depth, hash_key, chain_pos, text_sha256,
    keep_id, group_size), ordered by bucket, so that an owner task holds a range of keys. Texts of
    one key are compared byte by byte (they are grouping keys); different texts under one key form
    a chain, numbered by ``chain_pos``. ``rows``: one short row per document (id, hash_key,
    text_sha256). Copies are counted where they are read, before any text is shuffled, so a group
    of copies costs one row per task.
    """
    spark = docs.sparkSession
    text = normalised(text_col)
    key = F.shiftrightunsigned(F.xxhash64(text), 64 - key_bits)
    rows = stage_table(
        docs.select(F.col(id_col), key.alias("hash_key"), F.sha2(text, 256).alias("text_sha256")),
        "exact-rows",
    )
    slot = F.shiftright("hash_key", max(key_bits - slot_bits, 0)).cast("int")
    slot_bits = min(slot_bits, key_bits)
    counts = rows.select("hash_key").distinct().groupBy(slot.alias("slot")).count()
    entries = directory({r["slot"]: r["count"] for r in counts.toLocalIterator()}, slot_bits, bucket_keys)
    table = spark.createDataFrame(
        [(s, min(d, key_bits)) for s, (_, d) in entries.items()], "slot int, local_depth int"
    )
    # a bucket is named by its first key
    bucket = F.expr(f"shiftleft(shiftright(hash_key, {key_bits} - local_depth), {key_bits} - local_depth)")
    texts = (
        docs.select(F.col(id_col), key.alias("hash_key"), text.alias("body"))
        .groupBy("hash_key", "body")
        .agg(F.min(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("hash_key", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    chain = Window.partitionBy("hash_key").orderBy(F.col("keep_id").asc_nulls_last(), "text_sha256")
    index = (
        texts.withColumn("slot", slot)
        .join(F.broadcast(table), "slot")  # at most 2 ** SLOT_BITS rows
        .withColumn("bucket", bucket)
        .withColumn("chain_pos", F.row_number().over(chain))
        .drop("slot")
        .repartitionByRange("bucket", "hash_key")
        .sortWithinPartitions("bucket", "hash_key", "chain_pos")
    )
    return stage_table(index, "exact-index"), rows


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after every run of blanks became one space; null
    counts as empty, so null and empty texts are one group. The row with the smallest id stays;
    a null id comes after all others. Rows that repeat an id and a text are all marked as kept
    (``drop_copies`` leaves one of them). Other columns are not read. An empty table gives no rows.
    """
    index, rows = build_index(docs, id_col, text_col, **options)
    found = index.select("hash_key", "text_sha256", "keep_id", "group_size")
    return rows.join(found, ["hash_key", "text_sha256"]).select(
        id_col, "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one row per distinct text."""
    index, rows = build_index(docs, id_col, text_col, **options)
    text = normalised(text_col)
    wanted = index.select("hash_key", "text_sha256", "keep_id")
    key = F.shiftrightunsigned(F.xxhash64(text), 64 - options.get("key_bits", KEY_BITS))
    found = whole_rows(docs, id=F.col(id_col), hash_key=key, text_sha256=F.sha2(text, 256))
    kept = found.join(wanted, ["hash_key", "text_sha256"]).where(F.col("id").eqNullSafe(F.col("keep_id")))
    repeats = rows.groupBy("hash_key", "text_sha256", id_col).count().where("count > 1").limit(1)
    if not repeats.isEmpty():  # rows that repeat both the id and the text
        kept = kept.dropDuplicates(["hash_key", "text_sha256"])
    return kept.select("row.*")
