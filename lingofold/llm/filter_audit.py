"""What each filter removes under every order of the filters, from removal steps by minimum."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lingofold.llm.common import BLANK_CHARS, BLANKS, attach, text_or_empty
from lingofold.session import ship_package

#: The filters' letters; bit b of a mask says that a document fails filter b.
FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
REPORT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: under 100 words; under 80 % distinct words; over 10 % capitals; a symbol."""
    trimmed = F.btrim(text, F.lit(BLANK_CHARS))
    words = F.split(trimmed, BLANKS)
    count = F.when(trimmed == "", F.lit(0)).otherwise(F.size(words)).cast("long")
    distinct = F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.array_distinct(words))).cast("long")
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    fails = [count < 100, 100 * distinct < 80 * count, 100 * capitals > 10 * F.length(text),
             text.rlike(r"[#$%&*|]")]
    mask = F.lit(0)
    for bit, failed in enumerate(fails):
        mask = mask + F.when(failed, F.lit(1 << bit)).otherwise(F.lit(0))
    return mask


def removal_steps(masks: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """First step (from 0) of each order at which each mask is removed; len(order) if none.

    ``masks`` is (m, f) of 0 and 1, ``orders`` (p, f) filter numbers. A matrix product in which
    sums are minima: inverse permutations hold the place of every filter, passing adds infinity.
    """
    n_filters = orders.shape[1]
    places = np.argsort(orders, axis=1)
    passed = np.where(masks.astype(bool), 0, n_filters)
    return np.minimum((places[None, :, :] + passed[:, None, :]).min(axis=2), n_filters)


def audit_counts(weights: np.ndarray, n_filters: int) -> tuple[np.ndarray, np.ndarray]:
    """(orders, counts) for ``weights`` (parts, masks, 3): documents, good and toxic ones by mask.

    ``counts`` is (parts, orders, steps, len(COUNTS)).
    """
    orders = np.array(list(permutations(range(n_filters))))
    masks = (np.arange(1 << n_filters)[:, None] >> np.arange(n_filters)) & 1
    steps = removal_steps(masks, orders)  # (masks, orders)
    here = steps[:, :, None] == np.arange(n_filters)  # (masks, orders, steps)
    fails = masks[:, orders]  # does the mask fail the filter of this step
    lost = np.einsum("pmw,mos->posw", weights, here.astype(np.int64))
    everyone = weights[:, :, 0].sum(axis=1)
    removed = lost[..., 0]
    earlier = (fails == 1) & (steps[:, :, None] < np.arange(n_filters))
    redundant = np.einsum("pm,mos->pos", weights[:, :, 0], earlier.astype(np.int64))
    alone = weights[:, 1 << orders, 0]
    by_filter = np.zeros((len(weights), n_filters), dtype=np.int64)
    for number in range(n_filters):
        by_filter[:, number] = removed[:, orders == number].sum(axis=1)
    kept = everyone[:, None, None] - np.cumsum(removed, axis=2)
    counts = (kept, removed, redundant, alone, lost[..., 1], lost[..., 2], by_filter[:, orders])
    return orders, np.stack(counts, axis=-1)


def fail_masks(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """part, mask, n, good, toxic: how many documents of a part fail which set of filters.

    Texts are compared by SHA-256. Rows of equal text, part and labels are counted together where
    they are read, so a group of copies of any size is a few rows when it is shuffled; the first
    copy is counted on its own. A document is good (toxic) if any of its label rows says so.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text_or_empty(text_col).alias("body"),
    )
    rows = rows.select(
        "id", "part", text_mask(F.col("body")).alias("mask"), F.unhex(F.sha2("body", 256)).alias("digest"),
    )
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    ).where("id is not null and (good = 1 or toxic = 1)")
    rows = attach(rows, marks, ["id"]).select(
        "part", "mask", "digest", F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"), "id",
    )
    kind = ["digest", "part", "mask", "good", "toxic"]
    # rows of one id are counted first: all rows of a text's smallest id pass the last filter
    groups = rows.groupBy(*kind, "id").agg(F.count(F.lit(1)).alias("n")).groupBy(
        *kind, F.col("id").isNull().alias("no_id")
    ).agg(F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("n_least"))
    first = F.min("least").over(Window.partitionBy("digest"))
    passing = F.when(F.col("no_id"), F.col("n")).when(F.col("least") == first, F.col("n_least")).otherwise(F.lit(0))
    split = groups.select(*kind, "n", passing.alias("passing")).select(
        "part", "good", "toxic",
        F.explode(F.array(
            F.struct(F.col("mask").alias("mask"), F.col("passing").alias("n")),
            F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - F.col("passing")).alias("n")),
        )).alias("x"),
    )
    return split.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.col("good") * F.col("x.n")).alias("good"),
        F.sum(F.col("toxic") * F.col("x.n")).alias("toxic"),
    )


def audit_filters(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """One row per part, order of the five filters and step, with the counts ``COUNTS``.

    A fails under 100 words, B with fewer than 80 % distinct words, C with over 10 % capital letters,
    D with a symbol of ``#$%&*|``, E with the text of a smaller id anywhere in the table. A null text
    is empty (it fails A, and E if not the first); a null part counts as the empty string; a row
    without an id never fails E and is nobody's original. Every repeated row counts; all rows of a
    text's smallest id pass E. Labels of unknown documents and null labels count for nothing. Other
    columns are not read. An empty table gives no rows.

    Documents are counted by part and set of failed filters; a part then holds 32 numbers however
    many documents it has, and parts are worked on in batches in place.
    """
    counted = fail_masks(docs, labels, id_col, text_col, part_col)
    parts = counted.groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks")  # 32 at most
    )
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                weights = np.zeros((1, 1 << len(FILTERS), 3), dtype=np.int64)
                for m in row["masks"]:
                    weights[0, m["mask"]] = m["n"], m["good"], m["toxic"]
                orders, counts = audit_counts(weights, len(FILTERS))
                names = ["".join(FILTERS[f] for f in order) for order in orders]
                flat = counts[0].reshape(-1, len(COUNTS))
                size = len(FILTERS)
                columns = [
                    pa.array([row["part"]] * len(flat)), pa.array(np.repeat(names, size)),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(names))),
                    *[pa.array(flat[:, c]) for c in range(len(COUNTS))],
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *COUNTS])

    return parts.mapInArrow(run, REPORT)
