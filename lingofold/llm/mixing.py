"""Mixing sources to target weights by hash-random order and exact token budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingofold.llm.common import whole_rows, word_count
from lingofold.session import stage_table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2


def random_key(id_col: str) -> Column:
    """A 60-bit number from the id alone, so reruns agree."""
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def targets(sizes: DataFrame, source_col: str = "source") -> DataFrame:
    """Target of each source. ``sizes``: one row per source (source, docs, source_size).

    A source takes ``level * weight`` words, at most its size times the most epochs. The level at
    which all targets add up follows from running sums over the sources in the order in which they
    reach their limit. Only this table of sources, never a table of documents, meets in one task.
    """
    by_name = Window.orderBy(F.col(source_col).asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    ranked = sizes.withColumn("at", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(weights, F.col("at") % len(WEIGHTS) + 1)
    ).withColumn("most", F.col("source_size") * MOST_EPOCHS)
    everything = Window.partitionBy()
    full = Window.orderBy(F.col("most") / F.col("weight"), "at").rowsBetween(Window.unboundedPreceding, 0)
    rest = Window.orderBy(F.col("most") / F.col("weight"), "at").rowsBetween(1, Window.unboundedFollowing)
    level = (F.lit(SHARE) * F.col("total") - F.col("full_before")) / F.col("open_weight")
    levels = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full_before", F.sum("most").over(full) - F.col("most"))
        .withColumn("open_weight", F.coalesce(F.sum("weight").over(rest), F.lit(0)) + F.col("weight"))
        .withColumn("level_here", level)
        # the first source in this order that its level does not fill sets the level of all later ones
        .withColumn("open", F.col("level_here") * F.col("weight") <= F.col("most"))
    )
    first_open = F.min(F.when(F.col("open"), F.struct(F.col("most") / F.col("weight"), "at", "level_here"))).over(everything)
    return levels.withColumn("water", first_open["level_here"]).select(
        source_col, "docs", "source_size",
        F.least(F.col("most").cast("double"), F.coalesce(F.col("water") * F.col("weight"), F.col("most").cast("double"))).alias("target"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per document: id, source, size, source_size, target, taken.

    ``size`` counts words (null text: 0). A source with target t and size S gives every document
    ``floor(t / S)`` times and then documents in hash-random order until exactly ``floor(t)`` words
    are reached; the document at the cut gives the words that are left. Ties of the key are ordered
    by id and size. A null source is a source of its own (the last one), a null id orders first;
    repeated rows count as separate documents. An empty table gives no rows.

    The documents of a source are dealt over about sqrt(rows) equal ranges of the random key: sums
    of the ranges give each range its offset, running sums inside a range give the position. So a
    source with a third of all rows is many short windows. Texts are read once.
    """
    rows = stage_table(
        docs.select(
            F.col(id_col), F.col(source_col), word_count(text_col).alias("size"), random_key(id_col).alias("key")
        ),
        "mix-rows",
    )
    sizes = rows.groupBy(source_col).agg(
        F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size")
    )
    plan = stage_table(targets(sizes, source_col), "mix-targets")
    count = plan.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("n")).first()["n"]
    bits = max(int(count).bit_length() // 2, 1)
    ranges = rows.withColumn("range", F.shiftright("key", 60 - bits))
    same = ["__source", "__null", "range"]
    ranges = ranges.withColumns({
        "__source": F.coalesce(F.col(source_col), F.lit("")), "__null": F.col(source_col).isNull()
    })
    offsets = ranges.groupBy(*same).agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy("__source", "__null").orderBy("range")
    offsets = offsets.withColumn("offset", F.sum("range_size").over(before) - F.col("range_size"))
    inside = Window.partitionBy(*same).orderBy("key", id_col, "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        ranges.join(offsets.drop("range_size"), same)
        .withColumn("before", F.col("offset") + F.sum("size").over(inside) - F.col("size"))
    )
    goals = plan.select(
        F.coalesce(F.col(source_col), F.lit("")).alias("__source"), F.col(source_col).isNull().alias("__null"),
        "source_size", "target", F.floor("target").alias("budget"),
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0))
    extra = F.least(F.col("size"), F.greatest(F.lit(0), F.col("rest") - F.col("before")))
    return (
        placed.join(goals, ["__source", "__null"])
        .withColumn("epochs", epochs)
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
        .select(
            id_col, source_col, "size", "source_size", "target",
            (F.col("epochs") * F.col("size") + extra).cast("bigint").alias("taken"),
        )
    )


def repeat_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mixed corpus: rows of ``docs`` as often as the mix takes them, wholly or in part.

    The document at a source's cut is given whole; documents without words are never taken. Ids
    should be unique here; rows that repeat an id share the largest number taken for it.
    """
    copies = (
        mix(docs, id_col, source_col, text_col)
        .where("taken > 0")
        .groupBy(F.col(id_col).alias("taken_id"))
        .agg(F.max(F.ceil(F.col("taken") / F.col("size"))).cast("int").alias("copies"))
    )
    rows = whole_rows(docs, id=F.col(id_col))
    joined = rows.join(copies, F.col("id").eqNullSafe(F.col("taken_id")))
    return joined.select("row", F.explode(F.expr("sequence(1, copies)"))).select("row.*")
