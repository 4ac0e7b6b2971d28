"""Near-duplicates by an inverted join on coordinates of MinHash signatures."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingofold.llm.common import WordHashes, attach, map_batches, only_keys, whole_rows
from lingofold.llm.components import components
from lingofold.operators.lookup import lookup_join
from lingofold.session import stage_table

WORDS = 5
SIMILAR_PERCENT = 80
COORDINATES = 64
#: Pairs with fewer equal coordinates are not looked at. A pair at the similarity bound has 51 of 64
#: on average and fewer than 26 with probability 5e-11.
MATCHES = 26
BLOCK = 4096
BLOCK_TEXTS = 512
TASK_TEXTS = 1500
PRIME = np.uint64(0x100000001B3)
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text, A-Z in lower case."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.zeros(0, dtype=np.uint64)
    width = min(words, len(found))
    codes = np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=len(found))
    n = len(codes) - width + 1
    mixed = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        mixed = (mixed ^ codes[k : k + n]) * MIX
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20_24)
    a = random.integers(1, 1 << 63, size=(count, 1), dtype=np.uint64) | np.uint64(1)
    return a, random.integers(0, 1 << 63, size=(count, 1), dtype=np.uint64)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over a set, block after block so that memory is bounded."""
    least = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), BLOCK):
        np.minimum(least, (shingles[start : start + BLOCK] * a + b).min(axis=1), out=least)
    return least.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """id, n_shingles, set_hash (128 bits of the whole set; null without words), signature."""
    a, b = _multipliers(COORDINATES)
    hashes = WordHashes()

    def sketch(batch: dict) -> dict:
        sets = [shingle_set(t, words, hashes) for t in batch[text_col]]
        return {
            "id": batch[id_col],
            "n_shingles": [len(s) for s in sets],
            "set_hash": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
            "signature": [signature(s, a, b) if len(s) else None for s in sets],
        }

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), sketch, f"id {kind}, n_shingles long, set_hash binary, signature array<long>")


def prefix_postings(texts: DataFrame, matches: int) -> DataFrame:
    """(posting, id, centre): the coordinate values under which a text is looked up.

    Values that no other text has cannot match and are dropped. A text left with m values needs
    ``matches`` of them, so two texts that match share one of the rarest m - matches + 1 of each:
    only that prefix is posted, and a text with fewer than ``matches`` values is skipped.
    """
    postings = texts.select("id", F.posexplode("signature").alias("at", "value")).select(
        "id", F.xxhash64("at", "value").alias("posting")
    )
    shared = postings.groupBy("posting").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    held = F.sort_array(F.collect_list(F.struct("texts", "posting")))  # at most one per coordinate
    return (
        postings.join(shared, "posting")
        .groupBy("id")
        .agg(held.alias("held"))
        .where(F.size("held") >= matches)
        .withColumn("centre", F.aggregate("held", F.lit(0).cast("bigint"), lambda s, h: s + h["texts"]))
        .withColumn("held", F.expr(f"slice(held, 1, size(held) - {matches - 1})"))
        .select("id", "centre", F.explode("held.posting").alias("posting"))
    )


def head_members(postings: DataFrame) -> DataFrame:
    """(head, id): each text with the most central text of each of its postings.

    Two texts that share a posting share its head, and there are no more rows than postings.
    """
    heads = postings.groupBy("posting").agg(F.max_by("id", F.struct("centre", "id")).alias("head"))
    return postings.join(heads, "posting").select("head", "id").distinct()


def shingle_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, shingles) of the documents in ``ids`` (id), from their whole texts."""
    hashes = WordHashes()

    def read(batch: dict) -> dict:
        return {"id": batch[id_col], "shingles": [shingle_set(t, words, hashes).view(np.int64) for t in batch[text_col]]}

    kind = docs.schema[id_col].dataType.simpleString()
    wanted = only_keys(docs.select(id_col, text_col), ids.select(F.col("id").alias(id_col)), [id_col])
    return map_batches(wanted, read, f"id {kind}, shingles array<long>").dropDuplicates(["id"])


def confirm(pairs: DataFrame, texts: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int, matches: int, percent: int) -> DataFrame:
    """Pairs (a, b) with enough equal coordinates whose whole shingle sets reach the similarity."""
    signatures = texts.select("id", "signature")
    left = signatures.select(F.col("id").alias("a"), F.col("signature").alias("sa"))
    right = signatures.select(F.col("id").alias("b"), F.col("signature").alias("sb"))
    equal = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda same: same))
    close = stage_table(pairs.join(left, "a").join(right, "b").where(equal >= matches).select("a", "b"), "close-pairs")
    needed = close.select(F.col("a").alias("id")).union(close.select("b")).distinct()
    sets = shingle_sets(docs, needed, id_col, text_col, words)
    both = F.size(F.array_intersect("xa", "xb"))
    return (
        close.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("xa")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("xb")), "b")
        .where(100 * both >= percent * (F.size("xa") + F.size("xb") - both))
        .select("a", "b")
    )


def links_between(few: list[np.ndarray], many: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Index pairs of sets that reach the similarity, by one pass over an inverted list."""
    sizes = np.array([len(s) for s in many])
    shingles, owner = np.concatenate(many), np.repeat(np.arange(len(many)), sizes)
    order = np.argsort(shingles, kind="stable")
    shingles, owner = shingles[order], owner[order]
    found = []
    for i, own in enumerate(few):
        lo, hi = np.searchsorted(shingles, own, "left"), np.searchsorted(shingles, own, "right")
        counts = hi - lo
        at = np.repeat(lo - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        both = np.bincount(owner[at], minlength=len(many))
        good = (both > 0) & (100 * both >= percent * (len(own) + sizes - both))
        found.extend((i, int(j)) for j in np.flatnonzero(good))
    return found


def cross_links(members: DataFrame, groups: DataFrame, sets_of, percent: int) -> DataFrame:
    """Links between texts that have a head in common and are not connected yet.

    Under each head the texts outside its largest group meet all texts of other groups; inside a
    group there is nothing to find, so a large group of copies costs its size. The texts of a head
    are cut into blocks of ``BLOCK_TEXTS``; a task gets whole pairs of blocks, about
    ``TASK_TEXTS`` rows, and returns links only.
    """
    rows = attach(members, groups, ["id"]).withColumn("component", F.coalesce("component", "id"))
    sizes = rows.groupBy("head", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = (
        sizes.groupBy("head")
        .agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.max("n").alias("most"), F.sum("n").alias("all"))
        .where(F.col("all") > F.col("most"))
    )
    rows = stage_table(lookup_join(rows, mixed, ["head"], "inner", salt_by=["id"]), "mixed-heads")
    blocks = lambda n: F.greatest(F.ceil(n / BLOCK_TEXTS), F.lit(1)).cast("int")
    many_blocks, few_blocks = blocks(F.col("all")), blocks(F.col("all") - F.col("most"))
    place = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    copies = rows.select(
        "head", "id", "component", F.lit(False).alias("few"), place(many_blocks).alias("i"),
        F.explode(F.sequence(F.lit(0), few_blocks - 1)).alias("j"),
    ).union(
        rows.where("component <> largest").select(
            "head", "id", "component", F.lit(True), F.explode(F.sequence(F.lit(0), many_blocks - 1)), place(few_blocks),
        )
    )
    copies = stage_table(copies, "head-blocks")
    tasks = max(copies.count() // TASK_TEXTS, 1)
    kind = copies.schema["id"].dataType.simpleString()

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        for _, block in pdf.groupby(["head", "i", "j"], sort=False):
            few, many = block[block["few"]], block[~block["few"]]
            if len(few) and len(many):
                ids_x, ids_y = few["id"].to_numpy(), many["id"].to_numpy()
                cx, cy = few["component"].to_numpy(), many["component"].to_numpy()
                pairs = links_between(few["shingles"].tolist(), many["shingles"].tolist(), percent)
                out += [(min(ids_x[i], ids_y[j]), max(ids_x[i], ids_y[j])) for i, j in pairs if cx[i] != cy[j]]
        return pd.DataFrame(sorted(set(out)), columns=["a", "b"])

    sets = sets_of(rows.select("id").distinct())
    task = F.pmod(F.xxhash64("head", "i", "j"), F.lit(tasks))
    return (
        copies.join(sets, "id").withColumn("task", task).groupBy("task").applyInPandas(compare, f"a {kind}, b {kind}").distinct()
    )


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
    percent: int = SIMILAR_PERCENT, matches: int = MATCHES,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Documents are linked when their sets of ``words``-word shingles have a Jaccard similarity of at
    least ``percent``; a text with fewer words is one shingle, a text without words (null, empty,
    blank) is linked with nothing. ``component_id`` is the smallest id reachable over links. A row
    without an id is linked with nothing and has a null component and kept = true. Ids should be
    unique; repeated rows get equal results. Other columns are not read; an empty table gives no rows.

    Texts with equal sets form a class and only its smallest id goes on. First every text meets the
    most central text of each of its postings. What these links connect is then left out, and all
    texts that share a head and are still apart are compared, so no link between components is lost.
    """
    rows = stage_table(sketches(docs, id_col, text_col, words), "sketches")
    usable = rows.where("set_hash is not null and id is not null")
    classes = stage_table(usable.groupBy("set_hash").agg(F.min("id").alias("class_id")), "classes")
    texts = only_keys(usable, classes.select(F.col("class_id").alias("id")), ["id"])
    postings = prefix_postings(texts, matches)
    members = stage_table(head_members(stage_table(postings, "postings")), "heads")
    stars = members.where("head <> id").select(F.least("head", "id").alias("a"), F.greatest("head", "id").alias("b")).distinct()
    first = stage_table(confirm(stars, texts, docs, id_col, text_col, words, matches, percent), "star-links")
    groups = stage_table(components(first), "star-groups")
    second = stage_table(
        cross_links(members, groups, lambda ids: shingle_sets(docs, ids, id_col, text_col, words), percent), "cross-links"
    )
    merged = stage_table(components(first.union(second)), "groups").withColumnRenamed("id", "class_id")
    placed = attach(attach(rows, classes, ["set_hash"]), merged, ["class_id"])
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "class_id", "id"))
    return placed.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document of each component.

    Rows without an id or without words stay. Ids should be unique: rows that repeat an id stay or
    go together. An empty table gives no rows.
    """
    judged = near_dedup(docs, id_col, text_col, **options)
    gone = stage_table(judged.where("not kept").select(F.col(id_col).alias("id")).distinct(), "near-copies")
    rows = attach(whole_rows(docs, id=F.col(id_col)), gone.withColumn("gone", F.lit(1)), ["id"])
    return rows.where("gone is null").select("row.*")
