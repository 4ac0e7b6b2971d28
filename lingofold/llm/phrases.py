"""Removal of repeated passages, located by sharded phrase automata."""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingofold.llm.common import (
    BLANK_CHARS,
    BLANKS,
    WordHashes,
    attach,
    byte_words,
    map_batches,
    only_keys,
    text_or_empty,
    word_count,
)
from lingofold.session import stage_table

WINDOW = 20
ANCHOR = 6
#: Regions per automaton, and from how many occurrences on an anchor is cut into several shards.
SHARD_REGIONS = 3000
ANCHOR_REGIONS = 2000
SPAN = 1024
MIX = np.uint64(0x9E3779B97F4A7C15)


def anchors(codes: np.ndarray, window: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every window the smallest hash of ``width`` words in it: (hashes, spans of windows).

    Equal windows have equal anchors at equal places, so a repeated window has a repeated anchor.
    Windows that follow each other often share their anchor; a span is the number of the first
    window times ``SPAN`` plus the number of windows.
    """
    if len(codes) < window:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    hashes = gram_hashes(codes, width)
    reach = window - width + 1
    chosen = sliding_window_view(hashes, reach).argmin(axis=1) + np.arange(len(hashes) - reach + 1)
    first = np.flatnonzero(np.diff(chosen, prepend=-1))
    counts = np.diff(np.append(first, len(chosen)))
    return hashes[chosen[first]], first * SPAN + counts


def gram_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    n = len(codes) - width + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        mixed = (mixed ^ codes[k : k + n]) * MIX
        mixed ^= mixed >> np.uint64(29)
    return mixed


def word_codes(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def anchor_rows(docs: DataFrame, id_col: str, text_col: str, window: int, width: int) -> DataFrame:
    """(id, anchors, spans) per document with at least one window."""
    hashes = WordHashes()

    def read(batch: dict) -> dict:
        out: dict[str, list] = {"id": [], "anchors": [], "spans": []}
        for key, text in zip(batch[id_col], batch[text_col], strict=True):
            found, spans = anchors(word_codes(byte_words(text), hashes), window, width)
            if len(found):
                out["id"].append(key)
                out["anchors"].append(found.view(np.int64))
                out["spans"].append(spans)
        return out

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), read, f"id {kind}, anchors array<long>, spans array<long>")


def regions(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(anchor, n, id, start, words): for each recurring anchor the words of all windows whose
    anchor it is. ``docs`` carries ``hits``, an array of (span, anchor, n)."""

    def read(batch: dict) -> dict:
        out: dict[str, list] = {"anchor": [], "n": [], "id": [], "start": [], "words": []}
        for key, text, hits in zip(batch[id_col], batch[text_col], batch["hits"], strict=True):
            words = byte_words(text)
            for hit in hits:
                low, count = divmod(hit["span"], SPAN)
                out["anchor"].append(hit["anchor"])
                out["n"].append(hit["n"])
                out["id"].append(key)
                out["start"].append(low)
                out["words"].append(b" ".join(words[low : low + count - 1 + window]))
        return out

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col, "hits"), read, f"anchor long, n long, id {kind}, start int, words binary")


def locate(shard: pd.DataFrame, window: int, hot: int) -> list[tuple]:
    """Occurrences to remove in one shard: (phrase, id, start, stop).

    Recurring windows of the shard are compiled into an automaton over word numbers, and the regions
    are streamed through it. Occurrences after the first are complete (no phrase); where an anchor
    has several shards, the first occurrence here is returned with its phrase to be compared with theirs.
    """
    numbers: dict[bytes, int] = {}
    texts = [tuple([numbers.setdefault(w, len(numbers)) for w in t.split(b" ")]) for t in shard["words"]]
    hot_rows = (shard["n"] > hot).tolist()
    counts: dict[tuple, int] = {}
    for text, is_hot in zip(texts, hot_rows, strict=True):
        for i in range(len(text) - window + 1):
            phrase = text[i : i + window]
            counts[phrase] = counts.get(phrase, 0) + (2 if is_hot else 1)
    phrases = [p for p, n in counts.items() if n > 1]
    if not phrases:
        return []
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for number, phrase in enumerate(phrases):
        automaton.add_word(phrase, number)
    automaton.make_automaton()
    ids, starts = shard["id"].tolist(), shard["start"].tolist()
    places: list[list[tuple]] = [[] for _ in phrases]
    spread = bytearray(len(phrases))
    for row, text in enumerate(texts):
        key, base = ids[row], starts[row] - window + 1
        for end, number in automaton.iter(text):
            places[number].append((key, base + end))
            if hot_rows[row]:
                spread[number] = 1
    words = list(numbers)
    out = []
    for number, found in enumerate(places):
        first = min(found)
        out.extend((None, key, start, start + window) for key, start in found if (key, start) != first)
        if spread[number]:
            text = b" ".join(words[w] for w in phrases[number])
            out.append((xxhash.xxh3_128_digest(text), *first, first[1] + window))
    return merge(out)


def merge(found: list[tuple]) -> list[tuple]:
    """Join overlapping complete occurrences of one document."""
    whole = sorted((f[1], f[2], f[3]) for f in found if f[0] is None)
    out = [f for f in found if f[0] is not None]
    for key, start, stop in whole:
        if out and out[-1][0] is None and out[-1][1] == key and start <= out[-1][3]:
            out[-1] = (None, key, out[-1][2], max(stop, out[-1][3]))
        else:
            out.append((None, key, start, stop))
    return out


def repeats(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW, width: int = ANCHOR, hot: int = ANCHOR_REGIONS) -> DataFrame:
    """(id, start, stop): word spans of windows that also start earlier. ``docs`` has distinct texts."""
    found = stage_table(anchor_rows(docs, id_col, text_col, window, width), "anchors")
    counts = stage_table(
        found.select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
        "recurring-anchors",
    )
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    places = found.select("id", F.explode(F.arrays_zip("spans", "anchors")).alias("x")).select(
        "id", F.col("x.spans").alias("span"), F.col("x.anchors").alias("anchor")
    )
    hits = (
        places.join(counts, "anchor").groupBy("id").agg(F.collect_list(F.struct("span", "anchor", "n")).alias("hits"))
    )
    hits = stage_table(hits.withColumnRenamed("id", id_col), "anchor-hits")  # per document, at most its words
    held = only_keys(docs.select(id_col, text_col), hits, [id_col]).join(hits, id_col)
    parts = F.greatest(F.ceil(F.col("n") / hot), F.lit(1))
    shards = regions(held, id_col, text_col, window).withColumn(
        "shard", F.pmod(F.xxhash64("anchor", F.pmod(F.xxhash64("id"), parts)), F.lit(max(total // SHARD_REGIONS, 1)))
    )
    kind = docs.schema[id_col].dataType.simpleString()

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        rows = locate(shard, window, hot)
        return pd.DataFrame(rows, columns=["phrase", "id", "start", "stop"])

    located = stage_table(
        shards.groupBy("shard").applyInPandas(run, f"phrase binary, id {kind}, start int, stop int"), "located"
    )
    firsts = located.where("phrase is not null")
    earliest = firsts.groupBy("phrase").agg(F.min(F.struct("id", "start")).alias("earliest"))
    later = firsts.join(earliest, "phrase").where(F.struct("id", "start") != F.col("earliest"))
    return located.where("phrase is null").select("id", "start", "stop").union(later.select("id", "start", "stop"))


def cut(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_removed, kept_text) of documents with ``spans``, an array of (start, stop) in words."""

    def read(batch: dict) -> dict:
        removed, kept = [], []
        for text, spans in zip(batch[text_col], batch["spans"], strict=True):
            words = byte_words(text)
            gone = np.zeros(len(words), dtype=bool)
            for span in spans:
                gone[span["start"] : span["stop"]] = True
            removed.append(int(gone.sum()))
            kept.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g).decode("utf-8", "surrogatepass"))
        return {id_col: batch[id_col], "n_removed": removed, "kept_text": kept}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col, "spans"), read, f"`{id_col}` {kind}, n_removed long, kept_text string")


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, width: int = ANCHOR, keep_text: bool = False, hot: int = ANCHOR_REGIONS) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 and, if asked for, kept_text.

    A word goes when a window of ``window`` consecutive words covers it whose word sequence also
    starts earlier (smaller id, or same document and earlier start). Windows are judged on the
    input. Null and empty texts have no words; words are compared as they stand. A row without an
    id takes no part and stays whole. Ids should be unique; rows that repeat an id and its text are
    one document and get equal results. Other columns are not read; an empty table gives no rows.

    Documents with the same words as an earlier one lose all windows, so only the first goes on.
    Anchors that occur once are left out early; what remains is cut into regions around recurring
    anchors, and regions with the same anchor meet in a shard. Anchors with more than ``hot``
    occurrences are spread over several shards, whose first occurrences are compared afterwards.
    """
    joined = F.btrim(F.regexp_replace(text_or_empty(text_col), BLANKS, " "), F.lit(BLANK_CHARS))
    rows = stage_table(
        docs.select(F.col(id_col), word_count(text_col).alias("n_words"), F.sha2(joined, 256).alias("sha")), "word-rows"
    )
    usable = rows.where((F.col("n_words") >= window) & F.col(id_col).isNotNull())
    firsts = stage_table(usable.groupBy("sha").agg(F.min(id_col).alias("first_id")), "first-texts")
    distinct = only_keys(docs, firsts.select(F.col("first_id").alias(id_col)), [id_col])
    spans = repeats(distinct, id_col, text_col, window, width, hot).groupBy("id").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")
    )
    spans = stage_table(spans.withColumnRenamed("id", id_col), "word-spans")
    held = only_keys(distinct.select(id_col, text_col), spans, [id_col]).join(spans, id_col)
    shortened = cut(held, id_col, text_col).withColumn("cut_sha", F.sha2("kept_text", 256))
    if not keep_text:
        shortened = shortened.drop("kept_text")
    shortened = shortened.dropDuplicates([id_col])
    marked = attach(rows, firsts, ["sha"]).withColumn(
        "copy", F.coalesce(F.col(id_col) != F.col("first_id"), F.lit(False))
    )
    nothing = hashlib.sha256(b"").hexdigest()
    result = marked.join(shortened, id_col, "left").select(
        F.col(id_col), "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(F.col("copy"), F.lit(nothing)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        "copy", *(["kept_text"] if keep_text else []),
    )
    if not keep_text:
        return result.drop("copy")
    whole = docs.select(F.col(id_col), joined.alias("__whole")).dropDuplicates([id_col])
    text = F.when(F.col("copy"), F.lit("")).otherwise(F.coalesce("kept_text", "__whole"))
    return result.join(whole, id_col, "left").withColumn("kept_text", text).drop("copy", "__whole")
