"""Removal of repeated byte strings with suffix arrays built by difference cover sampling.

Only the first ``window`` bytes of a suffix matter here. So suffixes are not sorted in one global
order: an anchor inside these bytes (their smallest hash) decides in which shard a suffix is sorted,
and suffixes that begin alike always meet. Every shard is sorted with the difference cover {1, 2}
modulo 3.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lingofold.llm.common import ROWS_PER_STEP, attach, map_batches, only_keys, text_or_empty
from lingofold.session import ship_package, stage_table

WINDOW = 50
ANCHOR = 24
#: Rows of a batch with one anchor from which on they are not searched for partners.
HEAVY_ROWS = 64
SPAN = 1024
RUN = SPAN // 2
SHARD_REGIONS = 6000
ANCHOR_REGIONS = 3000
#: Hash bits per anchor beyond the logarithm of the corpus size; a chance collision only costs time.
SPARE_BITS = 12
PAD = 128
MIX = np.uint64(0x9E3779B97F4A7C15)


def packed(raw: np.ndarray) -> np.ndarray:
    """At each position but the last seven the next eight bytes as one big-endian number."""
    n = len(raw) - 7
    out = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | raw[k : k + n]
    return out


def encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def anchors(raw: bytes, window: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and spans (first window * SPAN + windows) of the anchors of all windows.

    The smallest hash of each window comes from minima over doubled widths. Windows in a row with
    the same smallest hash make one span, cut after ``RUN`` windows.
    """
    if len(raw) < window:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    words = packed(np.frombuffer(raw, dtype=np.uint8).astype(np.uint64))
    hashes = words[: len(words) - ANCHOR + 8] * MIX
    for k in range(8, ANCHOR, 8):
        hashes ^= hashes >> np.uint64(32)
        hashes = (hashes ^ words[k : k + len(hashes)]) * MIX
    hashes ^= hashes >> np.uint64(32)
    least = (hashes * MIX) >> np.uint64(64 - bits)
    width, reach = 1, window - ANCHOR + 1
    while width < reach:
        step = min(width, reach - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    counts = np.diff(np.append(first, len(least)))
    if counts.max() > RUN:
        parts = -(-counts // RUN)
        stop = np.repeat(first + counts, parts)
        first = np.repeat(first, parts) + RUN * (np.arange(len(stop)) - np.repeat(np.cumsum(parts) - parts, parts))
        counts = np.minimum(stop - first, RUN)
    return least[first].astype(np.int64), first * SPAN + counts


def anchor_rows(docs: DataFrame, id_col: str, text_col: str, window: int, bits: int, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """(anchor, salt, kind, id, span) of every anchor of every document.

    An anchor that many rows of a batch have, in several documents, would make one long group. Its
    rows get a ``salt`` of their own, which takes them past the search for partners, and a marker
    (kind 0) tells the remaining rows with this anchor that there are others.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_STEP):
                batch = whole.slice(at, ROWS_PER_STEP)
                found = [anchors(encoded(t), window, bits) for t in batch.column(1).to_pylist()]
                hashes = np.concatenate([f[0] for f in found])
                spans = np.concatenate([f[1] for f in found])
                owner = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
                salt, heavy = _salts(hashes, owner, xxhash.xxh32_intdigest(str(batch.column(0)[0])), heavy_rows)
                more = np.zeros(len(heavy), dtype=np.int64)
                ids = batch.column(0).take(pa.array(np.concatenate([owner, more])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([hashes, heavy])), pa.array(np.concatenate([salt, more])),
                     pa.array(np.concatenate([np.ones(len(hashes), dtype=np.int32), more.astype(np.int32)])),
                     ids, pa.array(np.concatenate([spans, more]))],
                    names=["anchor", "salt", "kind", "id", "span"],
                )

    return docs.select(id_col, text_col).mapInArrow(read, f"anchor long, salt long, kind int, id {kind}, span long")


def _salts(hashes: np.ndarray, owner: np.ndarray, seed: int, heavy_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(salt per row, heavy anchors): 0, but one number for all rows of the batch with a heavy anchor."""
    salt = np.zeros(len(hashes), dtype=np.int64)
    order = np.argsort(hashes, kind="stable")
    sorted_hashes, owners = hashes[order], owner[order]
    heads = np.flatnonzero(np.diff(sorted_hashes, prepend=sorted_hashes[:1] - 1))
    counts = np.diff(np.append(heads, len(order)))
    tails = heads + counts - 1
    heavy = (counts >= heavy_rows) & (owners[heads] != owners[tails])
    salt[order[np.repeat(heavy, counts)]] = 1 + seed % (1 << 31)
    return salt, sorted_hashes[heads[heavy]]


def recurring(rows: DataFrame, hot: int) -> DataFrame:
    """(id, anchor, sub, span): rows whose anchor another document has too.

    One shuffle sorts the rows by anchor, and each task passes over its rows once. It holds the rows
    of one anchor until a second document turns up; of an anchor with more than ``hot`` rows they
    are handed on in runs of that length. ``sub`` numbers the runs from 1, and is 0 where all rows of
    the anchor stay together.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Recurring(hot)
        names = ["id", "anchor", "sub", "span"]
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            for out in state.add(*columns):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)
        for out in state.end():
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    schema = f"id {kind}, anchor long, sub long, span long"
    types = [f.type for f in to_arrow_schema(T._parse_datatype_string(schema))]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(parts, "anchor", "salt").sortWithinPartitions("anchor", "salt", "kind")
    return ordered.select("id", "anchor", "salt", "kind", "span").mapInArrow(find, schema)


class _Recurring:
    """Groups of equal (anchor, salt) in sorted rows that come in batches."""

    def __init__(self, hot: int):
        self.hot, self.held, self.runs = hot, None, 0  # runs handed on of the group that is open

    def add(self, *columns: np.ndarray) -> Iterator[tuple]:
        if not len(columns[0]):
            return
        if self.held is not None:
            new_group = columns[1][0] != self.held[1][0] or columns[2][0] != self.held[2][0]
            if new_group:
                yield from self._groups(self.held, self.runs)
                self.held, self.runs = None, 0
            else:
                columns = tuple(np.concatenate(x) for x in zip(self.held, columns, strict=True))
        anchor, salt = columns[1], columns[2]
        last = int(np.flatnonzero((anchor != anchor[-1]) | (salt != salt[-1]))[-1]) + 1 if (
            anchor[0] != anchor[-1] or salt[0] != salt[-1]) else 0
        if last:
            yield from self._groups(tuple(c[:last] for c in columns), self.runs)
            self.runs = 0
        open_rows = tuple(c[last:] for c in columns)
        if len(open_rows[0]) > self.hot and self._found(open_rows, self.runs):
            yield from self._groups(open_rows, max(self.runs, 1))
            self.runs = max(self.runs, 1) + len(open_rows[0]) // self.hot + 1
            open_rows = tuple(c[-1:].copy() for c in open_rows)  # the last row tells the group, and is out already
            open_rows[3][:] = -1
        self.held = open_rows

    def end(self) -> Iterator[tuple]:
        if self.held is not None:
            yield from self._groups(self.held, self.runs)
            self.held = None

    @staticmethod
    def _found(rows: tuple, runs: int) -> bool:
        ids, _, salt, kind, _ = rows
        return bool(runs or salt[0] or kind[0] == 0 or (ids != ids[0]).any())

    def _groups(self, rows: tuple, runs: int) -> Iterator[tuple]:
        """Hand on the rows of groups that recur; ``runs`` belongs to the first group."""
        ids, anchor, salt, kind, span = rows
        if not len(ids):
            return
        heads = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])]))
        counts = np.diff(np.append(heads, len(ids)))
        of = np.repeat(np.arange(len(heads)), counts)
        marked = (kind[heads] == 0) | (salt[heads] != 0)
        if runs:
            marked[0] = True
        found = marked | np.logical_or.reduceat(ids != ids[heads][of], heads)
        split = marked | (counts > self.hot)
        nth = np.arange(len(ids)) - heads[of]
        sub = np.where(split[of], np.where(salt != 0, salt, 0) + nth // self.hot + 1, 0)
        if runs:
            sub[of == 0] += runs
        keep = found[of] & (kind == 1)
        if keep.any():
            yield ids[keep], anchor[keep], sub[keep], span[keep]


def regions(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(anchor, sub, id, start, body): the bytes of all windows of each recurring anchor."""

    def read(batch: dict) -> dict:
        out: dict[str, list] = {"anchor": [], "sub": [], "id": [], "start": [], "body": []}
        found = (batch[c] for c in (id_col, text_col, "anchors", "subs", "spans"))
        for key, text, hit, subs, spans in zip(*found, strict=True):
            raw = encoded(text)
            starts = [span // SPAN for span in spans]
            out["anchor"] += hit
            out["sub"] += subs
            out["id"] += [key] * len(hit)
            out["start"] += starts
            out["body"] += [raw[low : low + span % SPAN - 1 + window] for low, span in zip(starts, spans, strict=True)]
        return out

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col, "anchors", "subs", "spans"), read, f"anchor long, sub long, id {kind}, start int, body binary")


def _dense(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Dense ranks from 1, given an order that sorts the keys."""
    new = np.zeros(len(order), dtype=bool)
    for key in keys:
        new[1:] |= np.diff(key[order]) != 0
    names = np.empty(len(order), dtype=np.int64)
    names[order] = np.cumsum(new) + 1
    return names


def _names(*keys: np.ndarray) -> np.ndarray:
    """Dense ranks of tuples of ranks (the first key leads), sorted as one number where they fit."""
    bits = max(int(key.max(initial=0)) for key in keys).bit_length()
    if bits * len(keys) > 63:
        return _dense(np.lexsort(keys[::-1]), *keys)
    whole = keys[0]
    for key in keys[1:]:
        whole = (whole << bits) | key
    return _dense(np.argsort(whole), whole)


def suffix_order(raw: np.ndarray, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``starts`` in the order of their suffixes, right for the first 72 bytes.

    Symbols are 8-byte words, which keeps positions in their class modulo 3. Triples of the sampled
    positions are sorted and named (24 bytes); triples of names are sorted in turn (72 bytes, more
    than any window), where the recursion ends. The other suffixes follow from one byte and the
    rank behind it, and both lists are merged by the ranks behind one or two bytes.
    """
    n = len(raw) - PAD
    sample = np.flatnonzero(np.arange(n + 60) % 3 != 0)
    names = np.zeros(len(raw), dtype=np.int64)
    eights = _dense(np.argsort(words), words)
    names[sample] = _names(eights[sample], eights[sample + 8], eights[sample + 16])
    wanted = np.zeros(n + 3, dtype=bool)
    for step in range(3):
        wanted[starts + step] = True
    wanted[::3] = False
    sample = np.flatnonzero(wanted)
    ranks = np.zeros(len(raw), dtype=np.int64)
    ranks[sample] = _names(names[sample], names[np.minimum(sample + 24, n + 59)], names[np.minimum(sample + 48, n + 59)])
    low = raw.astype(np.int64)
    key1 = lambda i: (low[i] << 40) | ranks[i + 1]
    key2 = lambda i: (low[i] << 48) | (low[i + 1] << 40) | ranks[i + 2]
    ones, twos, rest = (starts[starts % 3 == c] for c in (1, 2, 0))
    both = np.concatenate([ones, twos])
    both = both[np.argsort(ranks[both], kind="stable")]
    at_rest = np.argsort(key1(rest), kind="stable")
    rest = rest[at_rest]
    ones_key, twos_key = np.sort(key1(ones)), np.sort(key2(twos))
    place_rest = np.arange(len(rest)) + np.searchsorted(ones_key, key1(rest)) + np.searchsorted(twos_key, key2(rest))
    rest1, rest2 = key1(rest), np.sort(key2(rest))
    behind = np.where(
        both % 3 == 1, np.searchsorted(rest1, key1(both), "right"), np.searchsorted(rest2, (low[both] << 48) | (low[both + 1] << 40) | ranks[both + 2], "right")
    )
    place = np.concatenate([place_rest, np.arange(len(both)) + behind])
    return np.concatenate([rest, both])[np.argsort(place, kind="stable")]


def locate(shard: pd.DataFrame, window: int) -> list[tuple]:
    """Spans to remove in one shard: (prefix, id, start, stop); see ``phrases.locate``."""
    rows_of: dict[bytes, list[int]] = {}
    for row, body in enumerate(shard["body"]):
        rows_of.setdefault(body, []).append(row)
    ids, begin = shard["id"].tolist(), shard["start"].tolist()
    is_hot = (shard["sub"] > 0).tolist()
    codes = {key: i for i, key in enumerate(sorted(set(ids)))}
    bodies = list(rows_of)
    sizes = np.array([len(b) for b in bodies])
    offset = np.concatenate([[0], np.cumsum(sizes)])
    raw = np.frombuffer(b"".join(bodies) + bytes(PAD), dtype=np.uint8)
    words = packed(raw.astype(np.uint64))
    windows = sizes - window + 1
    starts = np.repeat(offset[:-1] - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
    owner = np.repeat(np.arange(len(bodies)), windows)
    least = np.array([min(codes[ids[r]] for r in rows_of[b]) for b in bodies])
    order = suffix_order(raw, words, starts)
    owner_at = np.zeros(len(raw), dtype=np.int64)
    owner_at[starts] = owner
    new = np.zeros(len(order), dtype=bool)
    new[0] = True
    for k in [*range(0, window - 7, 8), window - 8]:  # adjacent prefixes, eight bytes at a time
        new[1:] |= words[order[1:] + k] != words[order[:-1] + k]
    heads = np.flatnonzero(new)
    first = np.minimum.reduceat(least[owner_at[order]], heads)
    first_at = np.zeros(len(raw), dtype=np.int64)
    first_at[order] = np.repeat(first, np.diff(np.append(heads, len(order))))
    earlier = first_at[starts] < least[owner]
    joined = earlier[1:] & earlier[:-1] & (np.diff(starts) == 1)
    head = np.flatnonzero(earlier & ~np.concatenate([[False], joined]))
    tail = np.flatnonzero(earlier & ~np.concatenate([joined, [False]]))
    run = owner[head]
    low, high = starts[head] - offset[run], starts[tail] - offset[run] + window
    body_of = np.empty(len(ids), dtype=np.int64)
    for number, body in enumerate(bodies):
        body_of[rows_of[body]] = number
    copy = np.array([codes[i] for i in ids]) > least[body_of]
    copies, kept = np.flatnonzero(copy), np.flatnonzero(~copy)
    kept = kept[np.argsort(body_of[kept], kind="stable")]
    per_body = np.bincount(body_of[kept], minlength=len(bodies))
    times = per_body[run]  # every run once for each place of the body that is no copy
    which = np.repeat(np.arange(len(run)), times)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    row = kept[np.repeat((np.cumsum(per_body) - per_body)[run], times) + nth]
    base = np.array(begin, dtype=np.int64)
    rows = np.concatenate([copies, row]).tolist()
    start = np.concatenate([base[copies], base[row] + low[which]]).tolist()
    stop = np.concatenate([base[copies] + sizes[body_of[copies]], base[row] + high[which]]).tolist()
    out: list[tuple] = [(None, ids[r], lo, hi) for r, lo, hi in zip(rows, start, stop, strict=True)]
    window_at = np.cumsum(windows) - windows
    for r in kept.tolist():
        if is_hot[r]:
            number, key, at = int(body_of[r]), ids[r], begin[r]
            body, lo = bodies[number], int(window_at[number])
            out.extend(
                (xxhash.xxh3_128_digest(body[i : i + window]), key, at + i, at + i + window)
                for i in np.flatnonzero(~earlier[lo : lo + int(windows[number])]).tolist()
            )
    return out


def merged(spans: list[tuple]) -> list[tuple]:
    """Touching and overlapping spans as one."""
    out: list[list] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(stop, out[-1][1])
        else:
            out.append([start, stop])
    return [tuple(s) for s in out]


def repeats(
    docs: DataFrame, id_col: str, text_col: str, window: int, bits: int, hot: int, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """(id, start, stop) in bytes of windows that also start in a document with a smaller id."""
    found = recurring(anchor_rows(docs, id_col, text_col, window, bits, heavy_rows), hot)
    hits = stage_table(
        found.groupBy("id").agg(F.collect_list(F.struct("span", "anchor", "sub")).alias("hits")).select(
            F.col("id").alias(id_col), F.size("hits").alias("n"), F.col("hits.anchor").alias("anchors"),
            F.col("hits.sub").alias("subs"), F.col("hits.span").alias("spans"),
        ),
        "anchor-hits",
    )
    total = hits.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    held = docs.select(F.col(id_col), F.col(text_col)).join(hits.drop("n"), id_col)
    shards = regions(held, id_col, text_col, window).withColumn(
        "shard", F.pmod(F.xxhash64("anchor", "sub"), F.lit(max(total // SHARD_REGIONS, 1)))
    )
    kind = docs.schema[id_col].dataType.simpleString()

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(locate(shard, window), columns=["prefix", "id", "start", "stop"])

    located = stage_table(
        shards.groupBy("shard").applyInPandas(run, f"prefix binary, id {kind}, start int, stop int"), "located"
    )
    firsts = located.where("prefix is not null")
    earliest = firsts.groupBy("prefix").agg(F.min("id").alias("earliest"))
    later = firsts.join(earliest, "prefix").where("id > earliest")
    return located.where("prefix is null").select("id", "start", "stop").union(later.select("id", "start", "stop"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    hot: int = ANCHOR_REGIONS, heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte of the UTF-8 text goes when a ``window``-byte string covers it that also starts in a
    document with a smaller id; strings are judged on the input and never cross documents. Repeats
    inside one document alone stay. Null and empty texts have no bytes. A row without an id takes no
    part and stays whole; rows that repeat an id and its text are one document. Other columns are
    not read; an empty table gives no rows. ``window`` is 24 to 72 bytes.
    """
    body = text_or_empty(text_col)
    rows = stage_table(
        docs.select(F.col(id_col), F.octet_length(body).cast("bigint").alias("n_bytes"), F.sha2(body, 256).alias("sha")), "byte-rows"
    )
    usable = rows.where((F.col("n_bytes") >= window) & F.col(id_col).isNotNull())
    firsts = stage_table(usable.groupBy("sha").agg(F.min(id_col).alias("first_id")), "first-texts")
    size = usable.agg(F.coalesce(F.sum("n_bytes"), F.lit(1)).alias("n")).first()["n"]
    bits = min(int(size).bit_length() + SPARE_BITS, 63)
    distinct = only_keys(docs, firsts.select(F.col("first_id").alias(id_col)), [id_col])
    spans = repeats(distinct, id_col, text_col, window, bits, hot, heavy_rows).groupBy("id").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")
    )
    spans = stage_table(spans.withColumnRenamed("id", id_col), "byte-spans")

    def cut(batch: dict) -> dict:
        out: dict[str, list] = {id_col: batch[id_col], "n_removed": [], "n_spans": [], "cut_sha": []}
        for text, found in zip(batch[text_col], batch["spans"], strict=True):
            raw, kept, at, gone = encoded(text), hashlib.sha256(), 0, 0
            whole = merged([(s["start"], s["stop"]) for s in found])
            for start, stop in whole:
                kept.update(raw[at:start])
                at, gone = stop, gone + stop - start
            kept.update(raw[at:])
            out["n_removed"].append(gone)
            out["n_spans"].append(len(whole))
            out["cut_sha"].append(kept.hexdigest())
        return out

    kind = docs.schema[id_col].dataType.simpleString()
    held = only_keys(distinct.select(id_col, text_col), spans, [id_col]).join(spans, id_col)
    shortened = map_batches(held, cut, f"`{id_col}` {kind}, n_removed long, n_spans long, cut_sha string").dropDuplicates([id_col])
    marked = attach(rows, firsts, ["sha"]).withColumn("copy", F.coalesce(F.col(id_col) != F.col("first_id"), F.lit(False)))
    nothing = hashlib.sha256(b"").hexdigest()
    pick = lambda copy, other, none: F.when(F.col("copy"), copy).otherwise(F.coalesce(other, none))
    return marked.join(shortened, id_col, "left").select(
        id_col, "n_bytes",
        pick(F.col("n_bytes"), F.col("n_removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        pick(F.lit(1), F.col("n_spans"), F.lit(0)).cast("bigint").alias("n_spans"),
        pick(F.lit(nothing), F.col("cut_sha"), F.col("sha")).alias("kept_sha256"),
    )
