"""Periodic runs of words, found with a difference cover and longest common extensions."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingofold.llm.common import BLANK_CHARS, BLANKS, text_or_empty
from lingofold.session import ship_package

#: Every distance mod COVER is a difference of two members of COVER_SET.
COVER = 13
COVER_SET = (0, 1, 3, 9)
MIN_WORDS = 6
MIN_PERIODS = 4
#: Texts are worked on together up to so many bytes; a longer text is worked on alone.
STEP_BYTES = 3 << 20
PAIR_STEP = 1 << 20
FOUND = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "best struct<start: long, length: long, period: long>, collapsed binary"
)


def dense(keys: np.ndarray) -> np.ndarray:
    """Ranks of ``keys`` from 0; equal keys share one."""
    order = np.argsort(keys, kind="stable")
    ranks = np.empty(len(keys), dtype=np.int64)
    ranks[order] = np.cumsum(np.diff(keys[order], prepend=keys[order[:1]]) != 0)
    return ranks


class CoverExtension:
    """Longest common extensions to the right in a sequence of whole numbers.

    Only suffixes that start at a place of the difference cover are sorted: by their first ``COVER``
    numbers, then by doubling. Neighbours' common lengths go into a table of range minima. For any
    two places there is a shift below ``COVER`` that takes both into the cover, so a query compares
    fewer than ``COVER`` numbers and then looks up one minimum.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = np.concatenate((codes, np.full(COVER, -1)))  # -1 is met once at each end only
        self.n = n = len(codes)
        self.shift = np.zeros((COVER, COVER), dtype=np.int64)
        members = np.zeros(COVER, dtype=bool)
        members[list(COVER_SET)] = True
        for a in range(COVER):
            for b in range(COVER):
                self.shift[a, b] = next(d for d in range(COVER) if members[(a + d) % COVER] and members[(b + d) % COVER])
        sample = np.flatnonzero(members[np.arange(n) % COVER])
        self.place = np.full(n + 1, -1, dtype=np.int64)
        self.place[sample] = np.arange(len(sample))
        levels, step = [self._names(sample)], COVER
        while levels[-1].size and levels[-1].max() + 1 < len(sample):
            after = sample + step
            inside = after < n
            follow = np.zeros(len(sample), dtype=np.int64)
            follow[inside] = levels[-1][self.place[after[inside]]] + 1
            levels.append(dense(levels[-1] * (len(sample) + 1) + follow))
            step *= 2
        order = np.argsort(levels[-1], kind="stable")
        self.rank = np.empty(len(sample), dtype=np.int64)
        self.rank[order] = np.arange(len(sample))
        common = self._neighbours(sample, order, levels)
        self.minima = [common]
        width = 1
        while 2 * width <= len(common):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _names(self, sample: np.ndarray) -> np.ndarray:
        """Ranks of the first ``COVER`` numbers from each sampled place."""
        base = int(self.codes.max(initial=0)) + 2
        fits = max(1, int(62 // np.log2(base)))
        names = np.zeros(len(sample), dtype=np.int64)
        for start in range(0, COVER, fits):
            packed = np.zeros(len(sample), dtype=np.int64)
            for k in range(start, min(COVER, start + fits)):
                packed = packed * base + (self.codes[sample + k] + 1)
            names = dense(packed) if start == 0 else dense(names * (len(sample) + 1) + dense(packed))
        return names

    def _neighbours(self, sample: np.ndarray, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common lengths of sampled suffixes that follow each other in sorted order."""
        left, right = sample[order[:-1]].copy(), sample[order[1:]].copy()
        start = left.copy()
        for level in range(len(levels) - 1, -1, -1):
            # equal ranks of a level are equal stretches of that length, the end of the text included
            step = COVER << level
            inside = np.flatnonzero((left < self.n) & (right < self.n))
            a, b = self.place[left[inside]], self.place[right[inside]]
            same = inside[levels[level][a] == levels[level][b]]
            left[same] += step
            right[same] += step
        return np.minimum(left - start + self._compare(left, right, COVER), self.n - start).astype(np.int32)

    def _compare(self, left: np.ndarray, right: np.ndarray, most: int | np.ndarray) -> np.ndarray:
        """Equal numbers from two places on, ``most`` at the most."""
        length = np.zeros(len(left), dtype=np.int64)
        active = np.arange(len(left))
        most = np.broadcast_to(np.asarray(most), left.shape)
        for k in range(COVER):
            active = active[most[active] > k]
            a, b = left[active] + k, right[active] + k
            inside = (a < self.n) & (b < self.n)
            active, a, b = active[inside], a[inside], b[inside]
            active = active[self.codes[a] == self.codes[b]]
            length[active] += 1
            if not len(active):
                break
        return length

    def extend(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many numbers agree from ``left`` and from ``right`` on; places differ."""
        shift = self.shift[left % COVER, right % COVER]
        length = self._compare(left, right, shift)
        on = np.flatnonzero(length == shift)
        a, b = left[on] + shift[on], right[on] + shift[on]
        inside = (a < self.n) & (b < self.n)
        on, a, b = on[inside], self.rank[self.place[a[inside]]], self.rank[self.place[b[inside]]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            own = level == k
            table = self.minima[k]
            length[on[own]] += np.minimum(table[low[own]], table[high[own] - (1 << int(k))])
        return length


def harmonic_grid(begins: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) so that every run holds a place whose period-th successor it holds too.

    A run of period q has q * MIN_PERIODS numbers at least, so one place in q * (MIN_PERIODS - 1) will do.
    """
    held, count = [], 0
    alive = np.flatnonzero(sizes >= MIN_WORDS)
    period = 1
    while True:
        alive = alive[sizes[alive] >= period * MIN_PERIODS]
        if not len(alive):
            break
        step = (MIN_PERIODS - 1) * period
        points = (sizes[alive] - period - 1) // step + 1
        total = int(points.sum())
        nth = np.arange(total) - np.repeat(np.cumsum(points) - points, points)
        held.append((np.repeat(begins[alive], points) + nth * step, np.full(total, period)))
        count += total
        if count >= PAIR_STEP:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, count = [], 0
        period += 1
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def find_runs(codes: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs in ``codes``, by start, then period.

    ``begins`` and ``sizes`` bound the texts; each is followed by a number that occurs once.
    """
    none = np.zeros((0, 3), dtype=np.int64)
    if not (sizes >= MIN_WORDS).any():
        return none
    right = left = None
    found = [none]
    n = len(codes)
    for place, period in harmonic_grid(begins, sizes):
        same = codes[place] == codes[place + period]
        place, period = place[same], period[same]
        if not len(place):
            continue
        if right is None:
            right, left = CoverExtension(codes), CoverExtension(codes[::-1])
        end = place + period + right.extend(place, place + period)
        start = place - left.extend(n - place, n - place - period) if len(place) else place
        long = end - start >= np.maximum(MIN_WORDS, MIN_PERIODS * period)
        found.append(np.unique(np.stack((start[long], end[long], period[long]), axis=1), axis=0))
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # the same stretch has only multiples of its smallest period
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """(start, length, period) with the greatest exact length / period, then the smallest start and period."""
    if not runs:
        return None
    share = np.array([length / period for _, length, period in runs])
    near = [runs[i] for i in np.flatnonzero(share >= share.max() * (1 - 1e-9))]
    return min(near, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


def _runs_of_texts(texts: list[bytes]) -> Iterator[tuple]:
    """(number of words, runs, collapsed text) of every text."""
    words = [t.split() for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    numbers: dict[bytes, int] = {}
    codes = np.empty(int(sizes.sum()) + len(words), dtype=np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    for begin, own in zip(begins, words):
        codes[begin : begin + len(own)] = [numbers.setdefault(w, len(numbers)) for w in own]
    codes[begins + sizes] = len(numbers) + np.arange(len(words))
    runs = find_runs(codes, begins, sizes)
    cuts = np.searchsorted(runs[:, 0], np.append(begins, len(codes)))
    for number, own in enumerate(words):
        mine = runs[cuts[number] : cuts[number + 1]]
        if not len(mine):
            yield len(own), [], b" ".join(own)
            continue
        mine = mine - [begins[number], begins[number], 0]
        change = np.zeros(len(own) + 1, dtype=np.int64)
        np.add.at(change, mine[:, 0] + mine[:, 2], 1)
        np.add.at(change, mine[:, 1], -1)
        kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
        yield len(own), [(int(s), int(e - s), int(q)) for s, e, q in mine], b" ".join([own[i] for i in kept])


def _steps(texts: list[bytes | None]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        text = text or b""
        if held and size + len(text) > STEP_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs, best, collapsed.

    ``runs`` are the maximal stretches of ``MIN_PERIODS`` periods and ``MIN_WORDS`` words at least
    with their smallest period, by start, then period: (start, length, period) in words. ``best``
    has the greatest length / period (then the smallest start, then period), null without a run.
    ``collapsed`` is the UTF-8 text without the words that follow the first period of a run, joined
    by one space. Null, empty and blank texts have no words, no run and an empty ``collapsed``;
    rows with a null or repeated id are worked on like all others; other columns are not read; an
    empty table gives no rows.

    Nothing is shuffled. Texts of a batch are laid behind each other, with a number that occurs
    once after each, and searched together; memory grows with the longest text (about 150 bytes a
    word), not with the number of texts.
    """
    ship_package(docs.sparkSession)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()),
        ("runs", pa.list_(run := pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("best", run), ("collapsed", pa.binary()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("start", "length", "period")
        as_run = lambda r: r and dict(zip(names, r))
        for batch in batches:
            ids, at = batch.column(0), 0
            for texts in _steps(batch.column(1).to_pylist()):
                sizes, runs, kept = zip(*_runs_of_texts(texts))
                columns = [
                    ids.slice(at, len(texts)), pa.array(sizes, pa.int64()),
                    pa.array([[as_run(r) for r in own] for own in runs], schema.field("runs").type),
                    pa.array([as_run(strongest(own)) for own in runs], run), pa.array(kept, pa.binary()),
                ]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(work, FOUND)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents in which about one in ten repeats a stretch of its words up to its end.

    With h the crc32 of the decimal id and g = h / 10, rows with h % 10 = 0 get a period of
    p = 1 + (n - a) / (3 + g % 8) words from word a = g % n on. Rows without an id stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)
    trimmed = F.btrim(text_or_empty(text_col), F.lit(BLANK_CHARS))
    words = F.split(trimmed, BLANKS)
    n = F.size(words).cast("long")
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    changed = F.transform(
        F.col("__words"),
        lambda word, i: F.when(i < F.col("__a"), word).otherwise(
            F.get("__words", (F.col("__a") + F.pmod(i - F.col("__a"), F.col("__p"))).cast("int"))
        ),
    )
    hit = (F.pmod(h, F.lit(10)) == 0) & (trimmed != "")
    return (
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
            F.when(hit, words).alias("__words"), F.when(hit, a).alias("__a"), F.when(hit, p).alias("__p"),
        )
        .select(
            "doc_id",
            F.when(F.col("__words").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"),
        )
    )


def run_digests(found: DataFrame) -> DataFrame:
    """The columns of ``periodic_runs`` as numbers and digests, one row per document."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
