"""Quality classifier: a linear support vector machine on naive Bayes scaled n-gram indicators."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingofold.llm.common import CACHED_WORDS, ROWS_PER_STEP, given_back, labelled, map_batches
from lingofold.session import ship_package

BITS = 18
#: The classifier is fitted on at most so many labelled rows, those with the smallest id hashes.
LABELLED_ROWS = 4_000
HOLD_OUT = 5
THRESHOLD = 0.3
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 20
FOLDS = 3

TOKEN = re.compile(r"[^\W\d_]+|\d+|\n|[^\w\s]+|_+")


class TokenCodes(dict):
    """Token -> its hash, with a shape code in the upper half; a table of bounded size."""

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        if token[0].isalpha():
            shape = "U" if token.isupper() and len(token) > 1 else "C" if token[0].isupper() else "a"
        else:
            shape = "0" if token[0].isdigit() else token[:3]
        low = xxhash.xxh32_intdigest(token.lower())
        value = self[token] = (xxhash.xxh32_intdigest(shape, 7) << 32) | low
        return value


def indicators(text: str | None, codes: TokenCodes) -> np.ndarray:
    """Sorted distinct feature numbers: words, word pairs, shapes in runs of one to three.

    A word that repeats the word before it has a shape of its own.
    """
    tokens = TOKEN.findall(text) if text else []
    if not tokens:
        return np.zeros(0, dtype=np.int32)
    both = np.fromiter(map(codes.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    words, shapes = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
    shapes[1:][words[1:] == words[:-1]] = 1
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    shape_pairs = shapes[:-1] * a + shapes[1:]
    grams = [
        words * b + np.uint64(1),
        (words[:-1] * a + words[1:]) * b + np.uint64(2),
        shapes * b + np.uint64(3),
        shape_pairs * b + np.uint64(4),
        (shape_pairs[:-1] * a + shapes[2:]) * b + np.uint64(5),
    ]
    found = np.concatenate([g * a >> np.uint64(64 - BITS) for g in grams if len(g)])
    return np.unique(found.astype(np.int32))


@dataclass
class QualityModel:
    """``score = 1 / (1 + exp(slope * margin + offset))``; the margin is ``weights`` over norm."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, features: np.ndarray) -> float:
        norm = np.sqrt(self.squares[features].sum())
        return float(self.weights[features].sum() / norm + self.bias) if norm > 0 else self.bias

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(np.clip(self.slope * self.margin(features) + self.offset, -30, 30))))


def log_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Log ratio of the classes' smoothed indicator frequencies; 0 for features never seen."""
    counts = np.zeros((2, 1 << BITS))
    for features, label in zip(rows, good, strict=True):
        counts[int(label), features] += 1
    p, q = counts[1] + SMOOTHING, counts[0] + SMOOTHING
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    ratio[counts.sum(axis=0) == 0] = 0
    return ratio


def descend(rows: list[np.ndarray], good: np.ndarray, ratio: np.ndarray, seed: int = 0) -> tuple[np.ndarray, float]:
    """Linear hinge-loss model by dual coordinate descent; classes weigh alike.

    Rows are the indicators times ``ratio``, scaled to length 1, and a constant for the bias.
    """
    sign = np.where(good, 1.0, -1.0)
    cost = COST * len(rows) / (2 * np.where(good, max(good.sum(), 1), max((~good).sum(), 1)))
    values = [ratio[f] for f in rows]
    values = [v / n if (n := np.sqrt((v * v).sum())) > 0 else v for v in values]
    square = np.array([(v * v).sum() + 1 for v in values])
    weights, bias, dual = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    random = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in random.permutation(len(rows)):
            gradient = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(dual[i] - gradient / square[i], 0), cost[i])
            if step := (new - dual[i]) * sign[i]:
                weights[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
                dual[i] = new
        if moved < 1e-4:
            break
    return weights * ratio, bias


def sigmoid(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability by Newton steps on smoothed targets."""
    up, down = good.sum(), (~good).sum()
    target = np.where(good, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = -1.0, float(np.log((down + 1) / (up + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(np.clip(a * margins + b, -30, 30)))
        d, h = target - p, p * (1 - p)
        grad = np.array([(d * margins).sum(), d.sum()])
        hess = np.array([[(h * margins * margins).sum(), (h * margins).sum()], [(h * margins).sum(), h.sum()]])
        step = np.linalg.solve(hess + 1e-3 * np.eye(2), grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return min(float(a), -0.1), float(b)


def train(rows: list[np.ndarray], good: np.ndarray) -> QualityModel:
    """Calibrated on margins of rows that the fold's model has not seen."""
    if not len(rows) or good.all() or not good.any():
        share = float(good.mean()) if len(rows) else 0.5
        share = min(max(share, 0.01), 0.99)
        return QualityModel(np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, -1.0, float(np.log((1 - share) / share)))

    def model(pick: np.ndarray) -> QualityModel:
        some = [rows[i] for i in np.flatnonzero(pick)]
        ratio = log_ratios(some, good[pick])
        weights, bias = descend(some, good[pick], ratio)
        return QualityModel(weights, ratio * ratio, bias, -1.0, 0.0)

    margins = np.zeros(len(rows))
    fold = np.arange(len(rows)) % FOLDS
    for k in range(FOLDS):
        part = model(fold != k)
        for i in np.flatnonzero(fold == k):
            margins[i] = part.margin(rows[i])
    final = model(np.ones(len(rows), dtype=bool))
    final.slope, final.offset = sigmoid(margins, good)
    return final


def held_out(id_col: str):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % HOLD_OUT == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = LABELLED_ROWS) -> QualityModel:
    """Fit on at most ``rows`` labelled documents whose crc32 of the id is no multiple of 5."""
    spark = docs.sparkSession
    usable = labels.where(~held_out("doc_id")).withColumn("at", F.xxhash64(F.col("doc_id").cast("string")))
    usable = labelled(usable.select("doc_id", "at").distinct(), labels, "quality", "doc_id")
    usable = usable.orderBy("at", "doc_id").limit(rows).select("doc_id", "at", "label")
    # at most LABELLED_ROWS short rows
    chosen = spark.createDataFrame(usable.collect(), usable.schema)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    sample = texts.join(F.broadcast(chosen), "doc_id").select("at", "label", "body")

    def read(batch: dict) -> dict:
        codes = TokenCodes()
        return {"at": batch["at"], "label": batch["label"], "found": [indicators(t, codes) for t in batch["body"]]}

    got = map_batches(sample, read, "at long, label int, found array<int>").orderBy("at", F.size("found"), "found").limit(rows).toPandas()
    found = [np.asarray(f, dtype=np.int32) for f in got["found"]]
    return train(found, got["label"].to_numpy() == 1)


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    The whole text is scored, in place. Null and empty texts have no indicators and get the score
    of the bias alone. A null id counts as an empty text for ``held_out``. Repeated rows score
    alike; an empty table gives no rows. ``predicted`` is 1 from a score of ``THRESHOLD`` on.
    """
    state = docs.sparkSession.sparkContext.broadcast(model)  # 2 * 2 ** BITS numbers, a fixed size
    codes = TokenCodes()

    def score(batch: dict) -> dict:
        known = state.value
        return {id_col: batch[id_col], "score": [known.score(indicators(t, codes)) for t in batch[text_col]]}

    kind = docs.schema[id_col].dataType.simpleString()
    scored = map_batches(docs.select(id_col, text_col), score, f"`{id_col}` {kind}, score double")
    return scored.select(
        id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of ``THRESHOLD`` or more, with all their columns, whatever
    these are called. Null and empty texts get the score of the bias alone."""
    ship_package(docs.sparkSession)
    state = docs.sparkSession.sparkContext.broadcast(model)
    codes = TokenCodes()
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(batches):
            for start in range(0, batch.num_rows, ROWS_PER_STEP):
                part = batch.slice(start, ROWS_PER_STEP)
                scores = [state.value.score(indicators(t, codes)) for t in part.column(at).to_pylist()]
                yield part.filter(pa.array([s >= THRESHOLD for s in scores], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
