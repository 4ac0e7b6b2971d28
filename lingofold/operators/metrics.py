"""Quality and load reports."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingofold.session import ship_package, stage_table

from .lookup import lookup_join


def lid_f1(df: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """Per true language: micro F1 over its rows (the share found), and precision, recall, F1.

    One pass: each row counts for its true and for its predicted language.
    """
    right = F.coalesce(F.col(truth) == F.col(pred), F.lit(False)).cast("bigint")
    roles = df.select(
        F.explode(
            F.array(
                F.struct(F.col(truth).alias("lang"), F.lit(1).alias("is_true"),
                         F.lit(0).alias("is_pred"), right.alias("hit")),
                F.struct(F.col(pred).alias("lang"), F.lit(0).alias("is_true"),
                         F.lit(1).alias("is_pred"), F.lit(0).cast("bigint").alias("hit")),
            )
        ).alias("r")
    ).select("r.*").filter(F.col("lang").isNotNull())
    sums = roles.groupBy("lang").agg(
        F.sum("is_true").alias("n_true"), F.sum("is_pred").alias("n_pred"), F.sum("hit").alias("hits")
    )
    recall = F.try_divide(F.col("hits").cast("double"), F.col("n_true"))
    precision = F.try_divide(F.col("hits").cast("double"), F.col("n_pred"))
    f1 = F.try_divide(2.0 * F.col("hits"), F.col("n_true") + F.col("n_pred"))
    return sums.select(
        "lang", "n_true", "n_pred", "hits", recall.alias("micro_f1"),
        precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
    )


def golden_outcomes(df: DataFrame, pred: str = "sentences", target: str = "target") -> DataFrame:
    """Add ``outcome``: size, text or exact."""
    outcome = (
        F.when(F.size(pred) != F.size(target), "size")
        .when(F.col(pred) != F.col(target), "text")
        .otherwise("exact")
    )
    return df.withColumn("outcome", outcome)


def golden_fraction(df: DataFrame, pred: str = "sentences", target: str = "target") -> DataFrame:
    rows = golden_outcomes(df, pred, target)

    def tally(kind: str) -> Column:
        return F.count_if(F.col("outcome") == kind).alias(f"n_{kind}")

    return rows.agg(
        F.count(F.lit(1)).alias("n"), tally("size"), tally("text"), tally("exact"),
        F.avg((F.col("outcome") == "exact").cast("int")).alias("fraction"),
    )


def _ranked_from_last(labels: DataFrame) -> DataFrame:
    """(label, n_later): how many labels come after each, by ranges and their offsets."""
    parts = int(labels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage_table(
        labels.repartitionByRange(parts, F.desc("label")).select("label", F.spark_partition_id().alias("range")),
        "label-ranges",
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    inside = F.row_number().over(Window.partitionBy("range").orderBy(F.desc("label"))) - 1
    return ranged.join(F.broadcast(offsets), "range").select("label", (F.col("offset") + inside).alias("n_later"))


def topk_accuracy(
    probs: DataFrame, truth: DataFrame, labels: DataFrame, ks=(1, 5), refused: DataFrame | None = None
) -> DataFrame:
    """One row with ``n`` and ``top<k>``: is the true label among the k most probable.

    ``probs(query_id, label, prob)`` needs only classes with a positive probability; the others
    count as 0. Equal probabilities rank the later label first. ``labels(label)`` is the class
    list; it is ranked once, and no row per query and class is made. Rows ``refused(query_id)`` were
    not classified: they are misses and have no rank.
    """
    if refused is not None:
        missed = truth.join(refused.select("query_id"), "query_id", "left_semi")
        truth = truth.join(refused.select("query_id"), "query_id", "left_anti")
    order = _ranked_from_last(labels.select("label").distinct())
    marked = lookup_join(
        truth.select("query_id", F.col("label").alias("truth")),
        order.withColumnRenamed("label", "truth"),
        ["truth"], "inner", salt_by=["query_id"],
    )
    rows = marked.join(probs.filter("prob > 0"), "query_id", "left")
    own = F.max(F.when(F.col("label") == F.col("truth"), F.round("prob", 9)))
    per_query = rows.groupBy("query_id", "truth", "n_later").agg(
        own.alias("own"),
        F.sort_array(F.collect_list(F.struct(F.round("prob", 9).alias("p"), "label"))).alias("all"),
    )
    listed = F.filter("all", lambda c: c["label"].isNotNull())
    ahead = F.size(
        F.filter(
            listed,
            lambda c: (c["p"] > F.col("own"))
            | ((c["p"] == F.col("own")) & (c["label"] > F.col("truth"))),
        )
    )
    later_listed = F.size(F.filter(listed, lambda c: c["label"] > F.col("truth")))
    unlisted_rank = F.size(listed) + F.col("n_later") - later_listed + 1
    ranked = per_query.withColumn(
        "rank", F.when(F.col("own").isNotNull(), ahead + 1).otherwise(unlisted_rank)
    )
    ranks = ranked.select("rank")
    if refused is not None:
        ranks = ranks.unionByName(missed.select(F.lit(None).cast("int").alias("rank")))
    return ranks.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.coalesce(F.col("rank") <= k, F.lit(False)).cast("int")).alias(f"top{k}") for k in ks],
    )


def weighted_mean(df: DataFrame, value: str, weight: str) -> DataFrame:
    return df.agg(
        F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias("weighted_mean")
    )


# Smoothing and orders of chrF2++.
CHRF_EPSILON = 1e-16
#: Every character that counts as white space.
CHRF_BLANKS = (
    "\t\n\u000b\f\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
CHRF_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def chrf_words(text: Column) -> Column:
    """Words with one punctuation mark split off: the last if there is one, else the first."""
    edge = F.lit(CHRF_PUNCTUATION)

    def split(word: Column) -> Column:
        last, first = F.right(word, F.lit(1)), F.left(word, F.lit(1))
        size = F.length(word)
        return (
            F.when(size <= 1, F.array(word))
            .when(F.contains(edge, last), F.array(F.left(word, size - 1), last))
            .when(F.contains(edge, first), F.array(first, F.substr(word, F.lit(2))))
            .otherwise(F.array(word))
        )

    found = F.split(F.btrim(F.regexp_replace(text, f"[{CHRF_BLANKS}]+", " ")), " ")
    return F.flatten(F.transform(F.filter(found, lambda w: w != ""), split))


def _chrf_counter(char_order: int, word_order: int):
    orders = char_order + word_order

    def grams(text: str, tokens: list[str], order: int) -> Counter:
        if order <= char_order:
            return Counter(text[i : i + order] for i in range(len(text) - order + 1))
        n = order - char_order
        return Counter(zip(*[tokens[i:] for i in range(n)]))

    @F.arrow_udf("array<bigint>")
    def count(hyp: pa.Array, hyp_words: pa.Array, ref: pa.Array, ref_words: pa.Array) -> pa.Array:
        out = []
        columns = (hyp, hyp_words, ref, ref_words)
        for h, hw, r, rw in zip(*[c.to_pylist() for c in columns]):
            row = []
            for order in range(1, orders + 1):
                left, right = grams(h, hw, order), grams(r, rw, order)
                # n-grams of an order that the segment's reference does not have are not counted
                row += (left.total() if right else 0, right.total(), (left & right).total())
            out.append(row)
        return pa.array(out, pa.list_(pa.int64()))

    return count


def chrf_counts(
    df: DataFrame,
    group_by: list[str] | None = None,
    hyp: str = "hyp",
    ref: str = "ref",
    char_order: int = 6,
    word_order: int = 2,
) -> DataFrame:
    """(group, order, hyp, ref, match): n-gram counts summed over the corpus.

    A segment's n-gram multisets are intersected where the row is, in an Arrow function: as rows
    they would be some 14 per character. One short row per order and task is shuffled.
    """
    ship_package(df.sparkSession)
    groups = group_by or []
    orders = char_order + word_order
    sides = []
    for side in (hyp, ref):
        text = F.coalesce(side, F.lit(""))
        sides += [F.regexp_replace(text, f"[{CHRF_BLANKS}]+", ""), chrf_words(text)]
    counts = df.select(*groups, _chrf_counter(char_order, word_order)(*sides).alias("c"))
    per_order = F.array(
        *[
            F.struct(
                F.lit(o + 1).alias("order"),
                *[F.get("c", F.lit(3 * o + i)).alias(n) for i, n in enumerate(("h", "r", "m"))],
            )
            for o in range(orders)
        ]
    )
    return (
        counts.select(*groups, F.explode(per_order).alias("x"))
        .groupBy(*groups, F.col("x.order").alias("order"))
        .agg(F.sum("x.h").alias("hyp"), F.sum("x.r").alias("ref"), F.sum("x.m").alias("match"))
        .filter("hyp + ref > 0")
    )


def chrf(
    df: DataFrame,
    group_by: list[str] | None = None,
    hyp: str = "hyp",
    ref: str = "ref",
    char_order: int = 6,
    word_order: int = 2,
    beta: int = 2,
) -> DataFrame:
    """Corpus chrF2++ with epsilon smoothing, one reference: (group, score) on 0..100."""
    counts = chrf_counts(df, group_by, hyp, ref, char_order, word_order)
    orders = char_order + word_order
    tiny, factor = F.lit(CHRF_EPSILON), float(beta * beta)

    def part(match: Column, total: Column) -> Column:
        return F.when(total > 0, match.cast("double") / total).otherwise(tiny)

    per_order = counts.select(
        *(group_by or []),
        part(F.col("match"), F.col("hyp")).alias("p"),
        part(F.col("match"), F.col("ref")).alias("r"),
    )
    down = factor * F.col("p") + F.col("r")
    f = F.when(down > 0, (1 + factor) * F.col("p") * F.col("r") / down).otherwise(tiny)
    # An order without any n-gram on either side has no row; it counts as epsilon.
    total = F.sum(f) + (F.lit(orders) - F.count(F.lit(1))) * tiny
    result = (100 * total / orders).alias("score")
    return (per_order.groupBy(*group_by) if group_by else per_order).agg(result)


def make_blocks(
    df: DataFrame,
    idx_col: str = "idx",
    text_col: str = "sentence",
    group_by: list[str] | None = None,
    batch: int = 60,
    parts: int = 3,
) -> DataFrame:
    """Runs of ``batch`` rows cut into ``parts`` near-equal blocks, texts joined by a space.

    (group, batch, part, n, text); earlier blocks of a run get the extra rows.
    """
    groups = group_by or []
    placed = df.withColumn("batch", F.floor(F.col(idx_col) / batch))
    run = Window.partitionBy(*groups, "batch").orderBy(idx_col)
    return (
        placed.withColumn("part", F.ntile(parts).over(run) - 1)
        .groupBy(*groups, "batch", "part")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.expr(f"listagg({text_col}, ' ') within group (order by {idx_col})").alias("text"),
        )
    )


def mean_over_groups(
    expected: DataFrame, scores: DataFrame, key: str = "lang", score_col: str = "score"
) -> DataFrame:
    """One row: plain mean over the groups that have a score, and the list of those that failed."""
    joined = expected.select(key).distinct().join(scores.select(key, score_col), key, "left")
    failed = F.array_sort(
        F.collect_list(F.when(F.col(score_col).isNull(), F.col(key).cast("string")))
    )
    return joined.agg(
        F.avg(score_col).alias("mean_score"),
        F.count(score_col).alias("n_scored"),
        F.array_join(failed, ",").alias("failed"),
    )


def src_effect(
    df: DataFrame, key: str = "lang", flag: str = "use_src", score_col: str = "score"
) -> DataFrame:
    """(lang, with_src, without_src, difference) from rows (lang, use_src, score)."""
    with_src = F.avg(F.when(F.col(flag), F.col(score_col)))
    without = F.avg(F.when(~F.col(flag), F.col(score_col)))
    return df.groupBy(key).agg(with_src.alias("with_src"), without.alias("without_src")).withColumn(
        "difference", F.col("with_src") - F.col("without_src")
    )


#: Quantile sketches: their size, and twice the rank error that they keep to in 99 of 100 cases.
SKETCH_SIZE = 4096
SKETCH_ERROR = 0.0026
#: Quantiles taken from a sketch.
GRID = 1000
#: Rows of a span whose values are ordered by one task.
SMALL_SPAN = 200_000
MOST_LEVELS = 12


def _in_spans(rows: DataFrame, spans: DataFrame, keys: list[str], extra: list[str]) -> DataFrame:
    """(keys, low, high, extra, v): every value with the spans of its group that hold it."""
    names = ["low", "high", *extra]
    lists = spans.select(*keys, *names).distinct().groupBy(*keys).agg(
        F.collect_list(F.struct(*names)).alias("spans")  # two per wanted rank at the most
    )
    met = lookup_join(rows, lists, keys, "inner", salt_by=["v"])
    held = F.filter("spans", lambda x: (F.col("v") >= x["low"]) & (F.col("v") <= x["high"]))
    return met.select(*keys, "v", F.explode(held).alias("s")).select(*keys, *[f"s.{n}" for n in names], "v")


def exact_percentiles(
    df: DataFrame,
    keys: list[str],
    value_col: str,
    probs: list[float],
    sketch_size: int = SKETCH_SIZE,
    small: int = SMALL_SPAN,
    error: float = SKETCH_ERROR,
) -> DataFrame:
    """(keys, prob, value): exact interpolated percentiles without gathering a group.

    Mergeable quantile sketches of each group bound the wanted ranks by two values of the column,
    whatever its distribution. Exact counts confirm that the rank lies between them (else the wider
    span stays), and spans with more than ``small`` rows are sketched again. Only the distinct values
    of small spans are ordered. A group of any size is thus read by all tasks.
    """
    rows = df.select(*keys, F.col(value_col).cast("double").alias("v")).filter("v is not null")
    whole = rows.groupBy(*keys).agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("inside")
    )
    place = (F.col("inside") - 1) * F.col("prob")
    wanted = stage_table(
        whole.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
        .withColumn("place", place)
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place")))))
        .withColumn("before", F.lit(0).cast("bigint")),
        "ranks",
    )
    for _ in range(MOST_LEVELS):
        wide = wanted.where((F.col("inside") > small) & (F.col("low") < F.col("high")))
        if wide.isEmpty():
            break
        closer = _closer(rows, wide, keys, sketch_size, error)
        kept = wanted.where((F.col("inside") <= small) | (F.col("low") >= F.col("high")))
        wanted = stage_table(kept.unionByName(closer), "ranks")
    values = _in_spans(rows, wanted, keys, []).groupBy(*keys, "low", "high", "v").agg(F.count(F.lit(1)).alias("c"))
    running = F.sum("c").over(Window.partitionBy(*keys, "low", "high").orderBy("v"))
    placed = values.withColumn("upto", running).withColumn("from", F.col("upto") - F.col("c"))
    offset = F.col("rank") - F.col("before")
    found = wanted.join(placed, [*keys, "low", "high"]).filter((offset >= F.col("from")) & (offset < F.col("upto")))
    upper = F.col("place") - F.floor("place")
    share = F.when(F.col("rank") == F.floor("place"), 1 - upper).otherwise(upper)
    return found.groupBy(*keys, "prob").agg(F.sum(F.col("v") * share).alias("value"))


def _closer(rows: DataFrame, wide: DataFrame, keys: list[str], sketch_size: int, error: float) -> DataFrame:
    """``wide`` with narrower spans from sketches of the values in them, confirmed by counts."""
    span = [*keys, "low", "high"]
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    sketch = F.kll_sketch_agg_double("v", F.lit(sketch_size))
    sketches = _in_spans(rows, wide, keys, []).groupBy(*span).agg(sketch.alias("sketch")).select(
        *span, F.kll_sketch_get_quantile_double("sketch", steps).alias("grid")
    )
    rank, n = F.col("rank") - F.col("before"), F.col("inside")
    slack = F.ceil(n * error)
    least = F.get("grid", F.floor(F.greatest(rank - slack, F.lit(0)) / n * GRID).cast("int"))
    most = F.get("grid", F.ceil(F.least(rank + slack + 1, n) / n * GRID).cast("int"))
    bounds = stage_table(
        wide.join(sketches, span)
        .withColumn("least", F.when(rank - slack <= 0, F.col("low")).otherwise(F.greatest(least, F.col("low"))))
        .withColumn("most", F.when(rank + slack + 1 >= n, F.col("high")).otherwise(F.least(most, F.col("high"))))
        .drop("grid"),
        "rank-bounds",
    )
    counts = _in_spans(rows, bounds, keys, ["least", "most"]).groupBy(*span, "least", "most").agg(
        F.count_if(F.col("v") < F.col("least")).alias("below"),
        F.count_if(F.col("v").between(F.col("least"), F.col("most"))).alias("between"),
    )
    joined = bounds.join(counts, [*span, "least", "most"])
    good = (rank >= F.col("below")) & (rank < F.col("below") + F.col("between"))
    return joined.select(
        *keys, "prob", "place", "rank",
        F.when(good, F.col("least")).otherwise(F.col("low")).alias("low"),
        F.when(good, F.col("most")).otherwise(F.col("high")).alias("high"),
        F.when(good, F.col("between")).otherwise(n).alias("inside"),
        (F.col("before") + F.when(good, F.col("below")).otherwise(F.lit(0))).alias("before"),
    )


def latency_report(
    log: DataFrame,
    keys: list[str],
    latency_col: str,
    time_col: str,
    probs: tuple[float, ...] = (0.5, 0.9, 0.95, 0.99),
) -> DataFrame:
    """Per service: n, throughput per second, mean, standard deviation, exact percentiles."""
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    seconds = (F.max(micros) - F.min(micros)) / 1e6
    basic = log.groupBy(*keys).agg(
        F.count(latency_col).alias("n"),
        F.try_divide(F.count(F.lit(1)).cast("double"), seconds).alias("throughput"),
        F.avg(latency_col).alias("mean"),
        F.stddev_samp(latency_col).alias("std"),
    )
    ranks = exact_percentiles(log, keys, latency_col, list(probs))
    wide = ranks.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(f"p{p * 100:g}")
            for p in probs
        ]
    )
    return basic.join(wide, keys, "left")


def batch_efficiency(log: DataFrame, keys: list[str], batch_col: str, rows_col: str) -> DataFrame:
    """(keys, n_rows, n_batches, rows_per_batch) from one log row per request."""
    return log.groupBy(*keys, batch_col).agg(F.sum(rows_col).alias("__rows")).groupBy(*keys).agg(
        F.sum("__rows").alias("n_rows"),
        F.count(batch_col).alias("n_batches"),
        F.try_divide(F.sum("__rows").cast("double"), F.count(batch_col)).alias("rows_per_batch"),
    )

