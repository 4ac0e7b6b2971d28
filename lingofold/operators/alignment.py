"""A bilingual lexicon learned from aligned sentences by expectation maximisation."""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingofold.functions.text import words
from lingofold.session import ship_package, stage_table

from .lookup import lookup_join
from .word_blocks import BLOCK, CODES, WORD, with_values, word_blocks

ROUNDS = 4
FLOOR = 1e-3
#: A candidate has so many links, and so large a share of its token's strongest association.
LEAST_LINKS = 2
LEAST_ASSOCIATION = 0.1
#: Words of a side of the parts that long pairs can be cut into.
MAX_WORDS = 32
#: Probabilities that agree in so many digits are equal; a floor is compared in more.
TIE_DIGITS = 10
FLOOR_DIGITS = 12

CORE = r"[^\p{L}\p{N}]"
LANGS = ["src", "tgt"]
ENTRY = [*LANGS, "token", "translation"]
#: A link is one number, the id of its token and the id of its translation behind each other.
ID_BITS = 31
#: Links that a task makes at once.
STEP_LINKS = 1_000_000
#: An odd number: times it, links lie evenly in 64 bits.
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Links that a task sums at once, and links left that a worker looks up at once.
BUCKET_LINKS = 1_000_000
KEPT_LINKS = 4_000_000
#: Pairs that Spark hands to a Python worker at once; a pair can be long.
BATCH_ROWS = 2_000
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Memory of a broadcast table as measured; the driver holds it several times over.
LINK_BROADCAST_BYTES = 32 << 20
#: Links that move in one turn, per word of the sentences.
TURN_LINKS = 2


def core_token(word: Column) -> Column:
    """A word in lower case, without the punctuation around it."""
    return F.lower(F.regexp_replace(word, f"^{CORE}+|{CORE}+$", ""))


def core_tokens(text: Column) -> Column:
    return F.filter(F.transform(words(text), core_token), lambda t: t != "")


def aligned_parts(pairs: DataFrame, max_words: int | None = None) -> DataFrame:
    """(row, src, tgt, weight, source, target): token arrays, written.

    Equal pairs are one row with their number as ``weight``. Pairs are whole; with ``max_words`` a pair
    with more words on a side is cut at the same relative places of both sides, and words that lie in
    different parts are not linked. ``row`` is unique.
    """
    # nothing is filtered before the ids are there: a filter would move down and make all tokens again
    distinct = (
        pairs.groupBy(*LANGS, "source", "target")
        .agg(F.count(F.lit(1)).alias("weight"))
        .select(*LANGS, "weight", core_tokens(F.col("source")).alias("s"), core_tokens(F.col("target")).alias("t"))
    )
    row = F.monotonically_increasing_id().alias("row")
    if max_words is None:
        rows = distinct.select(row, *LANGS, "weight", F.col("s").alias("source"), F.col("t").alias("target"))
        return stage_table(rows.where((F.size("source") > 0) & (F.size("target") > 0)), "aligned-parts")
    parts = F.greatest(F.ceil(F.greatest(F.size("s"), F.size("t")) / F.lit(max_words)).cast("int"), F.lit(1))

    def cut(side: str) -> Column:
        begin = F.floor(F.col("part") * F.size(side) / F.col("parts")).cast("int")
        end = F.floor((F.col("part") + 1) * F.size(side) / F.col("parts")).cast("int")
        return F.slice(side, begin + 1, end - begin)

    numbered = distinct.withColumn("parts", parts).withColumn(
        "part", F.explode_outer(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    rows = numbered.select(row, *LANGS, "weight", cut("s").alias("source"), cut("t").alias("target"))
    return stage_table(rows.where((F.size("source") > 0) & (F.size("target") > 0)), "aligned-parts")


def _in_blocks(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The parts in blocks that number their own tokens, see ``word_blocks``; ``n`` is the size of ``source``."""
    return word_blocks(
        parts.select("row", *LANGS, "weight", F.size("source").alias("n"), F.concat("source", "target").alias("tokens")),
        "tokens", LANGS,
    )


def numbered_tokens(parts: DataFrame, blocks: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(src, tgt, token, id): every token of either side, numbered from 0 without gaps, written.

    Only the number of tokens per task is collected.
    """
    tokens = (blocks or _in_blocks(parts))[1].select(*LANGS, F.col(WORD).alias("token")).distinct()
    # the place in its task has 33 bits, the task the rest
    found = stage_table(tokens.withColumn("place", F.monotonically_increasing_id()), "tokens")
    task = F.shiftright("place", 33)
    sizes = {r["task"]: r["n"] for r in found.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, before = [], 0
    for number in range(max(sizes, default=0) + 1):
        offsets.append(before)
        before += sizes.get(number, 0)
    if before >> ID_BITS:
        raise ValueError(f"more than {1 << ID_BITS} tokens")
    start = F.get(F.array(*[F.lit(n).cast("long") for n in offsets]), task.cast("int"))
    return stage_table(
        found.select(*LANGS, "token", (start + F.col("place").bitwiseAND((1 << 33) - 1)).alias("id")), "numbered-tokens"
    )


def _encoded(parts: DataFrame, tokens: DataFrame, blocks: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(row, weight, source, target): the parts with token ids for tokens, written.

    The numbers of all tokens are looked up once per block and different token.
    """
    rows, found = blocks or _in_blocks(parts)
    met = _looked_up(found.withColumnRenamed(WORD, "token"), tokens, [*LANGS, "token"], [BLOCK])
    ids = with_values(rows.select(BLOCK, "row", "weight", "n", CODES), met, "id", "ids")
    return stage_table(
        ids.select(
            "row", "weight", F.slice("ids", F.lit(1), F.col("n")).alias("source"),
            F.slice("ids", F.col("n") + 1, F.size("ids")).alias("target"),
        ),
        "encoded-parts",
    )


def _different(column) -> tuple[np.ndarray, ...]:
    """(token, row number, first place, number) of every different token of each array of ids."""
    sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
    ids, of = column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)
    found, first, times = np.unique((of << ID_BITS) | ids, return_index=True, return_counts=True)
    of = found >> ID_BITS
    return found & ((1 << ID_BITS) - 1), of, first - (np.cumsum(sizes) - sizes)[of], times


def _steps(batches):
    """(batch, row number in it, place of the translation, how often the token and the translation are
    in the row, link) of every possible link of different tokens, up to about ``STEP_LINKS`` at once."""
    for batch in batches:
        if not batch.num_rows:
            continue
        source, of, _, times_s = _different(batch.column("source"))
        target, of_t, place, times_t = _different(batch.column("target"))
        n_s = np.bincount(of, minlength=batch.num_rows)
        first = np.cumsum(n_s) - n_s
        size = np.cumsum(n_s[of_t])
        begin = 0
        while begin < len(target):
            done = size[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(size, done + STEP_LINKS, "right")))
            rows = of_t[begin:end]
            n = n_s[rows]
            at_t = np.repeat(np.arange(begin, end), n)
            at_s = np.arange(n.sum()) + np.repeat(first[rows] - (np.cumsum(n) - n), n)
            link = (source[at_s] << ID_BITS) | target[at_t]
            yield batch, of_t[at_t], place[at_t], times_s[at_s], times_t[at_t], link
            begin = end


def _mixed(link: np.ndarray) -> np.ndarray:
    """Another number for each link, spread evenly over 64 bits."""
    return link.astype(np.uint64) * MIX


def _blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The parts of ``values`` that end at ``ends``, as bytes."""
    offsets = np.concatenate([[0], ends]).astype(np.int32) * np.int32(values.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _numbers(column, kind) -> np.ndarray:
    """The numbers in all bytes of a column."""
    found = [np.frombuffer(value.as_buffer(), kind) for chunk in column.chunks for value in chunk]
    return np.concatenate(found) if found else np.empty(0, kind)


def _sums(link: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """(link, sums of the values): each link once, in the order of ``_mixed``."""
    order = np.argsort(_mixed(link))
    link = link[order]
    heads = np.flatnonzero(np.concatenate([[True], link[1:] != link[:-1]])) if len(link) else order
    return [link[heads], *[np.add.reduceat(v[order], heads) if len(link) else v for v in values]]


def _summed_links(batches, buckets: int):
    """(bucket, link, expected, n): links with the sums of their shares and weights, each once a step.

    A link has one bucket. A row holds all numbers of a bucket in one step, as bytes.
    """
    ends = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
    for batch, row, _, times_s, times_t, link in _steps(batches):
        n = batch.column("weight").to_numpy()[row] * times_s * times_t
        sums = _sums(link, n / batch.column("n_source").to_numpy()[row], n)
        until = np.append(np.searchsorted(_mixed(sums[0]), ends), len(sums[0]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(buckets, dtype=np.int32)), *[_blobs(v, until) for v in sums]],
            names=["bucket", "link", "expected", "n"],
        )


def _merged_links(table: pa.Table, least_links: int) -> pa.Table:
    """(link, expected, n) of the links of one bucket that are met often enough."""
    link, expected, n = _sums(
        _numbers(table["link"], np.int64), _numbers(table["expected"], np.float64), _numbers(table["n"], np.int64)
    )
    kept = n >= least_links
    return pa.table({"link": link[kept], "expected": expected[kept], "n": n[kept]})


def _every_link(batches, kept: np.ndarray | None = None):
    """(row, place, weight, link): one row per different token of ``target``, its first place, and place
    of ``source`` in a part; of the links in ``kept``, sorted, if given.

    A token that comes again in ``target`` adds to the weight.
    """
    if kept is not None:
        bits = np.uint64(64 - max(16, int(16 * len(kept)).bit_length()))
        maybe = np.zeros(1 << (64 - int(bits)), bool)
        maybe[_mixed(kept) >> bits] = True
    for batch, row, place, times_s, times_t, link in _steps(batches):
        if kept is not None:
            some = np.flatnonzero(maybe[_mixed(link) >> bits])
            near = np.minimum(np.searchsorted(kept, link[some]), len(kept) - 1)
            some = some[kept[near] == link[some]]
            row, place, times_s, times_t, link = row[some], place[some], times_s[some], times_t[some], link[some]
        weight = batch.column("weight").to_numpy()[row] * times_t
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(v, times_s))
                for v in (batch.column("row").to_numpy()[row], place.astype(np.int32), weight, link)
            ],
            names=["row", "place", "weight", "link"],
        )


def _token(link: str = "link") -> Column:
    return F.shiftright(link, ID_BITS)


def _translation(link: str = "link") -> Column:
    return F.col(link).bitwiseAND((1 << ID_BITS) - 1)


def _turns(parts: DataFrame) -> tuple[int, int]:
    """Number of turns in which all links are made, and of buckets in each: a turn makes about
    ``TURN_LINKS`` links per word, a bucket has ``BUCKET_LINKS``."""
    n_s, n_t = (F.size(F.array_distinct(side)).cast("long") for side in ("source", "target"))
    found = parts.agg(F.sum(n_s * n_t).alias("links"), F.sum(n_s + n_t).alias("words")).first()
    links = found["links"] or 0
    turns = max(1, -(-links // (TURN_LINKS * (found["words"] or 1))))
    least = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return turns, max(least, -(-links // (turns * BUCKET_LINKS)))


def _of_turn(parts: DataFrame, turn: int, turns: int) -> DataFrame:
    """The parts with the source words of one turn alone; ``n_source`` counts all of them."""
    own = F.filter("source", lambda token: token % turns == turn) if turns > 1 else F.col("source")
    rows = parts.select("row", "weight", F.size("source").alias("n_source"), own.alias("source"), "target")
    return rows.where(F.size("source") > 0)


def _by_turns(turns: int, make, name: str) -> DataFrame:
    """The rows of ``make(turn)`` of every turn, written turn by turn: the shuffle of one turn is
    gone before the next one starts."""
    return reduce(DataFrame.unionAll, [stage_table(make(turn), name) for turn in range(turns)])


def _candidates(parts: DataFrame, floor: float, least_links: int, least: float, turns: int, buckets: int) -> DataFrame:
    """The first table: equal shares of all links, for translations associated with their token.

    The association of a token s and a translation t is n(s, t)^2 / n(t) in links; it separates the
    translation of a rare word from the frequent words around it. The links are summed in the tasks
    that make them, so only sums move, as bytes of whole buckets. A turn has all links of its tokens,
    and a link belongs to one turn, so the links that are met too seldom go before the next turn makes
    its own.
    """

    def counted(turn: int) -> DataFrame:
        sums = _of_turn(parts, turn, turns).drop("row").mapInArrow(
            partial(_summed_links, buckets=buckets), "bucket int, link binary, expected binary, n binary"
        )
        return sums.groupBy("bucket").applyInArrow(
            lambda table: _merged_links(table, least_links), "link long, expected double, n long"
        )

    counts = _by_turns(turns, counted, "link-counts")
    counts = counts.withColumn("s", _token()).withColumn("t", _translation())
    seen = stage_table(counts.groupBy("t").agg(F.sum("n").alias("n_t")), "translations-seen")
    linked = _looked_up(counts, seen, ["t"], ["s"]).withColumn("association", F.col("n") * F.col("n") / F.col("n_t"))
    totals = stage_table(
        linked.groupBy("s").agg(F.sum("expected").alias("total"), F.max("association").alias("best")),
        "link-totals",
    )
    joined = _looked_up(linked, totals, ["s"], ["t"])
    strong = joined.where(F.col("association") >= F.lit(least) * F.col("best"))
    return _pruned(strong, floor)


def _looked_up(rows: DataFrame, table: DataFrame, on: list[str], salt_by: list[str]) -> DataFrame:
    return lookup_join(rows, table, on, "inner", max_broadcast_bytes=LINK_BROADCAST_BYTES, salt_by=salt_by)


def _pruned(sums: DataFrame, floor: float) -> DataFrame:
    """(link, prob) from (link, expected, total) without those below ``floor``."""
    entries = sums.select("link", (F.col("expected") / F.col("total")).alias("prob"))
    return stage_table(entries.where(F.round("prob", FLOOR_DIGITS) >= floor), "translation-table")


def _links_left(parts: DataFrame, table: DataFrame, turns: int) -> DataFrame:
    """(row, place, weight, link): the links of ``table`` in all parts, written.

    The links of a turn that are in the table, ``KEPT_LINKS`` at the most, go to the tasks as sorted
    numbers, so that only links that are left go from Python to Spark.
    """
    sizes = table.groupBy((_token() % turns).alias("turn")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.agg(F.max("n").alias("n")).first()["n"] or 0
    turns *= max(1, -(-most // KEPT_LINKS))

    def left(turn: int) -> DataFrame:
        own = table.where(_token() % turns == turn).select("link").toArrow()["link"]
        kept = np.sort(own.to_numpy())
        rows = _of_turn(parts, turn, turns) if len(kept) else parts.limit(0)
        return rows.mapInArrow(partial(_every_link, kept=kept), "row long, place int, weight long, link long")

    return _by_turns(turns, left, "links")


def _patterns(links: DataFrame) -> DataFrame:
    """(row, weight, link): target words with the same links are one row, with the sum of their weights, written.

    Words that differ in nothing but their place get the same shares in every round.
    """
    places = links.groupBy("row", "place").agg(
        F.first("weight").alias("weight"), F.sort_array(F.collect_list("link")).alias("links")
    )
    found = places.groupBy("links").agg(F.sum("weight").alias("weight"))
    numbered = stage_table(found.withColumn("row", F.monotonically_increasing_id()), "link-patterns")
    return numbered.select("row", "weight", F.explode_outer("links").alias("link"))


def _next_table(links: DataFrame, table: DataFrame, floor: float) -> DataFrame:
    """Share every target word out by ``table`` and add the shares up."""
    met = _looked_up(links, table, ["link"], ["row"])
    whole = F.sum("prob").over(Window.partitionBy("row"))
    counts = stage_table(
        met.select("link", (F.col("weight") * F.col("prob") / whole).alias("share"))
        .groupBy("link").agg(F.sum("share").alias("expected")),
        "expected-counts",
    ).withColumn("s", _token())
    totals = counts.groupBy("s").agg(F.sum("expected").alias("total"))
    return _pruned(_looked_up(counts, totals, ["s"], ["link"]), floor)


def _decoded(table: DataFrame, tokens: DataFrame) -> DataFrame:
    """(src, tgt, token, translation, prob) from (link, prob)."""
    named = _looked_up(table.select(_token().alias("id"), _translation().alias("t"), "prob"), tokens, ["id"], ["t"])
    words_of = tokens.select(F.col("id").alias("t"), F.col("token").alias("translation"))
    return _looked_up(named, words_of, ["t"], ["id"]).select(*ENTRY, "prob")


def train_translation_table(
    pairs: DataFrame, rounds: int = ROUNDS, floor: float = FLOOR, max_words: int | None = None,
    least_links: int = LEAST_LINKS, least_association: float = LEAST_ASSOCIATION,
) -> DataFrame:
    """(src, tgt, token, translation, prob) from ``pairs(src, tgt, source, target)``.

    Word translation model without positions: each round shares every target word out over the
    source words of its sentence in proportion to the current table, and adds the shares up. The
    first round starts from equal shares and keeps the translations that meet a token at least
    ``least_links`` times and whose association with it reaches ``least_association`` of the
    strongest one: a word that is met once cannot be told from its neighbours. The table is written
    after each round without the entries below ``floor``. Pairs with a null or wordless side teach
    nothing; an empty table of pairs gives an empty table.

    With ``max_words`` long pairs are cut, see ``aligned_parts``.

    Tokens are numbered first, and a link is one number. Links are made in turns, by the number of their
    token, so that what moves at once is a small multiple of the input; different tokens of a pair are
    linked once, with the number of times they come. The first round sums all links once; the others
    read the links of the first table only, as no entry comes back. Target words with the same links
    are weighed together, and only sums per (token, translation) move: a frequent word is summed in
    every task first.
    """
    if rounds < 1:
        raise ValueError("at least one round")
    spark = pairs.sparkSession
    ship_package(spark)
    before = spark.conf.get(BATCH_CONF)
    try:
        spark.conf.set(BATCH_CONF, BATCH_ROWS)
        parts = aligned_parts(pairs, max_words)
        blocks = _in_blocks(parts)
        tokens = numbered_tokens(parts, blocks)
        encoded = _encoded(parts, tokens, blocks)
        turns, buckets = _turns(encoded)
        table = _candidates(encoded, floor, least_links, least_association, turns, buckets)
        if rounds > 1:
            links = _patterns(_links_left(encoded, table, turns))
        for _ in range(rounds - 1):
            table = _next_table(links, table, floor)
    finally:
        spark.conf.set(BATCH_CONF, before)
    return _decoded(table, tokens)


def best_translations(table: DataFrame) -> DataFrame:
    """(src, tgt, token, translation, prob): the likeliest entry, of those that agree in
    ``TIE_DIGITS`` digits the first by text."""
    order = F.struct((-F.round("prob", TIE_DIGITS)).alias("p"), "translation", "prob")
    return table.groupBy(*LANGS, "token").agg(F.min(order).alias("b")).select(
        *LANGS, "token", F.col("b.translation").alias("translation"), F.col("b.prob").alias("prob")
    )


def train_lexicon(pairs: DataFrame, **options) -> DataFrame:
    """The lexicon of ``LexiconTranslator`` from aligned sentences, see ``train_translation_table``."""
    return stage_table(best_translations(train_translation_table(pairs, **options)), "lexicon")
