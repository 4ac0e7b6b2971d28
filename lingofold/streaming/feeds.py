"""Request feeds, jobs per micro-batch, the ok/error sink and the latency windows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from lingofold.functions.errors import INVALID_ARG, make_error
from lingofold.sources.requests import request_schema, split_results, unpack_requests


NO_TIME = np.iinfo(np.int64).min
#: Groups of request ids that are looked up together; a checkpoint keeps to its number.
GUARD_GROUPS = 1_024
KEY = "__request_key"
#: What a group remembers of each id that has passed: its time, and when to look at it again.
HELD = pa.schema([("key", pa.string()), ("at", pa.int64()), ("due", pa.int64())])
IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"


def stream_requests(
    spark: SparkSession,
    path: str,
    fields: dict[str, str],
    max_files_per_trigger: int = 100,
    multi_line: bool = True,
) -> DataFrame:
    """Request files as they arrive, one row per request, keyed by ``(file, request_id)``."""
    raw = (
        spark.readStream.schema(request_schema(fields))
        .option("multiLine", multi_line)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(path)
        .select("data", F.col("_metadata.file_path").alias("file"))
    )
    return unpack_requests(raw, fields)


def stream_table(
    spark: SparkSession,
    path: str,
    schema,
    max_files_per_trigger: int = 100,
    pattern: str = "*.parquet",
) -> DataFrame:
    """A growing folder of parquet files as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("pathGlobFilter", pattern)
        .parquet(path)
    )


def _request_key(fields: list[T.StructField], key_cols: list[str]) -> Column:
    """The key columns as one text: equal texts for equal keys, nulls included."""
    types = {f.name: f.dataType for f in fields}

    def text(name: str) -> Column:
        column, kind = F.col(f"`{name}`"), types[name]
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return (column + F.lit(0).cast(kind)).cast("string")  # one zero
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(column).cast("string")
        if isinstance(kind, T.BinaryType):
            return F.hex(column)
        return (column if isinstance(kind, T.AtomicType) else F.to_json(F.struct(column))).cast("string")

    return F.to_json(F.array(*[text(name) for name in key_cols]))


def _guard(fields: list[T.StructField], time_col: str, keep_ms: int):
    """State function of a group of request ids: the first row in time of an id passes, later copies do
    not. The state holds the ids that have passed, their times and when to look at each of them again."""
    names = [f.name for f in fields]

    def kept(held: pa.Table, state) -> pa.Table:
        """``held`` without the ids whose time to look again is up and that the watermark has left behind."""
        now, due = state.getCurrentProcessingTimeMs(), held["due"].to_numpy()
        up = due <= now
        gone = up & (held["at"].to_numpy() + keep_ms < state.getCurrentWatermarkMs())
        held = held.set_column(2, "due", pa.array(np.where(up, now + max(keep_ms, 1), due)))
        return held.filter(pa.array(~gone)) if gone.any() else held

    def keep(held: pa.Table, state) -> None:
        if not len(held):
            if state.exists:
                state.remove()
            return
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, held.schema) as writer:
            writer.write_table(held)
        state.update((out.getvalue().to_pybytes(),))
        state.setTimeoutDuration(max(keep_ms, 1))

    def run(group, frames, state):
        rows = [frame for frame in frames if len(frame)]
        held = HELD.empty_table()
        if state.exists:
            held = pa.ipc.open_stream(pa.py_buffer(bytes(state.get[0]))).read_all()
        if not rows:  # the time to look again is up
            if state.hasTimedOut and state.exists:
                keep(kept(held, state), state)
            return
        watermark, now = state.getCurrentWatermarkMs(), state.getCurrentProcessingTimeMs()
        keys = np.concatenate([frame[KEY].to_numpy(dtype=object) for frame in rows])
        at = np.concatenate([  # no time: the least number
            frame[time_col].to_numpy().astype("datetime64[ms]").astype("int64") for frame in rows
        ])
        late = (at < watermark) | (at == NO_TIME)
        codes, ids = pd.factorize(keys)
        # of each id the earliest row on time, else the first late one
        order = np.lexsort((np.where(late, 0, at), late, codes))
        first = order[np.concatenate([[True], np.diff(codes[order]) != 0])]
        known = pc.is_in(pa.array(ids, pa.string()), held["key"].combine_chunks())
        first = first[~known.to_numpy(zero_copy_only=False)]  # the others are copies of a request that has passed
        passed = first[~late[first]]
        added = pa.table([keys[passed], at[passed], np.full(len(passed), now + max(keep_ms, 1))], schema=HELD)
        keep(kept(pa.concat_tables([held, added]), state), state)
        first, begin = np.sort(first), 0
        for frame in rows:
            own = first[(first >= begin) & (first < begin + len(frame))]
            if len(own):
                yield frame[names].iloc[own - begin].assign(late=late[own])
            begin += len(frame)

    return run


def guard_requests(
    stream: DataFrame, key_cols: list[str], time_col: str, delay: str = "10 minutes", delay_ms: int | None = None
) -> DataFrame:
    """``stream`` with every request once and an ``error``: null, or that the request came too late.

    A request whose time lies behind the watermark (the latest time of earlier micro-batches less
    ``delay``) is an error row. A copy of a request that has passed, on time or late, is dropped while
    its key is remembered: until the watermark is ``delay`` past it. Of copies in one micro-batch the
    earliest passes. Rows with a null key share one; a null time is refused beforehand as an error.
    The keys live in Spark's state store, ``GUARD_GROUPS`` groups of them by their hash, so they survive
    a restart from the same checkpoint, and a group's requests are looked up together.
    """
    if delay_ms is None:
        found = stream.sparkSession.sql(
            f"select cast(unix_millis(timestamp_millis(0) + interval {delay}) as bigint) as ms"
        ).first()
        delay_ms = found["ms"]
    fields = list(stream.schema.fields)
    out = T.StructType([*fields, T.StructField("late", T.BooleanType())])
    no_time = stream.where(F.col(time_col).isNull()).withColumn("late", F.lit(None).cast("boolean"))
    guarded = (
        stream.where(F.col(time_col).isNotNull())
        .withWatermark(time_col, delay)
        .withColumn(KEY, _request_key(fields, key_cols))
        .withColumn("__group", F.pmod(F.xxhash64(KEY), F.lit(GUARD_GROUPS)))
        .groupBy("__group")
        .applyInPandasWithState(
            _guard(fields, time_col, delay_ms), out, T._parse_datatype_string("held binary"), "append",
            GroupStateTimeout.ProcessingTimeTimeout,
        )
    )
    error = F.when(
        F.col("late").isNull(), make_error(INVALID_ARG, "time", F.lit("missing time"))
    ).when(F.col("late"), make_error(INVALID_ARG, "time", F.lit("the request came after the watermark")))
    return guarded.unionByName(no_time).withColumn("error", error).drop("late")


def split_sink(ok_path: str, err_path: str) -> Callable[[DataFrame, int], None]:
    """Writer of one micro-batch into two tables, each row into exactly one.

    The target folder carries the batch id and is overwritten, so a repeated batch replaces
    itself instead of adding rows twice.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        kept = rows.persist()
        ok, err = split_results(kept)
        ok.write.mode("overwrite").parquet(f"{ok_path}/batch={batch_id}")
        err.write.mode("overwrite").parquet(f"{err_path}/batch={batch_id}")
        kept.unpersist()

    return write


def stream_job(
    stream: DataFrame,
    job: Callable[[DataFrame], DataFrame],
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = True,
    interval: str = "10 seconds",
    idle_batches: bool = True,
) -> StreamingQuery:
    """Run a batch job on every micro-batch and hand the rows to ``sink``.

    Requests are independent, so the regrouping of sentences stays inside a micro-batch and
    needs no streaming state. State that ends by the clock (``guard_requests``) always asks for
    another batch: without ``idle_batches`` there are none without data, so the query can end.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        sink(job(batch), batch_id)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    conf = stream.sparkSession.conf
    before = conf.get(IDLE)
    conf.set(IDLE, str(idle_batches).lower())
    try:
        return writer.trigger(**trigger).start()  # the query takes a copy of the settings
    finally:
        conf.set(IDLE, before)


def stream_latency(
    log: DataFrame,
    keys: list[str],
    latency_col: str,
    time_col: str,
    window: str = "20 seconds",
    watermark: str = "1 minute",
    probs: tuple[float, ...] = (0.5, 0.9, 0.95, 0.99),
    accuracy: int = 10_000,
) -> DataFrame:
    """Windowed load report; the same call gives the batch twin on a static table.

    Percentiles come from mergeable sketches of bounded size, so the state stays small.
    """
    timed = log.withWatermark(time_col, watermark) if log.isStreaming else log
    ranks = F.percentile_approx(latency_col, [float(p) for p in probs], accuracy)
    grouped = timed.groupBy(F.window(time_col, window), *keys).agg(
        F.count(latency_col).alias("n"),
        F.avg(latency_col).alias("mean"),
        F.max(latency_col).alias("max"),
        ranks.alias("ranks"),
    )
    return grouped.select(
        F.col("window.start").alias("window_start"),
        *keys, "n", "mean", "max",
        *[F.get("ranks", F.lit(i)).alias(f"p{p * 100:g}") for i, p in enumerate(probs)],
    )


def write_windows(report: DataFrame, path: str, checkpoint: str, available_now: bool = True, interval: str = "10 seconds") -> StreamingQuery:
    """Keep the table ``path`` at the windows of ``stream_latency``: all of them after each micro-batch."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(path)

    writer = report.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
