"""The plug-in point for real models: load once per Python worker, run on bounded batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lingofold.functions.errors import ERROR_TYPE, INTERNAL, INVALID_ARG, error_if, first_error
from lingofold.session import ship_package

# Rows per model call of each service.
BATCH_SIZES = {
    "translate": 4,
    "sentencex": 50,
    "fasttext_language_identification": 50,
    "embed_text": 60,
    "embed_image": 60,
    "multilingual_e5_large": 24,
    "siglip_text": 32,
    "siglip_vision": 32,
    "seamlessm4t_text2text": 36,
}

#: Rows whose inputs and results a worker holds as Python objects, whatever the size of an Arrow batch.
HELD_ROWS = 480

#: Models that a worker keeps; the one that was used longest ago goes first.
KEPT_MODELS = 4

_loaded: dict[str, Callable] = {}


def _load_once(token: str, make_fn: Callable) -> Callable:
    found = _loaded.pop(token, None) or make_fn()
    while len(_loaded) >= KEPT_MODELS:
        del _loaded[next(iter(_loaded))]
    _loaded[token] = found
    return found


def _call(fn: Callable, rows: list[dict], stage: str) -> list[tuple[object, dict | None]]:
    """Results and errors of a batch; a failing batch is repeated row by row.

    The message names the kind of failure only, so it cannot carry text of another row. A missing
    module is a fault of the cluster and not of a row: it fails the job.
    """
    try:
        results = fn(rows)
        if len(results) != len(rows):
            raise ValueError("one result per row is required")
        return [(r, None) for r in results]
    except ImportError:
        raise
    except Exception as exc:
        if len(rows) == 1:
            error = {"code": INTERNAL, "stage": stage, "message": f"{type(exc).__name__} in model"}
            return [(None, error)]
        return [pair for row in rows for pair in _call(fn, [row], stage)]


def predict_batches(
    df: DataFrame,
    inputs: list[str],
    make_fn: Callable[[], Callable[[list[dict]], list]],
    output: str,
    output_type: str,
    batch_size: int,
    stage: str = "model",
    model: tuple[str, str] | None = None,
) -> DataFrame:
    """Add ``output`` and ``error``: one result per row from ``fn = make_fn()``.

    ``model`` is the caller's name and version. Workers keep the last ``KEPT_MODELS`` models by it,
    so jobs of the same name and version, such as the micro-batches of a stream, load once per
    worker; without it a model lives as long as the job. ``fn`` gets at most ``batch_size`` rows as dictionaries of ``inputs`` and returns a list of
    the same length. Rows that already have an ``error``, or a null input, are not passed on.
    """
    ship_package(df.sparkSession)
    keep = [c for c in df.columns if c not in (output, "error")]
    had_error = "error" in df.columns
    rows = df.select(*keep, *(["error"] if had_error else []))
    value_type = T._parse_datatype_string(output_type)
    error_type = T._parse_datatype_string(ERROR_TYPE)
    schema = T.StructType(
        [rows.schema[c] for c in keep]
        + [T.StructField(output, value_type), T.StructField("error", error_type)]
    )
    arrow_value, arrow_error = to_arrow_type(value_type), to_arrow_type(error_type)
    token = "\n".join(model) if model else uuid.uuid4().hex

    held = batch_size * max(1, HELD_ROWS // batch_size)

    def run(batches):
        fn = None
        for batch in (b.slice(at, held) for b in batches for at in range(0, max(b.num_rows, 1), held)):
            columns = {c: batch.column(c) for c in keep}
            given = list(zip(*[columns[c].to_pylist() for c in inputs])) if batch.num_rows else []
            errors = batch.column("error").to_pylist() if had_error else [None] * batch.num_rows
            values = [None] * batch.num_rows
            todo = [
                i for i in range(batch.num_rows)
                if errors[i] is None and all(v is not None for v in given[i])
            ]
            for start in range(0, len(todo), batch_size):
                part = todo[start : start + batch_size]
                fn = fn or _load_once(token, make_fn)
                answers = _call(fn, [dict(zip(inputs, given[i])) for i in part], stage)
                for i, (value, error) in zip(part, answers):
                    values[i], errors[i] = value, error
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(values, arrow_value), pa.array(errors, arrow_error)],
                names=[*keep, output, "error"],
            )

    return rows.mapInArrow(run, schema)


def dispatch_batches(
    df: DataFrame,
    inputs: list[str],
    model_col: str,
    registry: dict[str, Callable[[], Callable[[list[dict]], list]]],
    output: str,
    output_type: str,
    batch_size: int,
    stage: str = "model",
    version: str | None = None,
) -> DataFrame:
    """``predict_batches`` with the model that each row names, in one pass over the rows.

    Every batch is split by ``model_col`` and put together again. Models are loaded when a row first
    asks for them. A row that names no model of ``registry`` is an error. ``version`` keeps the
    loaded models across jobs.
    """
    known = error_if(
        ~F.coalesce(F.col(model_col).isin(*registry), F.lit(False)), INVALID_ARG, stage,
        F.concat(F.lit("unknown model "), F.coalesce(F.col(model_col), F.lit("null"))),
    )
    earlier = [F.col("error")] if "error" in df.columns else []
    rows = df.withColumn("error", first_error(*earlier, known))

    def make() -> Callable:
        loaded: dict[str, Callable] = {}

        def run(batch: list[dict]) -> list:
            out: list = [None] * len(batch)
            for name in dict.fromkeys(row[model_col] for row in batch):
                own = [i for i, row in enumerate(batch) if row[model_col] == name]
                if name not in loaded:
                    loaded[name] = registry[name]()
                for i, result in zip(own, loaded[name]([batch[i] for i in own]), strict=True):
                    out[i] = result
            return out

        return run

    name = ("dispatch:" + ",".join(sorted(registry)), version) if version else None
    return predict_batches(rows, [*inputs, model_col], make, output, output_type, batch_size, stage, name)
