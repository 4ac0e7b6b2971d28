"""Vector arithmetic on array columns, in doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAD_ID = 1


def _doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def inner_product(a: Column, b: Column) -> Column:
    products = F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(_doubles(vec), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Null when either vector is zero."""
    return F.try_divide(inner_product(a, b), norm(a) * norm(b))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(1.0) - cosine(a, b), F.lit(0.0))


def l2_normalize(vec: Column) -> Column:
    # The length is repeated, not put into the lambda, which would compute it per element.
    lengths = F.array_repeat(F.greatest(norm(vec), F.lit(1e-12)), F.size(vec))
    return F.zip_with(_doubles(vec), lengths, lambda x, length: x / length)


def pad_ids(ids: Column, max_len: int, pad: int = PAD_ID) -> Column:
    """Pad with ``pad`` up to ``max_len``; longer lists stay whole (a length error, not a cut)."""
    missing = F.greatest(F.lit(max_len) - F.size(ids), F.lit(0))
    return F.concat(ids, F.array_repeat(F.lit(pad).cast("bigint"), missing))


def attention_mask(ids: Column, pad: int = PAD_ID) -> Column:
    return F.transform(ids, lambda x: (x != pad).cast("int"))
