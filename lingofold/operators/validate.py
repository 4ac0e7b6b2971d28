"""Row checks. Each returns an error column; nothing here drops or fails a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingofold.functions.codes import lang_token
from lingofold.functions.errors import INVALID_ARG, error_if, first_error
from lingofold.functions.vectors import PAD_ID

REQUIRED_PREFIXES = ("query: ", "passage: ")


def require(*names: str) -> Column:
    """Error for the first of the columns that is null."""
    return first_error(
        *[error_if(F.col(n).isNull(), INVALID_ARG, "input", f"missing {n}") for n in names]
    )


def require_model(name: Column, registry: list[str] | tuple[str, ...]) -> Column:
    known = ", ".join(sorted(registry))
    message = F.concat(
        F.lit("unknown model "), F.coalesce(name, F.lit("null")), F.lit(f", known: {known}")
    )
    bad = F.coalesce(~name.isin(*registry), F.lit(True))
    return error_if(bad, INVALID_ARG, "model", message)


def require_language(
    df: DataFrame, supported: DataFrame, src_col: str = "src", tgt_col: str = "tgt"
) -> DataFrame:
    """Add ``language_error``: source first, then target, both compared as language tokens.

    ``supported(lang)`` is a list of language codes, bounded by the registered ones; its sorted
    form goes into the message.
    """
    codes = supported.select(lang_token(F.col("lang")).alias("__token")).distinct()
    listing = codes.agg(F.array_join(F.array_sort(F.collect_list("__token")), ", ").alias("__all"))
    allowed = listing.first()["__all"]
    checked = df
    for column, flag in ((src_col, "__src_ok"), (tgt_col, "__tgt_ok")):
        side = codes.select(F.col("__token").alias(f"{flag}_token"), F.lit(True).alias(flag))
        checked = checked.join(
            F.broadcast(side), lang_token(F.col(column)) == F.col(f"{flag}_token"), "left"
        )

    def complaint(kind: str, column: str, flag: str) -> Column:
        message = F.concat(
            F.lit(f"unsupported {kind} language "),
            F.coalesce(F.col(column), F.lit("null")),
            F.lit(f", allowed: {allowed}"),
        )
        return error_if(F.col(flag).isNull(), INVALID_ARG, "language", message)

    error = first_error(
        complaint("source", src_col, "__src_ok"), complaint("target", tgt_col, "__tgt_ok")
    )
    return checked.withColumn("language_error", error).drop(
        "__src_ok", "__src_ok_token", "__tgt_ok", "__tgt_ok_token"
    )


def max_tokens(n_tokens: Column, limit: int) -> Column:
    """Too many tokens is an error, never a cut."""
    message = F.concat(
        F.lit("text has "), n_tokens.cast("string"), F.lit(f" tokens, the maximum is {limit}")
    )
    return error_if(n_tokens > limit, INVALID_ARG, "tokens", message)


def require_prefix(text: Column, prefixes: tuple[str, ...] = REQUIRED_PREFIXES) -> Column:
    fits = F.lit(False)
    for prefix in prefixes:
        fits = fits | text.startswith(prefix)
    wanted = " or ".join(f"'{p}'" for p in prefixes)
    return error_if(~fits, INVALID_ARG, "prefix", f"text must start with {wanted}")


def require_some_token(ids: Column, pad: int = PAD_ID) -> Column:
    """A row of padding only has no mean."""
    return error_if(
        ~F.exists(ids, lambda x: x != pad), INVALID_ARG, "tokens", "no token besides padding"
    )
