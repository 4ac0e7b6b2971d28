"""Row errors as data: a nullable struct that travels with the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ERROR_TYPE = "struct<code:string,stage:string,message:string>"

INVALID_ARG = "INVALID_ARG"
INTERNAL = "INTERNAL"


def make_error(code: str, stage: str, message) -> Column:
    text = message if isinstance(message, Column) else F.lit(message)
    return F.struct(
        F.lit(code).alias("code"), F.lit(stage).alias("stage"), text.alias("message")
    ).cast(ERROR_TYPE)


def no_error() -> Column:
    return F.lit(None).cast(ERROR_TYPE)


def error_if(condition: Column, code: str, stage: str, message) -> Column:
    """The error where ``condition`` holds (null counts as not holding), else null."""
    return F.when(F.coalesce(condition, F.lit(False)), make_error(code, stage, message)).otherwise(
        no_error()
    )


def first_error(*errors: Column) -> Column:
    """The first error recorded for the row, in stage order."""
    return F.coalesce(*errors) if len(errors) > 1 else errors[0]
