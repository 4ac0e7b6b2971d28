"""Text and byte functions."""

from __future__ import annotations

import sys
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .errors import INVALID_ARG, error_if

BLANKS = " \t\n\r\f"


def flatten_newlines(text: Column) -> Column:
    """Every ``\\n`` becomes one space; ``\\r`` stays."""
    return F.translate(text, "\n", " ")


def decode_text(raw: Column) -> tuple[Column, Column]:
    """UTF-8 bytes -> (text, error)."""
    text = F.try_validate_utf8(raw.cast("string"))
    error = error_if(raw.isNotNull() & text.isNull(), INVALID_ARG, "decode", "not valid UTF-8")
    return text, error


def decode_image_bytes(content: Column, base64_encoded: Column) -> tuple[Column, Column]:
    """(bytes, error): base64 is decoded where flagged, other rows pass through.

    A base64 text of impossible shape is an error; blanks and line ends inside it are allowed.
    """
    text = F.regexp_replace(content.cast("string"), f"[{BLANKS}]", "")
    shape = text.rlike("^[A-Za-z0-9+/]*={0,2}$") & (F.length(text) % 4 == 0)
    flagged = F.coalesce(base64_encoded, F.lit(False))
    decoded = F.when(
        flagged, F.when(shape, F.try_to_binary(text, F.lit("base64")))
    ).otherwise(content.cast("binary"))
    error = error_if(
        content.isNotNull() & decoded.isNull(), INVALID_ARG, "base64", "not valid base64"
    )
    return decoded, error


def prompt(template: str, **columns: Column) -> Column:
    """Fill ``{name}`` places of ``template`` with columns."""
    parts, rest = [], template
    while rest:
        head, brace, tail = rest.partition("{")
        if head:
            parts.append(F.lit(head))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        parts.append(columns[name])
    return F.concat(*parts)


# Prompts for captions and retrieval.
CAPTION_PROMPT = "A photo of a {text}."
CONTAINING_PROMPT = "This is a photo containing images of {text}."
CATEGORY_PROMPT = (
    "This is a photo from ImageNet's {label} category. This category contains photos of {text}."
)
QUERY_PROMPT = "query: {text}"
PASSAGE_PROMPT = "passage: {text}"


def label_from_path(path: Column) -> Column:
    """``/a/b/n01_7.JPEG`` -> ``n01``: file name up to its first dot, then first underscore."""
    name = F.substring_index(path, "/", -1)
    return F.substring_index(F.substring_index(name, ".", 1), "_", 1)


# Four-letter codes of the detector's scripts, in tie order, with the Unicode scripts
# of their letters. Han stands for both Chinese scripts.
SCRIPTS = {
    "Latn": "Latin", "Cyrl": "Cyrillic", "Arab": "Arabic", "Hans": "Han", "Hang": "Hangul",
    "Jpan": "Hiragana Katakana", "Deva": "Devanagari", "Grek": "Greek", "Hebr": "Hebrew", "Thai": "Thai",
    "Khmr": "Khmer", "Taml": "Tamil", "Sinh": "Sinhala", "Beng": "Bengali", "Armn": "Armenian",
    "Geor": "Georgian", "Gujr": "Gujarati", "Guru": "Gurmukhi", "Knda": "Kannada", "Laoo": "Lao",
    "Mlym": "Malayalam", "Mymr": "Myanmar", "Orya": "Oriya", "Telu": "Telugu", "Tibt": "Tibetan",
    "Ethi": "Ethiopic", "Tfng": "Tifinagh", "Olck": "Ol_Chiki",
}
SCRIPT_STEP = 1 << 20


@cache
def script_ranges() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first code point, last code point, script number) of all stretches of one script, sorted."""
    import regex

    whole = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    found = [
        (ord(run[0][0]), ord(run[0][-1]), number)
        for number, names in enumerate(SCRIPTS.values())
        for name in names.split()
        for run in regex.finditer(rf"\p{{Script={name}}}+", whole)
    ]
    return tuple(np.array(c, dtype=np.int64) for c in zip(*sorted(found), strict=True))


def _script_finder():
    first, last, number = script_ranges()
    codes = pa.array(list(SCRIPTS))

    @F.arrow_udf("string")
    def find(texts: pa.Array) -> pa.Array:
        names = []
        rows = texts.to_pylist()
        start = 0
        while start < len(rows):
            stop, size = start, 0
            while stop < len(rows) and (stop == start or size + len(rows[stop] or "") <= SCRIPT_STEP):
                size += len(rows[stop] or "")
                stop += 1
            part = [t or "" for t in rows[start:stop]]
            points = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            at = np.searchsorted(first, points, side="right") - 1
            hit = (at >= 0) & (points <= last[at])
            owner = np.repeat(np.arange(len(part)), [len(t) for t in part])[hit]
            counts = np.bincount(owner * len(codes) + number[at[hit]], minlength=len(part) * len(codes))
            counts = counts.reshape(len(part), len(codes))
            best = counts.argmax(axis=1)  # the first of equal counts
            names.append(codes.take(pa.array(best, mask=counts.max(axis=1) == 0)))
            start = stop
        return pa.concat_arrays(names) if names else pa.array([], pa.string())

    return find


def dominant_script(text: Column) -> Column:
    """Script with the most letters; earlier scripts win ties; null without any letter.

    One pass over the text: all characters of a batch are looked up in a sorted table of ranges.
    """
    return _script_finder()(text)


def explode_each(df, keys: list, values: Column, name: str):
    """Rows (keys, ``name``), one per array element; rows without elements go.

    For arrays that are costly to make: a plain ``explode`` lets the optimizer derive a filter on
    the array, which makes it two more times, and on the far side of a repartition.
    """
    return df.select(*keys, F.explode_outer(values).alias(name)).filter(F.col(name).isNotNull())


def words(text: Column) -> Column:
    """Blank-separated words; an empty or blank text has none."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"[{BLANKS}]+")
    )
