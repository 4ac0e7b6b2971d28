"""Image features. A grid of mean colours stands in for a vision model."""

from __future__ import annotations

import io
import struct
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingofold.functions.errors import INVALID_ARG, error_if, first_error
from lingofold.functions.text import decode_image_bytes, label_from_path

from . import validate
from .inference import BATCH_SIZES, predict_batches

# 1,152 dimensions; the stand-in fills them with 3 colours x 16 rows x 24 columns.
IMAGE_DIMS = 1152
GRID_ROWS, GRID_COLS = 16, 24
IMAGE_MODELS = ("siglip_vision",)


def grid_features(pixels: np.ndarray) -> list[float]:
    """Mean colour per grid place of an RGB array (height, width, 3), scaled to -1..1."""
    height, width, _ = pixels.shape
    rows = np.minimum(np.arange(GRID_ROWS + 1) * height // GRID_ROWS, height)
    cols = np.minimum(np.arange(GRID_COLS + 1) * width // GRID_COLS, width)
    out = np.empty((3, GRID_ROWS, GRID_COLS), np.float32)
    for r in range(GRID_ROWS):
        for c in range(GRID_COLS):
            top, left = min(rows[r], height - 1), min(cols[c], width - 1)
            cell = pixels[top : max(rows[r + 1], top + 1), left : max(cols[c + 1], left + 1)]
            out[:, r, c] = cell.reshape(-1, 3).mean(axis=0) / 127.5 - 1.0
    return out.ravel().tolist()


def _from_spark_image() -> Callable:
    def run(rows: list[dict]) -> list:
        vectors = []
        for row in rows:
            shape = (row["height"], row["width"], row["channels"])
            pixels = np.frombuffer(row["data"], np.uint8).reshape(shape)
            if shape[2] == 1:
                pixels = np.repeat(pixels, 3, axis=2)
            vectors.append(grid_features(pixels[:, :, 2::-1]))
        return vectors

    return run


def pillow_decoder(content: bytes) -> np.ndarray:
    """Bytes -> RGB array, where Pillow is installed."""
    from PIL import Image

    return np.asarray(Image.open(io.BytesIO(content)).convert("RGB"))


def bitmap_decoder(content: bytes) -> np.ndarray:
    """Uncompressed 24-bit or 32-bit bitmap (BMP) -> RGB array, without any library."""
    if content[:2] != b"BM" or len(content) < 54:
        raise ValueError("no bitmap")
    start, _, width, height, _, bits, packing = struct.unpack("<IIiiHHI", content[10:34])
    if bits not in (24, 32) or packing != 0 or width <= 0 or height == 0:
        raise ValueError("not an uncompressed bitmap of three colours")
    line = (width * bits // 8 + 3) // 4 * 4
    if start + line * abs(height) > len(content):
        raise ValueError("bitmap is cut off")
    rows = np.frombuffer(content, np.uint8, line * abs(height), start).reshape(abs(height), line)
    pixels = rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)[:, :, 2::-1]
    return pixels[::-1] if height > 0 else pixels  # rows are stored from the bottom up


def bitmap(pixels: np.ndarray) -> bytes:
    """RGB array (height, width, 3) of bytes -> 24-bit bitmap file."""
    height, width, _ = pixels.shape
    line = np.zeros((height, (width * 3 + 3) // 4 * 4), np.uint8)
    line[:, : width * 3] = pixels[::-1, :, ::-1].reshape(height, width * 3)
    body = line.tobytes()
    head = struct.pack("<IHHI", 54 + len(body), 0, 0, 54)
    return b"BM" + head + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, len(body), 0, 0, 0, 0) + body


def embed_image_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, label, embedding, error) of the image files below ``path``, decoded by Spark.

    A file that is no image is a row error.
    """
    images = (
        spark.read.format("image").option("recursiveFileLookup", True).load(path)
        .select("image.*")
        .select(
            F.col("origin").alias("path"),
            label_from_path(F.col("origin")).alias("label"),
            "height", "width", F.col("nChannels").alias("channels"), "data",
            error_if(F.col("height") <= 0, INVALID_ARG, "image", "not an image").alias("error"),
        )
    )
    return predict_batches(
        images, ["height", "width", "channels", "data"], _from_spark_image, "embedding",
        "array<float>", BATCH_SIZES["siglip_vision"], "image",
    ).select("path", "label", "embedding", "error")


def embed_images(
    df: DataFrame,
    decoder: Callable[[bytes], np.ndarray] = pillow_decoder,
    content_col: str = "content",
    encode: Callable[[np.ndarray], list[float]] = grid_features,
) -> DataFrame:
    """Add (embedding, error) to rows with image bytes or base64 text.

    Uses the columns ``base64_encoded`` and ``embed_model`` (see ``with_options``). ``decoder``
    turns bytes into an RGB array, ``encode`` that into the vector; one bad image costs one row.
    """
    content, bad_base64 = decode_image_bytes(F.col(content_col), F.col("base64_encoded"))
    earlier = [F.col("error")] if "error" in df.columns else []
    rows = df.withColumn("__bytes", content).withColumn(
        "error",
        first_error(
            *earlier,
            validate.require(content_col),
            validate.require_model(F.col("embed_model"), IMAGE_MODELS),
            bad_base64,
        ),
    )

    def load() -> Callable:
        return lambda batch: [encode(decoder(bytes(r["__bytes"]))) for r in batch]

    return predict_batches(
        rows, ["__bytes"], load, "embedding", "array<float>", BATCH_SIZES["embed_image"], "image"
    ).drop("__bytes")
