"""Pixel arithmetic.

The column functions stay in the JVM. The numpy helpers work on one decoded
image (height x width x channel) and are called from batch functions inside
tasks.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from patchloom.functions.keys import _column

# Per-channel mean and standard deviation (red, green, blue) of
# pixels scaled to 0..1.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)

# Random resized crops cover this share of the image area, with
# width / height between these bounds, and give up after this many draws.
CROP_AREA = (0.08, 1.0)
CROP_RATIO = (3.0 / 4.0, 4.0 / 3.0)
CROP_DRAWS = 10


def scale_to_unit(pixels: str | Column) -> Column:
    """0..255 to 0..1."""
    return F.transform(_column(pixels), lambda x: x / F.lit(255.0))


def normalize_channels(
    pixels: str | Column, mean: tuple = CHANNEL_MEAN, std: tuple = CHANNEL_STD, plane: int | None = None
) -> Column:
    """Per-channel ``(x - mean) / std`` of a flat pixel array.

    Channels are interleaved; ``plane`` gives the pixels per channel when the
    array holds one whole channel after another.
    """
    means = F.array(*[F.lit(float(m)) for m in mean])
    stds = F.array(*[F.lit(float(s)) for s in std])

    def one(x: Column, i: Column) -> Column:
        channel = i % len(mean) if plane is None else F.floor(i / plane).cast("int")
        return (x - F.get(means, channel)) / F.get(stds, channel)

    return F.transform(_column(pixels), one)


def bytes_to_array(pixels: str | Column) -> Column:
    """Binary to ``array<int>`` of its byte values."""
    data = _column(pixels)
    places = F.sequence(F.lit(1), F.octet_length(data))
    values = F.transform(places, lambda i: F.conv(F.hex(F.substring(data, i, F.lit(1))), 16, 10).cast("int"))
    return F.when(F.octet_length(data) > 0, values).otherwise(F.array().cast("array<int>"))


def array_to_bytes(values: str | Column) -> Column:
    """``array<int>`` of byte values to binary."""
    return F.unhex(F.array_join(F.transform(_column(values), lambda v: F.lpad(F.hex(v), 2, "0")), ""))


# Weights of so many numbers are kept for the next image of the same size.
KEPT_TAPS = 1 << 16


def _taps(n_in: int, n_out: int) -> np.ndarray:
    """Weights (n_out x n_in) of a triangle filter, widened when shrinking."""
    return _kept_taps(n_in, n_out) if n_in * n_out <= KEPT_TAPS else _new_taps(n_in, n_out)


def _new_taps(n_in: int, n_out: int) -> np.ndarray:
    scale = n_in / n_out
    support = max(scale, 1.0)
    centres = (np.arange(n_out) + 0.5) * scale
    distance = np.abs(np.arange(n_in)[None, :] + 0.5 - centres[:, None]) / support
    weights = np.clip(1.0 - distance, 0.0, None)
    return weights / weights.sum(axis=1, keepdims=True)


@lru_cache(maxsize=64)
def _kept_taps(n_in: int, n_out: int) -> np.ndarray:
    taps = _new_taps(n_in, n_out)
    taps.setflags(write=False)
    return taps


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize with the filter widened when shrinking; float64 result.

    Values are not rounded to whole numbers between the two passes, so results
    can differ by up to one grey level from libraries that do.
    """
    rows, columns = _taps(image.shape[0], height), _taps(image.shape[1], width)
    tall = np.tensordot(rows, image.astype(np.float64), axes=(1, 0))
    return np.tensordot(columns, tall, axes=(1, 1)).transpose(1, 0, 2)


def resize_short_side(image: np.ndarray, size: int) -> np.ndarray:
    """Scale so that the shorter side is ``size``; the longer side is truncated."""
    height, width = image.shape[:2]
    if height <= width:
        return resize(image, size, int(size * width / height))
    return resize(image, int(size * height / width), size)


def center_crop(image: np.ndarray, size: int) -> np.ndarray:
    """Middle square; a smaller image is padded with zeros first."""
    pad_h, pad_w = max(size - image.shape[0], 0), max(size - image.shape[1], 0)
    if pad_h or pad_w:
        image = np.pad(
            image, ((pad_h // 2, pad_h - pad_h // 2), (pad_w // 2, pad_w - pad_w // 2), (0, 0))
        )
    top = int(round((image.shape[0] - size) / 2.0))
    left = int(round((image.shape[1] - size) / 2.0))
    return image[top : top + size, left : left + size]


def random_resized_crop(image: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """A random box of random area and shape, resized to a square."""
    height, width = image.shape[:2]
    for _ in range(CROP_DRAWS):
        area = height * width * rng.uniform(*CROP_AREA)
        ratio = np.exp(rng.uniform(*np.log(CROP_RATIO)))
        w, h = int(round(np.sqrt(area * ratio))), int(round(np.sqrt(area / ratio)))
        if 0 < w <= width and 0 < h <= height:
            top, left = rng.integers(0, height - h + 1), rng.integers(0, width - w + 1)
            return resize(image[top : top + h, left : left + w], size, size)
    # No draw fitted: the largest middle box within the shape bounds.
    w = int(round(min(width, height * CROP_RATIO[1])))
    h = int(round(min(height, width / CROP_RATIO[0])))
    top, left = (height - h) // 2, (width - w) // 2
    return resize(image[top : top + h, left : left + w], size, size)


def random_flip(image: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Mirror left to right, half of the time."""
    return image[:, ::-1] if rng.random() < 0.5 else image


def to_planes(image: np.ndarray) -> np.ndarray:
    """0..255, channel last, to 0..1, channel first."""
    return image.transpose(2, 0, 1) / 255.0


def normalize_planes(planes: np.ndarray, mean: tuple = CHANNEL_MEAN, std: tuple = CHANNEL_STD) -> np.ndarray:
    return (planes - np.reshape(mean, (-1, 1, 1))) / np.reshape(std, (-1, 1, 1))
