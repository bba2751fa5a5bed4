"""Perceptual fingerprints of image files.

Spark's image source decodes on the executors; a Lanczos reduction to 9 x 8 and 8 x 8
grey values gives the hashes. Decoders and reductions differ between libraries in the
last grey level, so hashes agree with others' up to single bits.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.sources.files import images, plain_uri


def reduced(grey: np.ndarray, width: int, height: int, lobes: int = 3) -> np.ndarray:
    """``grey`` resized with a Lanczos kernel (a triangle with ``lobes`` 1) that is widened when shrinking."""

    def weights(old: int, new: int) -> np.ndarray:
        scale = old / new
        reach = max(1.0, scale)
        centre = (np.arange(new) + 0.5) * scale
        x = (np.arange(old)[None, :] + 0.5 - centre[:, None]) / reach
        w = np.where(np.abs(x) < lobes, np.sinc(x) * np.sinc(x / lobes), 0.0) if lobes > 1 else np.maximum(0.0, 1 - np.abs(x))
        return w / w.sum(axis=1, keepdims=True)

    return np.clip(np.rint(weights(grey.shape[0], height) @ grey @ weights(grey.shape[1], width).T), 0, 255)


def hashes(grey: np.ndarray) -> tuple[int, int, float, float]:
    """(dhash, ahash, mean luma, deviation of luma); hashes as signed 64-bit numbers."""
    d, a, s = reduced(grey, 9, 8), reduced(grey, 8, 8), reduced(grey, 64, 64, 1)
    bits = lambda b: int(np.packbits(b.ravel()).view(">u8")[0].astype(np.uint64).view(np.int64))
    return bits(d[:, :-1] < d[:, 1:]), bits(a >= a.mean()), float(s.mean()), float(s.std())


def grey_of(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Grey values of blue-green-red bytes."""
    x = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels).astype(np.float64)
    return x[:, :, 0] if channels == 1 else np.rint(x[:, :, 2] * 0.299 + x[:, :, 1] * 0.587 + x[:, :, 0] * 0.114)


def fingerprints(spark: SparkSession, root: str, splits: Sequence[str]) -> DataFrame:
    """Rows (split, path, dhash, ahash, width, height, mean_luma, luma_stddev, error); error instead of values if it cannot be decoded."""
    read = spark.read.format("image").option("recursiveFileLookup", True).load(f"{root}/images")
    listed = images(spark, root, splits).select("split", F.col("path").alias("origin"), F.concat_ws("/", F.lit("images"), "split", "relative").alias("path"))
    joined = listed.join(read.select(plain_uri(F.col("image.origin")).alias("origin"), "image.width", "image.height", "image.nChannels", "image.data"), "origin").drop("origin")

    def run(parts):
        for p in parts:
            rows = []
            for r in p.itertuples(index=False):
                if r.width <= 0:
                    rows.append((r.split, r.path, None, None, None, None, None, None, "cannot be decoded"))
                    continue
                d, a, mean, deviation = hashes(grey_of(r.data, r.height, r.width, r.nChannels))
                rows.append((r.split, r.path, d, a, r.width, r.height, mean, deviation, None))
            frame = pd.DataFrame(rows, columns=["split", "path", "dhash", "ahash", "width", "height", "mean_luma", "luma_stddev", "error"])
            yield frame.astype({c: "Int64" for c in ("dhash", "ahash")} | {c: "Int32" for c in ("width", "height")})

    return joined.mapInPandas(run, "split string, path string, dhash long, ahash long, width int, height int, mean_luma double, luma_stddev double, error string")
