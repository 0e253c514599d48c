"""Frames of clips: image folders, shards, video files and tensor archives, as rows; small images as arrays."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Side of a fingerprint's image, and of a collage in images.
SIDE, COLLAGE = 16, 4


def image_sequences(spark: SparkSession, folder: str, pattern: str = "*.{png,jpg,jpeg,bmp}") -> DataFrame:
    """clip, path, n, place (from 0 by name): the images of each folder below ``folder``, without their bytes."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder).select("path")
    from pyspark.sql import Window

    clip = F.element_at(F.split("path", "/"), -2)
    w = Window.partitionBy("clip")
    return rows.withColumn("clip", clip).withColumn("place", F.row_number().over(w.orderBy("path")) - 1).withColumn("n", F.count("*").over(w))


def stored_frames(records: DataFrame, shards: DataFrame, files: DataFrame, key: Column, storage: Column) -> DataFrame:
    """``records`` with data: from ``shards`` (key, data) where storage is ``wds``, else from ``files`` (key, data); null where neither has the key.

    Both sides must have unique keys.
    """
    marked = records.withColumn("_key", key).withColumn("_wds", F.coalesce(storage == "wds", F.lit(False)))
    a, b = (df.select(F.col("key").alias("_key"), "data") for df in (shards, files))
    return marked.filter("_wds").join(a, "_key", "left").unionByName(marked.filter(~F.col("_wds")).join(b, "_key", "left")).drop("_key", "_wds")


def decoded(rows: DataFrame, path: str, frames: str) -> DataFrame:
    """place, data (raw bytes), height, width of the ``frames`` (an array of places) of each video file; a frame that doesn't decode repeats the last one that did.

    Needs a video library (cv2) on the executors, and raises without one; a file of which no frame decodes raises too.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import cv2

        for b in batches:
            for name, places in zip(b[path], b[frames], strict=True):
                video, found, out, last = cv2.VideoCapture(name), {}, [], None
                for i in range(max(places) + 1):
                    ok, image = video.read()
                    if not ok:
                        break
                    if i in set(places):
                        found[i] = image[:, :, ::-1]
                video.release()
                for i in places:
                    last = found.get(i, last)
                    if last is None:
                        raise OSError(f"no frame of {name} decodes")
                    out.append((name, int(i), last.tobytes(), last.shape[0], last.shape[1]))
                yield pd.DataFrame(out, columns=["path", "place", "data", "height", "width"])

    return rows.select(path, frames).mapInPandas(run, "path string, place int, data binary, height int, width int")


def read_tensors(spark: SparkSession, path: str) -> DataFrame:
    """bag, key, shape, data of the arrays in ``.npz`` archives; archives that hold serialised objects raise."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"], strict=True):
                with np.load(io.BytesIO(content), allow_pickle=False) as z:
                    yield pd.DataFrame([(name, k, list(z[k].shape), z[k].astype(float).ravel().tolist()) for k in z.files], columns=["bag", "key", "shape", "data"])

    return rows.mapInPandas(run, "bag string, key string, shape array<int>, data array<double>")


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """An image stretched to a size by the mean of the pixels that each new one covers; larger sizes repeat pixels."""
    rows = np.linspace(0, image.shape[0], height + 1)
    cols = np.linspace(0, image.shape[1], width + 1)
    cut = lambda e, n: [(int(a), max(int(np.ceil(b)), int(a) + 1)) for a, b in zip(e[:-1], np.minimum(e[1:], n), strict=True)]
    return np.array([[image[a:b, c:d].mean(axis=(0, 1)) for c, d in cut(cols, image.shape[1])] for a, b in cut(rows, image.shape[0])])


def augmented(image: np.ndarray, brightness: float = 1.0, contrast: float = 1.0, noise: float = 0.0, seed: int = 0) -> np.ndarray:
    """An image of bytes, brighter, with more contrast about its mean, and with noise."""
    x = image.astype(float) * brightness
    x = (x - x.mean()) * contrast + x.mean()
    return np.clip(x + np.random.default_rng(seed).normal(0, noise, x.shape) if noise else x, 0, 255).round().astype(np.uint8)


def fingerprint(image: np.ndarray, side: int = SIDE) -> np.ndarray:
    """A grey image of ``side`` by ``side`` as a vector with mean 0 and length 1; all 0 for an even image."""
    grey = image if image.ndim == 2 else image @ np.array([0.299, 0.587, 0.114])
    v = resized(grey.astype(float), side, side).ravel()
    v = v - v.mean()
    n = float(np.linalg.norm(v))
    return v / n if n > 1e-6 else v * 0


def collage(images: list[np.ndarray], side: int = COLLAGE) -> np.ndarray:
    """``side`` by ``side`` images of one size in one; missing ones are black, further ones are left out."""
    h, w = images[0].shape[:2]
    out = np.zeros((side * h, side * w, *images[0].shape[2:]), images[0].dtype)
    for i, image in enumerate(images[: side * side]):
        out[i // side * h : (i // side + 1) * h, i % side * w : (i % side + 1) * w] = image
    return out
