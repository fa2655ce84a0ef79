"""FITS images: headers as maps, planes as rows, and planes back to files' bytes.

Only a primary image of two axes is read.  A file's header and samples are decoded where the file is read; a large image gives its rows
in strips, so that no Arrow batch holds more than one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Sizes of the format, and the types of its samples.
CARD, BLOCK = 80, 2880
SAMPLES = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}


def read_cards(raw: bytes) -> tuple[dict[str, str], int]:
    """(values by key, where the samples begin)."""
    cards = {}
    for at in range(0, len(raw) - CARD + 1, CARD):
        card = raw[at : at + CARD].decode("ascii", "replace")
        if card[:8].rstrip() == "END":
            return cards, -(-(at + CARD) // BLOCK) * BLOCK
        if card[8:10] == "= ":
            text = card[10:].strip()
            cards[card[:8].rstrip()] = text[1 : text.index("'", 1)].rstrip() if text[:1] == "'" and "'" in text[1:] else text.split("/")[0].strip()
    raise ValueError("the header has no end")


def read_image(raw: bytes) -> tuple[dict[str, str], np.ndarray]:
    cards, at = read_cards(raw)
    if cards.get("NAXIS") != "2":
        raise ValueError("no image of two axes")
    shape = int(cards["NAXIS2"]), int(cards["NAXIS1"])
    samples = np.frombuffer(raw, SAMPLES[int(cards["BITPIX"])], count=shape[0] * shape[1], offset=at).reshape(shape)
    return cards, samples.astype(np.float64) * float(cards.get("BSCALE", 1)) + float(cards.get("BZERO", 0))


def write_image(plane: np.ndarray, more: dict[str, object] | None = None) -> bytes:
    """32-bit floats with the given cards."""
    cards = {"SIMPLE": "T", "BITPIX": -32, "NAXIS": 2, "NAXIS1": plane.shape[1], "NAXIS2": plane.shape[0], **(more or {})}
    text = "".join(f"{k:<8}= {(repr(v) if isinstance(v, str) and v != 'T' else str(v)):>20}".ljust(CARD) for k, v in cards.items()) + "END".ljust(CARD)
    head = text.ljust(-(-len(text) // BLOCK) * BLOCK).encode("ascii")
    body = plane.astype(">f4").tobytes()
    return head + body + bytes(-len(body) % BLOCK)


def files(spark: SparkSession, path: str, pattern: str = "*.fits") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)


def inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(folder, n, bytes, latest) of the files below a path, without reading them."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    return found.groupBy(folder).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("latest"))


def headers(found: DataFrame) -> DataFrame:
    """(path, cards) of binary files; cards is a map of text, null for a file that is no FITS."""

    @F.pandas_udf("map<string,string>")
    def cards(raw: pd.Series) -> pd.Series:
        def one(x: bytes) -> dict | None:
            try:
                return read_cards(x)[0]
            except ValueError:
                return None

        return raw.map(one)

    return found.select("path", cards("content").alias("cards"))


def card(name: str, kind: str = "double"):
    """A header's value by key, null where it is missing or unreadable."""
    return F.col("cards")[name].try_cast(kind)


def planes(found: DataFrame, strip: int = 256) -> DataFrame:
    """(frame, x, y, value) of binary files; NaN samples are null."""
    schema = "frame string, x int, y int, value double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, raw in zip(b.column(0).to_pylist(), b.column(1)):
                image = read_image(raw.as_py())[1]
                for at in range(0, image.shape[0], strip):
                    part = image[at : at + strip]
                    y, x = np.indices(part.shape, dtype=np.int32)
                    value = pa.array(part.ravel(), mask=np.isnan(part.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array([path] * part.size), pa.array(x.ravel()), pa.array(y.ravel() + np.int32(at)), value], names=["frame", "x", "y", "value"])

    return found.select("path", "content").mapInArrow(run, schema)


def encoded(plane: DataFrame, nx: int, ny: int) -> DataFrame:
    """(frame, content): each frame's pixels as one file; pixels without a row are NaN.  A frame is one image, which a task holds."""

    def one(group: pd.DataFrame) -> pd.DataFrame:
        out = np.full((ny, nx), np.nan)
        out[group["y"].to_numpy(), group["x"].to_numpy()] = group["value"].to_numpy(float)
        return pd.DataFrame({"frame": group["frame"].iloc[:1], "content": [write_image(out)]})

    inside = plane.where((F.col("x") >= 0) & (F.col("x") < nx) & (F.col("y") >= 0) & (F.col("y") < ny)).select("frame", "x", "y", F.col("value").cast("double"))
    return inside.groupBy("frame").applyInPandas(one, "frame string, content binary")
