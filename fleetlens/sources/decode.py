"""Sensor files as features and points: pure functions of bytes, run on Arrow batches.

A decoder is registered by modality.  A file that does not decode gives a row
with the reason instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEATURES, POINTS
from ..session import ship
from .raw import relative

#: Bytes of a LiDAR record: x, y, z, intensity, ring as little-endian float32.
RECORD = 20
MAX_ERROR = 200


class DecodeError(ValueError):
    """A file is not what its modality says."""


def lidar_points(content: bytes, dims: int = 5, checked: bool = True):
    import numpy as np

    if checked and (not content or len(content) % (4 * dims)):
        raise DecodeError(f"{len(content)} bytes are no whole number of {4 * dims}-byte points")
    usable = len(content) // (4 * dims) * (4 * dims)
    return np.frombuffer(content[:usable], dtype="<f4").reshape(-1, dims)


def lidar_features(content: bytes, width: int, height: int) -> dict[str, float]:
    import numpy as np

    p = lidar_points(content).astype(np.float64)
    r = np.sqrt((p[:, :3] ** 2).sum(1))
    return {"n_points": float(len(p)), "mean_range": float(r.mean()), "max_range": float(r.max()), "mean_intensity": float(p[:, 3].mean())}


def pcd_header(content: bytes) -> tuple[dict[str, list[str]], int]:
    """The header's fields and its length; the DATA line must come within 4096 bytes."""
    fields: dict[str, list[str]] = {}
    at = 0
    while at < min(len(content), 4096):
        end = content.find(b"\n", at)
        if end < 0 or end > 4096:
            break
        name, *values = content[at:end].decode("latin-1").split() or [""]
        at = end + 1
        if name and not name.startswith("#"):
            fields[name] = values
        if name == "DATA":
            return fields, at
    raise DecodeError("no DATA line within 4096 bytes")


def radar_features(content: bytes, width: int, height: int) -> dict[str, float]:
    fields, at = pcd_header(content)
    try:
        points = int(fields["POINTS"][0])
        sizes = [int(s) for s in fields["SIZE"]]
        counts = [int(c) for c in fields.get("COUNT", ["1"] * len(sizes))]
    except (KeyError, IndexError, ValueError) as e:
        raise DecodeError(f"bad header: {e}") from e
    due = points * sum(s * c for s, c in zip(sizes, counts, strict=True))
    if fields["DATA"][:1] == ["binary"] and len(content) - at != due:
        raise DecodeError(f"body has {len(content) - at} bytes, header says {due}")
    return {"n_points": float(points)}


def image_features(pixels: bytes, rows: int, cols: int, channels: int, side: int = 320) -> dict[str, float]:
    """Mean and spread of grey, and the variance of its Laplacian, at a width of ``side``; averaged over blocks when shrunk."""
    import numpy as np

    img = np.frombuffer(pixels, np.uint8).reshape(rows, cols, channels).astype(np.float64)
    grey = img[:, :, 0] if channels == 1 else img[:, :, 2] * 0.299 + img[:, :, 1] * 0.587 + img[:, :, 0] * 0.114  # stored blue first
    if cols > side:
        h = max(1, round(rows * side / cols))
        y, x = np.linspace(0, rows, h + 1).astype(int), np.linspace(0, cols, side + 1).astype(int)
        area = np.add.reduceat(np.add.reduceat(grey, y[:-1], axis=0), x[:-1], axis=1)
        grey = area / np.outer(np.diff(y), np.diff(x))
    edges = grey[1:-1, :-2] + grey[1:-1, 2:] + grey[:-2, 1:-1] + grey[2:, 1:-1] - 4 * grey[1:-1, 1:-1]
    return {"brightness": float(grey.mean()), "contrast": float(grey.std()), "sharpness": float(edges.var()) if edges.size else 0.0}


#: Modality: file suffix and decoder of (content, width, height).  Cameras go through Spark's image source.
REGISTRY: dict[str, tuple[str, Callable | None]] = {"camera": (".jpg", None), "lidar": (".pcd.bin", lidar_features), "radar": (".pcd", radar_features)}


def modality(name: str) -> tuple[str, Callable | None]:
    if name not in REGISTRY:
        raise KeyError(f"unknown modality {name!r}; known: {sorted(REGISTRY)}")
    return REGISTRY[name]


def _rows(found: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{n: f.get(n) for n in FEATURES.names} for f in found], schema=pa.schema([("frame_token", pa.string()), ("decode_ok", pa.bool_()), ("decode_error", pa.string()), *[(n, pa.float64()) for n in FEATURES.names[3:]]]))


def binary_features(files: DataFrame, kind: str) -> DataFrame:
    """Features of files (frame_token, content, width, height) of a modality that is read as bytes."""
    decode = modality(kind)[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for token, content, w, h in zip(*(batch.column(c).to_pylist() for c in ("frame_token", "content", "width", "height")), strict=True):
                try:
                    out.append({"frame_token": token, "decode_ok": True} | decode(content, w, h))
                except Exception as e:  # one bad file is a finding, not a failure
                    out.append({"frame_token": token, "decode_ok": False, "decode_error": f"{type(e).__name__}: {e}"[:MAX_ERROR]})
            if out:
                yield _rows(out)

    return files.select("frame_token", "content", "width", "height").mapInArrow(run, FEATURES)


def _camera_features(images: DataFrame, side: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for token, w, h, width, height, channels, data in zip(*(batch.column(c).to_pylist() for c in ("frame_token", "width", "height", "cols", "rows", "channels", "data")), strict=True):
                if width is None or width < 0:
                    out.append({"frame_token": token, "decode_ok": False, "decode_error": "not an image"})
                elif (width, height) != (w, h):
                    out.append({"frame_token": token, "decode_ok": False, "decode_error": f"image is {width}x{height}, metadata say {w}x{h}"})
                else:
                    out.append({"frame_token": token, "decode_ok": True} | image_features(data, height, width, channels, side))
            if out:
                yield _rows(out)

    return images.select("frame_token", "width", "height", "cols", "rows", "channels", "data").mapInArrow(run, FEATURES)


def frame_features(spark: SparkSession, frames: DataFrame, root: str, side: int = 320) -> DataFrame:
    """One row a frame: what its file decodes to, or why it does not.  Files are read where they lie and never collected."""
    ship(spark)
    parts = []
    wanted = frames.select("frame_token", "filename", "modality", "width", "height")
    dirs = [f"{root}/samples", f"{root}/sweeps"]
    images = spark.read.format("image").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jpg").load(dirs)
    img = images.select(relative(F.col("image.origin")).alias("filename"), F.col("image.width").alias("cols"), F.col("image.height").alias("rows"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))
    parts.append(_camera_features(wanted.where("modality = 'camera'").join(img, "filename"), side))
    for kind in ("lidar", "radar"):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{modality(kind)[0]}").load(dirs)
        parts.append(binary_features(wanted.where(F.col("modality") == kind).join(files.select(relative(F.col("path")).alias("filename"), "content"), "filename"), kind))
    decoded = parts[0].unionByName(parts[1]).unionByName(parts[2])
    every = wanted.select("frame_token").join(decoded, "frame_token", "left")
    return every.withColumns({"decode_error": F.when(F.col("decode_ok").isNull(), F.lit("missing file")).otherwise(F.col("decode_error")), "decode_ok": F.coalesce("decode_ok", F.lit(False))})


def read_points(spark: SparkSession, frames: DataFrame, root: str, dims: int = 5) -> DataFrame:
    """The points of LiDAR frames (frame_token, filename), one row a point; files that do not decode have none."""
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pcd.bin").load([f"{root}/samples", f"{root}/sweeps"])
    rows = frames.select(F.col("frame_token").alias("lidar_frame"), "filename").join(files.select(relative(F.col("path")).alias("filename"), "content"), "filename").select("lidar_frame", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for token, content in zip(batch.column("lidar_frame").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    p = lidar_points(content, dims).astype(np.float64)
                except DecodeError:
                    continue
                yield pa.RecordBatch.from_arrays([pa.array([token] * len(p)), *[pa.array(p[:, i]) for i in range(4)]], names=POINTS.names)

    return rows.mapInArrow(run, POINTS)
