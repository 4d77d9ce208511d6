"""Image files to raster rows and back. Pillow decodes and encodes every format where it is installed; without it, PPM and 8-bit PNG."""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

try:
    from PIL import Image, ImageOps
except ImportError:
    Image = ImageOps = None

RASTER = "image_key string, ok boolean, error string, w int, h int, data binary"
_PNG = b"\x89PNG\r\n\x1a\n"


def _ppm(content: bytes) -> np.ndarray:
    fields, at = [], 2
    while len(fields) < 3:
        while content[at : at + 1].isspace():
            at += 1
        if content[at : at + 1] == b"#":
            at = content.index(b"\n", at)
            continue
        end = at
        while content[end : end + 1].isdigit():
            end += 1
        fields.append(int(content[at:end]))
        at = end
    w, h, _ = fields
    return np.frombuffer(content, np.uint8, w * h * 3, at + 1).reshape(h, w, 3)


def _unfiltered(raw: np.ndarray, step: int) -> np.ndarray:
    """Rows of a PNG (filter byte first) as plain bytes. The last resort where Pillow is missing: two filters take a step a byte."""
    out = np.zeros((len(raw), raw.shape[1] - 1), np.uint8)
    above = np.zeros(out.shape[1], np.uint8)
    for row, line in zip(out, raw, strict=True):
        kind, body = line[0], line[1:]
        if kind == 0:
            row[:] = body
        elif kind == 1:
            for c in range(step):
                row[c::step] = np.cumsum(body[c::step], dtype=np.uint8)
        elif kind == 2:
            row[:] = body + above
        else:
            for k in range(len(body)):
                left, up, corner = (int(row[k - step]) if k >= step else 0), int(above[k]), (int(above[k - step]) if k >= step else 0)
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    near = [(abs(up - corner), 0, left), (abs(left - corner), 1, up), (abs(left + up - 2 * corner), 2, corner)]
                    guess = min(near)[2]
                row[k] = (int(body[k]) + guess) & 255
        above = row
    return out


def _png(content: bytes) -> np.ndarray:
    at, data, w = len(_PNG), b"", 0
    while at < len(content):
        size, kind = struct.unpack(">I4s", content[at : at + 8])
        body = content[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            w, h, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data += body
        at += size + 12
    bands = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if depth != 8 or interlaced or not bands:
        raise ValueError("this kind of PNG needs Pillow")
    raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(h, w * bands + 1)
    image = _unfiltered(raw, bands).reshape(h, w, bands)
    return image[:, :, :3] if bands >= 3 else np.repeat(image[:, :, :1], 3, axis=2)


def decode(content: bytes) -> np.ndarray:
    """h x w x 3 bytes; upright, as the file's orientation says, where Pillow is installed."""
    if not content:
        raise ValueError("file is empty")
    if Image:
        return np.asarray(ImageOps.exif_transpose(Image.open(io.BytesIO(content))).convert("RGB"))
    if content[:2] == b"P6":
        return _ppm(content)
    if content.startswith(_PNG):
        return _png(content)
    raise ValueError("this format needs Pillow")


def encode_png(image: np.ndarray) -> bytes:
    h, w, _ = image.shape
    raw = np.concatenate([np.zeros((h, 1), np.uint8), image.reshape(h, w * 3)], axis=1).tobytes()

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return _PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def decoded(images: DataFrame) -> DataFrame:
    """A raster row for every image (image_key, content); one that can't be decoded has ok false and the error, and stops nothing."""

    def run(batches):
        for batch in batches:
            rows = []
            for key, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    image = decode(content.as_py() or b"")
                    rows.append((key, True, None, image.shape[1], image.shape[0], np.ascontiguousarray(image).tobytes()))
                except Exception as e:  # whatever a broken file makes a decoder raise
                    rows.append((key, False, str(e)[:500] or type(e).__name__, None, None, None))
            kinds = (pa.string(), pa.bool_(), pa.string(), pa.int32(), pa.int32(), pa.binary())
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["image_key", "ok", "error", "w", "h", "data"])

    return images.select(F.col("image_key").cast("string"), "content").mapInArrow(run, RASTER)


def pixels_of(rasters: DataFrame, block: int = 1 << 17) -> DataFrame:
    """One row per pixel of decoded rasters: image_key, x, y, r, g, b, w, h; in blocks of rows, so that a large raster isn't expanded whole."""

    def run(batches):
        for batch in batches:
            for key, w, h, data in zip(*(batch.column(k) for k in range(4)), strict=True):
                w, h = w.as_py(), h.as_py()
                image = np.frombuffer(data.as_buffer(), np.uint8).reshape(h, w, 3)
                for top in range(0, h, max(1, block // w)):
                    part = image[top : top + max(1, block // w)]
                    y, x = np.divmod(np.arange(part.shape[0] * w), w)
                    columns = [pa.array([key.as_py()] * len(x)), pa.array(x), pa.array(y + top), *(pa.array(part[:, :, c].ravel().astype(np.int32)) for c in range(3)), pa.array(np.full(len(x), w)), pa.array(np.full(len(x), h))]
                    yield pa.record_batch(columns, ["image_key", "x", "y", "r", "g", "b", "w", "h"])

    return rasters.where("ok").select("image_key", "w", "h", "data").mapInArrow(run, "image_key string, x long, y long, r int, g int, b int, w long, h long")


def rasters_of(pixels: DataFrame) -> DataFrame:
    """Raster rows of a pixel relation; missing pixels are black. An image is the unit that is held."""

    def run(frame):
        import pandas as pd

        w, h = int(frame["x"].max()) + 1, int(frame["y"].max()) + 1
        image = np.zeros((h, w, 3), np.uint8)
        image[frame["y"], frame["x"]] = frame[["r", "g", "b"]].to_numpy(np.uint8)
        return pd.DataFrame({"image_key": [frame["image_key"].iloc[0]], "ok": [True], "error": [None], "w": [w], "h": [h], "data": [image.tobytes()]})

    return pixels.select("image_key", "x", "y", "r", "g", "b").groupBy("image_key").applyInPandas(run, RASTER)


def encode(image: np.ndarray, extension: str = ".png", quality: int = 95) -> bytes:
    """A file's bytes, in the format of the extension where Pillow is installed; without it, PNG whatever the extension."""
    if Image and extension.lower() != ".png":
        kind = {".jpg": "JPEG", ".jpeg": "JPEG", ".tif": "TIFF", ".tiff": "TIFF", ".webp": "WEBP"}[extension.lower()]
        out = io.BytesIO()
        Image.fromarray(image).save(out, kind, **({"quality": quality} if kind in ("JPEG", "WEBP") else {}))
        return out.getvalue()
    return encode_png(image)


def file_name(image_key: str) -> str:
    """The source's own name; what can only be written as PNG gets that extension behind it."""
    extension = image_key[image_key.rfind(".") :].lower()
    return image_key if Image or extension == ".png" else f"{image_key}.png"


def exported(rasters: DataFrame, root: str) -> DataFrame:
    """image_key, path and size of a picture file below root for each raster, under its source's name. root is a folder of a file system
    that all executors reach. A file is written beside its place and moved there, so a task that runs again does no harm."""

    def run(batches):
        import uuid

        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        for batch in batches:
            rows = []
            for key, w, h, data in zip(*(batch.column(k) for k in range(4)), strict=True):
                name = file_name(key.as_py())
                image = np.frombuffer(data.as_buffer(), np.uint8).reshape(h.as_py(), w.as_py(), 3)
                content = encode(image, name[name.rfind(".") :])
                path = f"{base.rstrip('/')}/{name}"
                store.create_dir(path.rpartition("/")[0], recursive=True)
                part = f"{path}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(part) as out:
                    out.write(content)
                store.move(part, path)
                rows.append((key.as_py(), path, len(content)))
            columns = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], ["image_key", "path", "size"])

    return rasters.where("ok").select("image_key", "w", "h", "data").mapInArrow(run, "image_key string, path string, size long")
