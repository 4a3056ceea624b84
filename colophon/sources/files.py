"""Inventory of attached files: size, content hash, kind and what headers tell, without decoding the media."""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Kinds of files by their ending.
IMAGES = ["png", "jpg", "jpeg", "tif", "tiff", "gif", "webp"]
WORKBOOKS = ["xlsx", "xlsm"]
MEDIA = "format string, width int, height int, frames int, sheets array<string>"


def image_header(data: bytes) -> tuple[str, int, int, int] | None:
    """(format, width, height, frames) from the header of a PNG, GIF, JPEG, TIFF or WebP file; None if it is none."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        at, frames = 8, 1
        while at + 12 <= len(data):
            size, kind = struct.unpack(">I4s", data[at : at + 8])
            if kind == b"acTL" and at + 12 <= len(data):
                frames = struct.unpack(">I", data[at + 8 : at + 12])[0]
            at += 12 + size
        return "PNG", *struct.unpack(">II", data[16:24]), frames
    if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10:
        return "GIF", *struct.unpack("<HH", data[6:10]), max(data.count(b"\x00\x21\xf9\x04"), 1)
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(data) and data[at] == 0xFF:
            kind, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                height, width = struct.unpack(">HH", data[at + 5 : at + 9])
                return "JPEG", width, height, 1
            at += 2 + size
        return None
    if data[:4] in (b"II*\x00", b"MM\x00*"):
        order = "<" if data[:2] == b"II" else ">"
        at, frames, size = struct.unpack(order + "I", data[4:8])[0], 0, {}
        while at and at + 2 <= len(data) and frames < 100_000:
            n = struct.unpack(order + "H", data[at : at + 2])[0]
            for i in range(n if not frames else 0):
                tag, kind, _, raw = struct.unpack(order + "HHI4s", data[at + 2 + 12 * i : at + 14 + 12 * i])
                size[tag] = struct.unpack(order + ("H2x" if kind == 3 else "I"), raw)[0]
            frames += 1
            tail = data[at + 2 + 12 * n : at + 6 + 12 * n]
            at = struct.unpack(order + "I", tail)[0] if len(tail) == 4 else 0
        return "TIFF", size.get(256, 0), size.get(257, 0), frames
    if data[:4] == b"RIFF" and data[8:16] == b"WEBPVP8X" and len(data) >= 30:
        return "WEBP", 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little"), max(data.count(b"ANMF"), 1)
    if data[:4] == b"RIFF" and data[8:16] == b"WEBPVP8 " and data[23:26] == b"\x9d\x01\x2a" and len(data) >= 30:
        width, height = struct.unpack("<HH", data[26:30])
        return "WEBP", width & 0x3FFF, height & 0x3FFF, 1
    if data[:4] == b"RIFF" and data[8:16] == b"WEBPVP8L" and data[20:21] == b"\x2f" and len(data) >= 25:
        bits = int.from_bytes(data[21:25], "little")
        return "WEBP", (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1, 1
    return None


def sheet_names(data: bytes) -> list[str] | None:
    """Names of the sheets of a workbook in order; None if it can't be read."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            tree = ElementTree.fromstring(z.read("xl/workbook.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None
    return [e.attrib["name"] for e in tree.iter() if e.tag.endswith("}sheet")]


def _media(contents: pd.Series) -> pd.DataFrame:
    rows = []
    for c in contents:
        data = bytes(c) if c is not None else b""
        rows.append((*(image_header(data) or (None,) * 4), sheet_names(data) if data[:2] == b"PK" else None))
    out = pd.DataFrame(rows, columns=["format", "width", "height", "frames", "sheets"])
    return out.astype({"width": "Int32", "height": "Int32", "frames": "Int32"})


def inventory(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """``(name, bytes, sha256, kind, format, width, height, frames, sheets)`` of the files in a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    ending = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    kind = F.when(ending.isin(IMAGES), "image").when(ending.isin(WORKBOOKS), "workbook").otherwise("unhandled")
    out = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), kind.alias("kind"), "content")
    known = F.when(F.col("kind") != "unhandled", F.pandas_udf(_media, MEDIA)("content"))
    return out.withColumn("m", known).select("name", "bytes", "sha256", "kind", "m.*")


def write_inventory(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").json(folder)
