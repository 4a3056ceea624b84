"""Opening a collection wherever it is kept: a folder of files, an index page that lists them, a snapshot, or a table."""

from __future__ import annotations

import os
import re
from html.parser import HTMLParser
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import text as T
from colophon.sources import snapshots
from colophon.sources.yaml_records import load_records


class _Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.found += [v for k, v in attrs if k == "href" and v]


def listed_files(page: str) -> list[str]:
    """Names of the record files that an index page links to, each once and in order."""
    links = _Links()
    links.feed(page)
    names = {unquote(re.split("[?#]", href)[0].rstrip("/").rsplit("/", 1)[-1]) for href in links.found}
    return sorted(n for n in names if re.match(T.LISTED_FILE_SHAPE, n))


def record_files(names: list[str]) -> list[str]:
    """Of the paths of a tree those of record files, in order; as a listing of a revision gives them."""
    return sorted(n for n in names if re.match(T.LISTED_FILE_SHAPE, n.rsplit("/", 1)[-1]))


def open_collection(spark: SparkSession, place: str, name: str = "records", version: str | None = None, **how) -> DataFrame:
    """The records at a place, told by what it is.

    A version, or a folder that has versions of ``name``, is a snapshot (the latest if none is named); an ``.html`` file is the
    index of the folder beside it; a folder of ``.yaml`` or ``.yml`` files is read file by file; all else is a table. ``how`` is
    for the reader of files. A file that can't be read fails the load if mode="FAILFAST".
    """
    if version is not None or snapshots.versions(spark, place, name):
        return snapshots.load(spark, place, name, version)
    if place.lower().endswith((".html", ".htm")):
        with open(place, encoding="utf-8") as f:
            listed = listed_files(f.read())
        records = load_records(spark, os.path.dirname(place), **how)
        return records.where(F.element_at(F.split("path", "/"), -1).isin(listed))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kept = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) and fs.getFileStatus(path).isDirectory() else []
    return load_records(spark, place, **how) if record_files(kept) else spark.read.parquet(place)
