"""Snapshots of a collection, addressed by version: one folder a version, ``root/name/version=…``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from colophon.operators import diff as D


class SnapshotError(ValueError):
    """A comparison that can't be made; code is one of comparison, invalid_revision, merge_base (what was asked
    for), failed (a version that can't be read), parse (one without ids), history_failed (no history to look ids up in)."""

    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code


def versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """Versions there are, oldest first. Versions compare as text."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName().split("=", 1)[1] for s in fs.listStatus(path) if s.getPath().getName().startswith("version="))


def save(df: DataFrame, root: str, name: str, version: str) -> None:
    df.write.mode("errorifexists").parquet(f"{root}/{name}/version={version}")


def load(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """A version, the latest if none is named. Only its folder is read."""
    there = versions(spark, root, name)
    if not there or version is not None and version not in there:
        raise SnapshotError("invalid_revision", f"{name} has no version {version}")
    try:
        return spark.read.parquet(f"{root}/{name}/version={version or there[-1]}")
    except AnalysisException as e:
        raise SnapshotError("failed", f"{name} {version or there[-1]}: {e}") from e


def changes(spark: SparkSession, root: str, name: str, base: str, head: str, mode: str = "direct", fork: str | None = None, id_col: str = "record_id") -> DataFrame:
    """Changes from base to head. mode="merge-base" compares head with the version both come from (``fork``), so that what only
    the base has changed since is no change."""
    if mode not in ("direct", "merge-base"):
        raise SnapshotError("comparison", f"unknown mode {mode!r}")
    if mode == "merge-base" and not fork:
        raise SnapshotError("merge_base", "the common version is not known")
    sides = [load(spark, root, name, v) for v in (fork if mode == "merge-base" else base, head)]
    if any(id_col not in side.columns for side in sides):
        raise SnapshotError("parse", f"{name} has no column {id_col}")
    return D.detect(*sides, id_col)


def history(spark: SparkSession, root: str, name: str, upto: str | None = None, id_col: str = "record_id") -> DataFrame:
    """``(id, first_seen, last_seen)`` over all versions up to one: what ids were ever used."""
    chosen = [v for v in versions(spark, root, name) if upto is None or v <= upto]
    out = None
    for v in chosen:
        one = spark.read.parquet(f"{root}/{name}/version={v}").select(F.col(id_col), F.lit(v).alias("v"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise SnapshotError("history_failed", f"{name} has no version{f' up to {upto}' if upto else ''}")
    return out.groupBy(id_col).agg(F.min("v").alias("first_seen"), F.max("v").alias("last_seen"))
