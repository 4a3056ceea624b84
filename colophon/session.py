"""Session factory, shared scratch space and shipping of this package to executors."""

from __future__ import annotations

import atexit
import io
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Defaults for a session built here; a session handed in from outside keeps its own settings.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "8192",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "colophon", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by spark.checkpoint.dir.

    Where that setting is missing and all runs on one machine (tests), a folder of our own is made, recorded in the session and
    removed when the program ends. On a cluster a missing setting is an error, since no folder of one machine will do.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors can reach")
        own = tempfile.mkdtemp(prefix="colophon-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        base = "file://" + own
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/colophon/{tag}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, tag: str = "table", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a copy that outlives any executor, and fixes whatever was not deterministic
    (monotonically increasing ids). Rows keep their values and types; order is not kept.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_scratch(spark: SparkSession) -> None:
    """Deletes all tables that this library wrote to the shared folder; what was read from them can't be used any more."""
    base = shared_dir(spark) + "/colophon"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers of a cluster; once a session, nothing to do in local mode."""
    sc = spark.sparkContext
    if is_local(spark) or getattr(sc, "_colophon_shipped", False):
        return
    root = Path(__file__).parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = scratch_path(spark, "code") + ".zip"
    jvm = sc._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(data.getvalue()))
    stream.close()
    sc.addPyFile(path)
    sc._colophon_shipped = True
