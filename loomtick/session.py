"""Sessions and the folder that all executors share."""

from __future__ import annotations

import atexit
import hashlib
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(name: str = "loomtick", master: str | None = None, **conf: object) -> SparkSession:
    """A session with this engine's defaults; ``conf`` overrides them (dots written as in Spark, via ``**{"spark.x": v}``)."""
    builder = SparkSession.builder.appName(name).config(map=_DEFAULTS | {k: str(v) for k, v in conf.items()})
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Only where that is unset and the master is local a temporary one is made and set.

    On a cluster every executor would write to a disk of its own, so there an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    own = getattr(spark, "_loomtick_root", None)
    if not own:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        own = tempfile.mkdtemp(prefix="loomtick-")
        spark._loomtick_root = own
        atexit.register(shutil.rmtree, own, True)
        spark.sparkContext.setCheckpointDir(f"file://{own}/checkpoints")
    return f"file://{own}"


def work_folder(spark: SparkSession, what: str) -> str:
    """A new, empty folder name for one run of ``what`` below the shared folder; :func:`clear_work` removes it."""
    path = f"{shared_root(spark)}/{what}-{uuid.uuid4().hex}"
    if not hasattr(spark, "_loomtick_work"):
        spark._loomtick_work = []
    spark._loomtick_work.append(path)
    return path


def clear_work(spark: SparkSession) -> int:
    """Removes the work folders made by this session so far; returns how many there were. Results that are still lazy need them."""
    gone = 0
    for path in getattr(spark, "_loomtick_work", []):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True))
    spark._loomtick_work = []
    return gone


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends, and later readers don't compute it anew."""
    spark = df.sparkSession
    path = work_folder(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def signature(df: DataFrame, version: str) -> str:
    """A hash of what a table is made from: its files with their sizes and times, its plan, and the ``version`` of the code that makes it."""
    spark = df.sparkSession
    found = [version, df._jdf.queryExecution().analyzed().canonicalized().treeString()]
    for name in sorted(df.inputFiles()):
        at = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at)
        found.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(re.sub(r"#\d+L?", "", x) for x in found).encode()).hexdigest()[:32]


def cached(df: DataFrame, what: str, version: str, root: str | None = None) -> DataFrame:
    """``df`` from a cache of derived tables keyed by :func:`signature`: computed and written once, read as long as its input files,
    its plan and ``version`` are the same. A write that was cut short has no ``_SUCCESS`` and is done again."""
    spark = df.sparkSession
    path = f"{(root or shared_root(spark)).rstrip('/')}/cache/{what}-{signature(df, version)}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def default_parallelism(spark: SparkSession) -> int:
    """The configured number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", os.environ.get("SPARK_SHUFFLE_PARTITIONS", "200")))


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application: functions that run in Python workers import it there."""
    context = spark.sparkContext
    if getattr(context, "_loomtick_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    at = os.path.join(tempfile.mkdtemp(prefix="loomtick-code-"), "loomtick.zip")
    with zipfile.ZipFile(at, "w") as z:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("loomtick", os.path.relpath(path, package)))
    context.addPyFile(at)
    context._loomtick_shipped = True
