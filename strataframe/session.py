"""Session helpers: configuration the operators rely on, and shared output
folders.

Operators need the session time zone to be UTC (published stamps are UTC).
Output and lineage cuts go to the folder the cluster names in
``spark.checkpoint.dir``; only when it is unset and the master is local (tests)
is a fresh local folder taken.  The package is shipped to the executors once, so
that workers started elsewhere can import it.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[*]", app: str = "strataframe", **conf) -> SparkSession:
    """A session configured as the operators expect (tests and bench)."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


#: Bytes of rows that go to a Python worker at once.
ARROW_BATCH = "16m"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the operators rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # what a task and its Python worker hold of long texts at a time
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)
    shared_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand the package's sources to the executors, once for an application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="strataframe-src-"), "strataframe_src.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)


def shared_root(spark: SparkSession) -> str:
    """The shared folder for outputs and lineage cuts.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir); when
    neither is set, takes a fresh temp folder on a local master (a test) and
    raises on any other."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            root = current.rsplit("/", 1)[0]
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="strataframe-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return qualified(spark, root.rstrip("/"))


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, as Spark would resolve it: one without a
    scheme is on the cluster's default file system, not on each machine's disk."""
    if "://" in path or path.startswith("file:"):
        return path
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    whole = target.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(target).toString()
    return "file://" + whole[len("file:"):] if whole.startswith("file:/") and not whole.startswith("file://") else whole


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder path under the shared root (not created)."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def write_once(df: DataFrame, label: str, *, max_rows: int | None = None) -> DataFrame:
    """``df`` written under the shared folder and read back: plans that several
    jobs start from are made once, and survive lost executors.  With
    ``max_rows`` no file holds more rows than that."""
    path = scratch_path(df.sparkSession, label)
    (df.write if max_rows is None else df.write.option("maxRecordsPerFile", max_rows)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A table is broadcast only up to this size.
BROADCAST_BYTES = 8 << 20


def hinted(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` to be broadcast if its counted rows allow it, else as it is, for
    an ordinary join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df
