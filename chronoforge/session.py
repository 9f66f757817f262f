"""Session helpers: a local session for tests and reliable lineage cuts.

On a cluster the session is created by the caller; ``spark.checkpoint.dir`` names a shared
folder. Here we only read it, and set a private one when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def get_spark(master: str = "local[8]", app: str = "chronoforge", **conf: str) -> SparkSession:
    """Return the active session or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in {**_DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (``mapInPandas`` / ``applyInPandas``
    functions refer to its helpers): zip the package once per application and ``addPyFile`` it,
    which distributes the code to every executor. The zip is code, built on the driver."""
    sc = spark.sparkContext
    key = sc.applicationId
    with _SHIP_LOCK:
        if key in _SHIPPED:
            return
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg_dir)
        path = os.path.join(tempfile.mkdtemp(prefix="chronoforge-code-"), "chronoforge.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for base, _, files in os.walk(pkg_dir):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(base, f)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(path)
        _SHIPPED.add(key)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a private one only when none is set."""
    ship_package(spark)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="chronoforge-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` to the checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_table(df: DataFrame) -> DataFrame:
    """Cut lineage by a Parquet table in the checkpoint folder. For loops: unlike a checkpoint, the table's size
    estimate is that of its files, so estimates do not multiply from round to round."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
