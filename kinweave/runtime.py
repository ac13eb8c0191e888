"""Session helpers shared by all operators: the shared folder, stage tables, sessions for tests."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting for shuffle files that go as a query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders of stage tables that are marked for deletion.
_KNOWN: set[str] = set()


def session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the engine expects (UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kinweave")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    A cluster names it in ``spark.checkpoint.dir``. Only a session of one machine may leave that
    unset (tests); a temporary folder is then made, kept for the process and deleted at its end.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("kinweave.local.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="kinweave-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        named = f"file://{folder}"
        spark.conf.set("kinweave.local.checkpoint.dir", named)
    return named.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's part of the shared folder, which is deleted when the application ends."""
    own = f"{shared_dir(spark)}/kinweave/{spark.sparkContext.applicationId}"
    if own not in _KNOWN:
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _KNOWN.add(own)
    return f"{own}/{label}-{uuid.uuid4().hex}"


def release_stages(spark: SparkSession) -> bool:
    """Delete the application's stage tables now, when no result that reads them is still needed. True if there were any."""
    own = f"{shared_dir(spark)}/kinweave/{spark.sparkContext.applicationId}"
    _KNOWN.discard(own)
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs the re-read of a file, never the work before. Shuffle files of the write go as
    it ends, else they would stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return staged(spark.read.schema(df.schema).parquet(path), path)


def staged(df: DataFrame, path: str | None) -> DataFrame:
    """``df`` as a reader of the stage table at ``path``, which ``discard`` deletes."""
    df._stage = path
    return df


def discard(*tables: DataFrame) -> None:
    """Delete stage tables that nothing reads any more; frames that are none are left alone."""
    for df in tables:
        if named := getattr(df, "_stage", None):
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(named)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
