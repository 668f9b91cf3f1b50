"""Session helpers: a local session for tests/bench and the shared checkpoint folder.

On a cluster the session is built by the platform; library code only *reads*
``spark.checkpoint.dir`` from it.  Tests and the bench set their own folder when
the setting is unset.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tabforge") -> SparkSession:
    """A local session with the settings the library is tuned for."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TABFORGE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, allow_local=True)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, allow_local: bool = False) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    When unset: tests (``allow_local=True``) get a fresh scratch folder, kept for the
    session as its checkpoint folder; library code raises, since a machine-local folder
    is wrong on a cluster.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not allow_local:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) so lineage can be cut safely")
        d = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="tabforge-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path below the shared checkpoint folder for written tables."""
    import uuid
    base = ensure_checkpoint_dir(spark, allow_local=_is_local(spark))
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def release_scratch(spark: SparkSession, since: int = 0) -> None:
    """Delete the scratch tables that this process has made (from the ``since``-th on).

    Results that are not written yet can no longer be computed afterwards.
    """
    conf = spark._jsc.hadoopConfiguration()
    while len(_made) > since:
        p = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        p.getFileSystem(conf).delete(p, True)


@contextmanager
def scratch(spark: SparkSession):
    """The scratch tables of what runs inside are deleted at the end: write the result within.

    Not for queries that run side by side: use one block around them.
    """
    since = len(_made)
    try:
        yield
    finally:
        release_scratch(spark, since)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back: computed once, kept by no executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")
