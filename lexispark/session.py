"""Session settings and the reliable checkpoint used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "lexispark", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is tuned for; anything in ``conf`` wins."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        **{k.replace("__", "."): str(v) for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in ``spark.checkpoint.dir``.

    A scratch folder is made only for local runs: a machine-local path on a cluster would
    be lost with its executor.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back from there afterwards."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` as a Parquet table in the checkpoint folder.

    Unlike a checkpoint it carries no constraints of the plan it came from, which grow from step to step of a loop.
    """
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffles of queries run inside are removed as they end (else they stay until the driver collects its garbage)."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


def cached(df: DataFrame) -> DataFrame:
    """Keep ``df`` for an iterative fit; lost blocks are recomputed from its lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
