"""Session settings and the shared folder where written intermediates go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(
    app: str = "quotemill", master: str | None = None, **settings: object
) -> SparkSession:
    """A session that re-plans at run time, splits skewed joins and reads dates in UTC."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local session without the setting gets a fresh temporary folder; a cluster without it is an
    error, because a driver-local folder would be lost with the machine.
    """
    named = spark.conf.get(_CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="quotemill-")
    spark.conf.set(_CHECKPOINT_DIR, made)
    return made


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/quotemill/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives Spark the real size of an
    intermediate, so its own broadcast decision is made on bytes written rather than on a guess.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(*steps: Callable[[], object]) -> list[object]:
    """Start independent jobs at once, so small tables do not wait for each other's tasks."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        running = [pool.submit(step) for step in steps]
        return [job.result() for job in running]
