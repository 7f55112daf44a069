"""Session helpers: build a session with sane defaults, and find the shared
folder used for checkpoints and intermediate tables.
"""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings that matter at scale as much as locally: adaptive execution
# (partition coalescing, skew-join splitting, runtime broadcast conversion)
# and no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files of DataFrames that are no longer referenced, so
    # the shared checkpoint folder does not grow without bound
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", app: str = "tessera",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session. What the launcher set (spark-submit, its defaults
    file, or a running session) is kept: this helper only fills in what is
    unset. ``extra`` is the caller's own choice and always applies."""
    conf = {"spark.master": master, "spark.app.name": app,
            "spark.sql.shuffle.partitions": str(shuffle_partitions), **DEFAULT_CONF}
    if SparkContext._active_spark_context is None:
        # Defaults go to the JVM's launch, where the launcher's arguments
        # override them; what results is what the session is built with.
        SparkContext._ensure_initialized(conf=SparkConf().setAll([*conf.items(), *(extra or {}).items()]))
        given = dict(SparkConf().getAll())
        conf = {k: v for k, v in conf.items() if k not in given}
    else:
        conf = {}
    builder = SparkSession.builder
    for k, v in {**conf, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the launcher to a shared file system and is
    used as is. Only when it is unset (local tests) do we create one.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:  # already set on the context (by the launcher or earlier)
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
        path = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}{name}-{uuid.uuid4().hex[:12]}"



def held_tables(spark: SparkSession) -> dict[int, str]:
    """Id and name of everything the executors hold persisted for this
    application (DataFrames that were cached, and what estimators keep)."""
    held = spark.sparkContext._jsc.getPersistentRDDs()
    return {int(i): str(held[i].name() or held[i].toString()) for i in held}


# Names under which ALS persists its factors; its estimator keeps them after the fit.
ESTIMATOR_TABLES = ("userFactors", "itemFactors", "userInBlocks", "userOutBlocks", "itemInBlocks", "itemOutBlocks")


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Release what estimators persist within the block and do not release
    themselves. Results that depend on it must be written or checkpointed
    inside. Tables that were held before, or that a caller caches under names
    of its own, stay."""
    before = held_tables(spark)
    try:
        yield
    finally:
        held = spark.sparkContext._jsc.getPersistentRDDs()
        for i in list(held):
            if int(i) not in before and str(held[i].name() or "").startswith(ESTIMATOR_TABLES):
                held[i].unpersist()


def drop_finished(spark: SparkSession) -> None:
    """Have the shuffles of finished steps removed from disk. Spark does that
    when the driver's objects for them are collected, and a driver with little
    to do collects late; steps that each shuffle a whole table call this between
    them. What is still referenced stays."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# Seconds after which a long fit has its finished shuffles removed again.
DROP_EVERY_S = 15.0


@contextmanager
def dropping(spark: SparkSession, every: float | None = None) -> Iterator[None]:
    """``drop_finished`` every so often within the block. A fit shuffles in each
    of its passes, and a deep tree makes hundreds of them within one call: they
    leave the disk while it runs."""
    ended = threading.Event()

    def run() -> None:
        while not ended.wait(every or DROP_EVERY_S):
            drop_finished(spark)

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()


@contextmanager
def held_audit(spark: SparkSession) -> Iterator[dict[int, str]]:
    """An initially empty dictionary that holds, after the block, what the block
    left persisted."""
    left: dict[int, str] = {}
    before = held_tables(spark)
    yield left
    left.update({i: name for i, name in held_tables(spark).items() if i not in before})
