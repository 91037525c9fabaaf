"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  ANSI mode stays on (Spark 4 default): all
# casts in this package are try_cast and all divisions try_divide.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # HotSpot never compiles a method of more bytecode than this: larger generated ones would be interpreted row by row
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, *, app: str = "orrery", shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package's settings.

    On a cluster ``master`` stays None so spark-submit decides; local runs
    and tests pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf.setdefault("spark.driver.memory", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (local runs, tests) a scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="orrery-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def limit_methods(spark: SparkSession) -> None:
    """Hold generated methods to what HotSpot compiles, in sessions that others have built as well.

    Validation and the rows of the feature grid are wide expressions; fused
    into one method they pass the limit, split by operator they do not.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > int(SESSION_CONF[name]):
        spark.conf.set(name, SESSION_CONF[name])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (for staged tables,
    streaming checkpoints and sinks)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str = "stage"):
    """Cut lineage: checkpoint ``df`` to the shared checkpoint folder, computing it once.

    ``DataFrame.checkpoint()`` alone evaluates an unpersisted plan twice (the
    action, then the RDD write); persisting first lets the write read the
    cached blocks.  The cache is dropped once the checkpoint files exist.
    ``name`` labels the stage for logs.
    """
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def staged_table(df, name: str = "stage"):
    """Cut lineage like :func:`materialize`, as a Parquet table under the checkpoint folder.

    Written once and compressed; later plans read only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
