"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
LOCAL_CONF = "spark.wardlake.localDir"


def build_session(app_name: str = "wardlake", **conf: str) -> SparkSession:
    """A session with the settings the jobs assume; cluster sizing is left to spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        # also the size of the files a rebalanced write leaves
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
        # the JVM does not compile longer methods; Spark then splits wide projections instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        # "06" in month=06 must stay text
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder of its own: on a cluster that
    folder would exist on one machine and vanish with it.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        base = spark.conf.get(LOCAL_CONF, None)
        if not base:
            base = tempfile.mkdtemp(prefix="wardlake-")
            spark.conf.set(LOCAL_CONF, base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder, never reused between runs."""
    return f"{shared_dir(spark)}/wardlake/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, outlives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where the frame has a column of that name."""
    taken = {c.lower() for c in df.columns}
    result = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        result.append(name)
    return result


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give the context a checkpoint folder where the cluster has not set one."""
    if not spark.conf.get(CHECKPOINT_CONF, None):
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
