"""Session helpers.

The jobs never create their own cluster settings beyond what is needed to
run locally; on a cluster the session comes from the caller.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "pagelens", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint folder for lineage cuts.

    Uses the cluster's ``spark.checkpoint.dir`` (a shared folder). Only when
    the session has none (local tests) a fresh scratch folder is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster; "
                             "a machine-local folder would not survive a lost executor")
        conf = tempfile.mkdtemp(prefix="pagelens-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def release(df: DataFrame) -> None:
    """Remove the files of a checkpointed DataFrame that no later plan reads. Only the
    folder that ``checkpoint`` made for it goes."""
    rdd = df._jdf.queryExecution().analyzed().rdd()
    file = rdd.getCheckpointFile()
    if file.isDefined():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def placed(df: DataFrame, partitions: int | None = None, *by: str) -> DataFrame:
    """Checkpoint that keeps its hash partitioning (by ``by``, else as the plan leaves
    it), so that later joins on these columns do not shuffle it. An adaptive plan does
    not tell its partitioning, so this one is made without."""
    checkpoint_dir(df.sparkSession)
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return (df.repartition(partitions, *by) if by else df.select("*")).checkpoint()
    finally:
        conf.set(name, before)
