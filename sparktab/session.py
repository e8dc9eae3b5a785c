"""Session helpers: a local session for tests and the checkpoint-folder rule."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every sparktab job assumes; cluster deployments pass them via spark-submit.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sparktab") -> SparkSession:
    """Local session for tests and the bench; clusters build their own session."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.driver.memory", os.environ.get("SPARKTAB_DRIVER_MEM", "16g"))
          .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names the folder; we only pick one ourselves when it is unset
    and the master is local (tests).  On a cluster an unset folder is an error:
    a machine-local temp folder would not survive executor loss.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    d = tempfile.mkdtemp(prefix="sparktab-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return d


def materialised(df):
    """``df`` computed once into the shared checkpoint folder, for jobs that read it several times."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
