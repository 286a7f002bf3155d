"""Session factory and the shared-folder convention."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "quillmere", cores: str | int = "*", **conf: str) -> SparkSession:
    """A session with the settings the plans assume (UTC, AQE).

    What the launcher has set stays: a master given to it is kept, and only a session without
    one becomes local, with the few shuffle partitions and the driver memory that suit one machine.
    """
    given = SparkConf()
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # a checkpoint goes with the frame that holds it
    }
    if not given.contains("spark.master"):
        settings |= {"spark.master": f"local[{cores}]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    settings = {k: v for k, v in settings.items() if not given.contains(k)} | {k.replace("__", "."): v for k, v in conf.items()}
    spark = SparkSession.builder.appName(app).config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Clusters name one; only a session without the setting (tests, local runs) gets a
    temporary folder, which is machine-local and therefore refused on a real cluster.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        named = os.path.join(tempfile.gettempdir(), f"quillmere-checkpoints-{os.getuid()}")
    spark.sparkContext.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so a lost executor only costs a re-read."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_unused(spark: SparkSession) -> None:
    """Collect the driver's garbage, so that shuffle files and checkpoints that no frame needs any more leave the disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
