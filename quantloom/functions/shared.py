"""Results that are read more than once, kept in the folder that executors share until nothing refers to them."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

CLEANS = "spark.cleaner.referenceTracking.cleanCheckpoints"
ESTIMATE_BITS = 1024


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names; a temporary one where nothing names one and all is on one machine, as in tests.

    What is in it goes when no DataFrame that reads it is left (Spark's cleaner, unless the session says otherwise), the rest when Python ends.
    A folder that was set before is its owner's and stays.
    """
    context = spark.sparkContext
    conf = context._jsc.sc().conf()
    if not conf.contains(CLEANS):
        conf.set(CLEANS, "true")
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", context.master):
            raise ValueError("executors need a shared folder: name it in spark.checkpoint.dir")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="quantloom-"))
        atexit.register(_remove, context, context.getCheckpointDir() if named else context.getCheckpointDir().rpartition("/")[0])
    return context.getCheckpointDir()


def _remove(context: SparkContext, folder: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone, and with it a session's last chance
        at = context._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: it cuts the lineage and outlives executors.

    Spark takes the product of its sides' sizes for the size of a join, and a checkpoint hands that estimate on. In rounds that join what the
    round before gave, the number gets some times as long each round, until it fills the driver's memory. One of more than ``ESTIMATE_BITS``
    bits, which no table has, is given up for Spark's own of an unknown size; rows are the same.
    """
    spark = df.sparkSession
    checkpoint_folder(spark)
    kept = df.checkpoint()
    execution = kept._jdf.queryExecution()
    with contextlib.suppress(ValueError):  # over 4,300 digits Python doesn't read a number
        if execution.optimizedPlan().stats().sizeInBytes().bit_length() <= ESTIMATE_BITS:
            return kept
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(execution.toRdd(), kept._jdf.schema(), False), spark)
