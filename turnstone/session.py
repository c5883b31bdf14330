"""Session defaults."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "turnstone", **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; the caller's settings win."""
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    builder = SparkSession.builder.appName(app)
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint: what reads it several times computes it once, and plans stay small."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        root = df.sparkSession.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not root and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(root or "file://" + tempfile.mkdtemp(prefix="turnstone-"))
    return df.checkpoint()
