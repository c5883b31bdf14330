"""Incremental upsert of arriving documents, the streaming form of the batch upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The last row of each key; of rows alike in order, that of the later ``_batch`` if there is such a column."""
    by = [F.col(order).desc()] + [F.col("_batch").desc()] * ("_batch" in df.columns)
    w = Window.partitionBy(*key).orderBy(*by)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def upsert_stream(stream: DataFrame, path: str, key: Sequence[str], order: str, checkpoint: str):
    """Keeps below ``path`` one version for each batch, the last of which holds the newest row of each key, whenever it arrives.

    A batch writes a new version before any reader can see it, and a repeated batch writes
    the same version again, so a failed batch leaves no half-written table.  The version before
    the last stays, for readers and repeats; earlier ones go.
    """

    def apply(batch: DataFrame, number: int) -> None:
        new, spark = latest(batch, key, order).withColumn("_batch", F.lit(1)), batch.sparkSession
        if number:
            old = spark.read.schema(batch.schema).parquet(f"{path}/v={number - 1}").withColumn("_batch", F.lit(0))
            new = latest(old.unionByName(new), key, order)
        new.drop("_batch").write.mode("overwrite").parquet(f"{path}/v={number}")
        if number > 1:
            gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/v={number - 2}")
            gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).start()
