"""Incremental ingest: new release files are merged into the day folders as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.sources import store


def ingest(spark: SparkSession, incoming: str, root: str, checkpoint: str) -> int:
    """Merge all files in incoming (Parquet, the store's columns) that no earlier run has seen; the batches that ran.

    Each micro-batch is an upsert by day and address that rewrites only days which change, so running again over the same
    files changes nothing, and late rows land in their own day. State is the stream's checkpoint and the store itself.
    """
    ran = []

    def merge(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("publish_date", F.col("publish_date").cast("date"))
        days = batch.filter("publish_date IS NOT NULL").select(F.col("publish_date").alias("day")).distinct()
        there = store.read_day_folders(spark, root) if store.has_files(spark, f"{root}/day=*") else spark.createDataFrame([], f"{store.SCHEMA}, day date")
        old = there.join(days, "day", "left_semi")
        old = old.select(*(F.col(c).cast("date").alias(c) if c == "publish_date" else F.coalesce(F.col(c), F.lit("")).alias(c) if c == "publish_time" else c for c in store.COLUMNS))
        made = store.merge(old.withColumn("ordinal", F.monotonically_increasing_id()), batch)
        path = f"{checkpoint}-merged/{number}"  # the days that are read are about to be overwritten
        made.write.mode("overwrite").parquet(path)
        made = spark.read.schema(made.schema).parquet(path)
        if not made.isEmpty():
            store.write_days(made, root)
        ran.append(number)

    schema = store.SCHEMA
    stream = spark.readStream.schema(schema).parquet(incoming)
    run = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return len(ran)
