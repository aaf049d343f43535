"""Records that keep arriving: counts in event-time windows, and exact identifier matching as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from bibspark.functions.text import filled


def arrivals(stream: DataFrame, time: str, key: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows by key and window of event time; rows later than the watermark are left out."""
    stream = stream.withColumn(time, F.col(time).cast("timestamp"))  # a watermark needs a zone
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def first_of_each(stream: DataFrame, time: str, key: str, late: str = "2 hours") -> DataFrame:
    """Rows with a filled key, each key once within the watermark."""
    stream = stream.withColumn(time, F.col(time).cast("timestamp"))
    return stream.where(filled(key)).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def accept(spark: SparkSession, stream: DataFrame, store: str, checkpoint: str, keys: tuple[str, ...] = ("DI", "UT")) -> StreamingQuery:
    """Write each batch's new records to ``store``: those whose identifiers aren't there yet.

    A batch is written to a folder of its own number, and compared with the folders of earlier batches
    only, so a batch that is run again after a failure replaces itself and gives the same rows.
    """
    stored = T.StructType([*stream.schema.fields, T.StructField("batch", T.IntegerType())])

    def one(batch: DataFrame, no: int) -> None:
        rows = batch
        for k in keys:
            w = F.row_number().over(Window.partitionBy(k).orderBy("idx"))
            rows = rows.withColumn("_n", F.when(filled(k), w).otherwise(F.lit(1))).where("_n = 1").drop("_n")
        try:
            old = spark.read.schema(stored).option("basePath", store).parquet(store).where(F.col("batch") < no)
            for k in keys:
                rows = rows.join(old.where(filled(k)).select(k).distinct(), k, "left_anti")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
        rows.select(*batch.columns).write.mode("overwrite").parquet(f"{store}/batch={no}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
