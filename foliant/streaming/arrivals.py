"""New article files as a stream, for loads that run again and again.

Batch loads restart by skipping what is stored.  A file stream
keeps the same promise: its checkpoint remembers files, and each small batch
appends only keys the table does not hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import insert_missing
from ..session import shared_folder


def stream_missing(
    spark: SparkSession,
    name: str,
    source: str,
    target: str,
    schema: str,
    keys: list[str],
    order: list[str],
) -> StreamingQuery:
    """Append rows of new parquet files whose key is not in the target, then stop.

    The name identifies the load: its progress is kept under this name in the
    shared folder of the session.
    """

    def load(batch: DataFrame, _: int) -> None:
        stored = batch.sparkSession.read.schema(schema).parquet(target)
        insert_missing(stored, batch, keys, order).write.mode("append").parquet(target)

    folder = shared_folder(spark)
    return (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{folder}/{name}")
        .trigger(availableNow=True)
        .start()
    )
