"""Daily landing as a file stream: new files in, folders by key and run date out.

The feeds come in as files over time, and one run takes what is new since the last. Below a
folder every micro-batch has one of its own, named by its number: a batch that is repeated after a
failure replaces just what it wrote before, and later batches add to a folder. What is in a folder
does not depend on where batches are cut. The numbers count on with the checkpoint, which belongs
to the landing path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.pick import Keys, as_list
from ..sources.write import land

BATCH = "batch"


def follow_files(spark: SparkSession, inbox: str, schema: T.StructType, fmt: str = "json",
                 **options: object) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).options(**options).load(inbox)


def land_arrivals(arrivals: DataFrame, path: str, checkpoint: str, partition_by: Keys,
                  fmt: str = "json") -> StreamingQuery:
    """Land all files that are there and stop. ``checkpoint`` is a folder all machines share."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        land(batch.withColumn(BATCH, F.lit(batch_id)), path, [*as_list(partition_by), BATCH], fmt=fmt)

    return (
        arrivals.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
