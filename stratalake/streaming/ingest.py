"""Landing to bronze as a stream: the checkpoint is the list of seen files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from stratalake.sources.files import LISTING, load_files, wanted
from stratalake.sources.storage import matching
from stratalake.sources.tables import LEVEL, publish, versions

STREAM = "stream="


def append_stream(
    spark: SparkSession, landing: str, bronze: str, checkpoint: str, schema: T.StructType, max_files: int = 1000
) -> StreamingQuery:
    """All new files, appended exactly once by Spark's file sink, then stop.

    For feeds whose files all have the declared types.
    """
    files = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files)
        .parquet(landing)
    )
    return (
        files.writeStream.format("parquet")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_stream(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    schema: T.StructType | None,
    exclude: Sequence[str] = (),
    max_files: int = 1000,
    on_missing: str = "error",
) -> StreamingQuery:
    """As ``append_stream`` for files whose types drift.

    The stream carries file names only, ``max_files`` per batch at most. Each
    batch is read by groups of equal types and published under the identity of
    stream and batch; a batch that is replayed after a failure finds itself
    complete and is skipped.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select("path")
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        target = f"{bronze}/{STREAM}{stream}"
        paths = [row.path for row in batch.collect()]
        if paths and batch_id not in versions(session, target):
            publish(load_files(session, paths, schema, on_missing), target, version=batch_id)

    return (
        wanted(files, exclude)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_stream_bronze(spark: SparkSession, bronze: str, schema: T.StructType) -> DataFrame:
    """All complete batches of all streams that wrote below ``bronze``."""
    done = matching(spark, bronze, f"{STREAM}*/{LEVEL}=*/_SUCCESS")
    paths = [f"{bronze.rstrip('/')}/{stream}/{version}" for stream, version, _ in done]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", bronze).parquet(*paths).select(*schema.names)
