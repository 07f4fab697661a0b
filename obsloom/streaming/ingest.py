"""Message streams into bronze and silver with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from obsloom.plans.medallion import KEY, to_silver
from obsloom.sources.tables import load_newest


def read_messages(
    spark: SparkSession, source: str, schema: T.StructType, fmt: str = "text", options: Mapping[str, str] | None = None
) -> DataFrame:
    """A stream of JSON messages as columns of ``schema``, plus where they came from.

    ``fmt`` is ``text`` for a folder of files with one message per line, or ``kafka`` for a topic where
    that connector is installed. A message that is no JSON gives NULL columns and keeps its text.
    """
    reader = spark.readStream.format(fmt).options(**dict(options or {}))
    if fmt == "kafka":
        raw = reader.option("subscribe", source).load()
        text, origin = F.col("value").cast("string"), F.concat_ws("/", "topic", "partition", "offset")
    else:
        raw = reader.load(source)
        text, origin = F.col("value"), F.col("_metadata.file_path")
    parsed = raw.select(F.from_json(text, schema).alias("m"), text.alias("raw_message"), origin.alias("source_file"))
    return parsed.select("m.*", "raw_message", "source_file").withColumn("bronze_ingested_at", F.current_timestamp())


def append_stream(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append to a Parquet folder, exactly once per message."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.outputMode("append").start()


def each_batch(
    stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Run ``work`` per micro-batch; it must be repeatable, as a batch may come again after a failure.

    The batch is kept while ``work`` runs, so that several passes read the source once.
    """

    def once(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            work(rows, batch_id)
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def silver_stream(bronze: DataFrame, silver: str, checkpoint: str, variant: str = "v2") -> StreamingQuery:
    """Bronze stream to the silver folder; a repeated batch changes nothing, a later one corrects."""

    def work(batch: DataFrame, batch_id: int) -> None:
        rows = to_silver(batch, variant)
        order = [c for c in rows.columns if c not in ("update_at", *KEY)]
        load_newest(rows, silver, KEY, "time", order, f"batch-{batch_id:012}")

    return each_batch(bronze, work, checkpoint)


def dedupe_stream(stream: DataFrame, key: list[str], time: str, late_by: str) -> DataFrame:
    """The first message per key; copies are known for ``late_by`` behind the newest event time.

    State is spread by key over the shuffle partitions, and a key holds one entry however many copies
    arrive.
    """
    if isinstance(stream.schema[time].dataType, T.TimestampNTZType):
        stream = stream.withColumn(time, F.col(time).cast("timestamp"))
    return stream.withWatermark(time, late_by).dropDuplicatesWithinWatermark(key)
