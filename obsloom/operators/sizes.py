"""Frames whose bytes Spark knows, and frames kept for repeated passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

from obsloom.session import work_path

#: Partitions of a frame that is fitted repeatedly, at least; a fixed number, so that a fit comes out the
#: same on any cluster.
FIT_PARTITIONS = 8


def measured(df: DataFrame) -> DataFrame:
    """``df`` written to the shared work folder and read again.

    Spark then plans a join by the bytes of the files: below its broadcast threshold the side is sent to
    every executor, beyond it both sides are shuffled. For sides that an aggregate has made small, and for rows
    that are dear to make and read more than once.
    """
    path = work_path(df.sparkSession, "side")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, partitions: int = FIT_PARTITIONS) -> DataFrame:
    """``df`` persisted for an iterative fit, in at least so many partitions.

    The caller unpersists it. Large inputs have more partitions anyway and are not moved.
    """
    wide = df if df.rdd.getNumPartitions() >= partitions else df.repartition(partitions)
    return wide.persist(StorageLevel.MEMORY_AND_DISK)
