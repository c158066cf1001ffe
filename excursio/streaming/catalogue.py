"""The page-by-page part of the catalogue over a stream of captured pages.

Raw records and the linked records need no state, so the batch functions run on
a stream as they are. Reports, collisions and roll-ups stay batch jobs over the
written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from excursio.operators import records
from excursio.operators.page_fields import extract
from excursio.settings import Settings
from excursio.sources.pages import page_nodes

RECORDS = {
    "activity": records.activity,
    "plan": records.plan,
    "gallery": records.gallery,
    "bundle": records.bundle,
}


def page_stream(spark: SparkSession, location: str, files_per_trigger: int = 1000) -> DataFrame:
    """Pages from files as they arrive."""
    return (
        spark.readStream.schema("page_id BIGINT, url STRING, html STRING")
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(location)
    )


def record_stream(pages: DataFrame, kind: str, settings: Settings = Settings()) -> DataFrame:
    """Linked records of a kind from a stream of pages."""
    return RECORDS[kind](extract(page_nodes(pages), settings), settings)


def checkpoint_place(spark: SparkSession, name: str, checkpoint: str | None = None) -> str:
    """Where a stream keeps its progress: below the cluster's shared checkpoint folder unless a place is given."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    place = checkpoint or (f"{shared}/{name}" if shared else None)
    if place is None:
        raise ValueError("give a checkpoint place or set spark.checkpoint.dir")
    return place


def write_stream(records_df: DataFrame, location: str, name: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append a record stream to a Parquet table until the input is used up."""
    place = checkpoint_place(records_df.sparkSession, name, checkpoint)
    return (
        records_df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", place)
        .option("path", location)
        .trigger(availableNow=True)
        .queryName(name)
        .start()
    )
