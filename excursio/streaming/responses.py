"""Captured responses as a stream: the latest of each key, and pages with their ticket pricing.

Two ways, for two needs. ``merge_latest`` keeps a table of the last response of every page and key, whenever it
comes in; it needs no event time and loses nothing. ``priced_stream`` joins pages and
pricing while both flow, for captures that carry the time of their page load, and gives a page up as
one without pricing once the watermark has passed it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from excursio.operators import responses
from excursio.sources.sinks import merge_rows, merged_rows
from excursio.streaming.catalogue import checkpoint_place

RESPONSES = "page_id BIGINT, seq BIGINT, url STRING, status INT, content_type STRING, body STRING"
LATEST = "page_id BIGINT, key STRING, pos BIGINT, seq BIGINT, url STRING, status INT, data VARIANT"
#: The time of the page load, which a page and its responses share.
LOADED = "captured_at"


def response_stream(spark: SparkSession, location: str, files_per_trigger: int = 1000, timed: bool = False) -> DataFrame:
    """Captured responses from Parquet files as they arrive; ``timed`` with the time of their page load."""
    schema = f"{RESPONSES}, {LOADED} TIMESTAMP" if timed else RESPONSES
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(location)


def merge_latest(latest: DataFrame, location: str, buckets: int | None = None) -> None:
    """Put the latest responses of a part of the captures (``api_latest``) into the table of all.

    First position and last response are a minimum and a maximum: parts may come in any order and any number of
    times.
    """
    def combine(both: DataFrame) -> DataFrame:
        # the last of equal sequence numbers is the new one, which a repetition does not change
        last = F.max_by(F.struct("seq", "url", "status", "data"), F.struct("seq", "new"))
        return both.groupBy("bucket", "page_id", "key").agg(F.min("pos").alias("pos"), last.alias("r")).select(
            "page_id", "key", "pos", "r.*", "bucket")

    merge_rows(latest, location, ["page_id"], combine, buckets)


def latest_table(spark: SparkSession, location: str) -> DataFrame:
    """The table that ``merge_latest`` keeps, as ``api_latest`` gives it for all captures; empty if there is none."""
    rows = merged_rows(spark, location, LATEST)
    return spark.createDataFrame([], LATEST) if rows is None else rows


def write_latest(captured: DataFrame, location: str, name: str, checkpoint: str | None = None, buckets: int | None = None) -> StreamingQuery:
    """Keep the table of latest responses up to date with a stream, until the input is used up.

    No state is held between batches and no watermark drops what comes late: a batch is reduced to
    its own latest responses and merged into the buckets it touches. A batch that is repeated
    after a failure changes nothing.
    """
    def run(batch: DataFrame, _: int) -> None:
        merge_latest(responses.api_latest(responses.api_keep(batch)), location, buckets)

    return (
        captured.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_place(captured.sparkSession, name, checkpoint))
        .trigger(availableNow=True).queryName(name).start()
    )


def pricing_stream(captured: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Ticket pricing of every page load, as ``api_pricing`` gives it for the load's responses.

    captured: a stream with ``captured_at``. A load's rows are given out, and forgotten, when the watermark has passed its time;
    responses that are later than ``delay`` are left out.
    """
    rows = responses.api_keep(captured.withWatermark(LOADED, delay), LOADED)
    load = ["page_id", LOADED]
    last = rows.groupBy(*load, "key").agg(F.min("seq").alias("pos"), F.max_by("data", "seq").alias("data"))
    dates = responses.bookable_dates(last, LOADED)
    return dates.groupBy(*load).agg(F.max_by("dates", "pos").alias("dates")).select(
        *load, F.expr("get(dates, 0).minPrice").alias("minPrice"), F.expr("get(dates, 0).capacity").alias("capacity"), F.col("dates").alias("bookableDates"))


def priced_stream(pages: DataFrame, pricing: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Pages with the pricing of their load in a column ``_pricing``, which ``extract`` merges; null where there was none.

    Both sides wait in state until the watermark passes them, so pages should come as
    narrow as the next step allows, and the state store should be one on disk
    (``spark.sql.streaming.stateStore.providerClass``) where loads are many.
    """
    p = pricing.select(
        F.col("page_id").alias("_page"), F.col(LOADED).alias("_loaded"), F.struct(*responses.PRICING).alias("_pricing"))
    joined = pages.withWatermark(LOADED, delay).join(p, F.expr(f"page_id = _page AND {LOADED} = _loaded"), "left_outer")
    return joined.drop("_page", "_loaded")
