"""From captured pages and responses to the written catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from excursio.operators import records, responses
from excursio.operators.page_fields import extract
from excursio.operators.publish import outbox
from excursio.operators.report import catalogue_totals, page_report
from excursio.settings import Settings
from excursio.sources import scratch
from excursio.sources.pages import page_nodes, page_rejects, read_pages, spread
from excursio.sources.records import read_responses
from excursio.sources.sinks import write_bundles, write_table


def raw_records(
    pages: DataFrame, captured: DataFrame | None = None, settings: Settings = Settings()
) -> DataFrame:
    """Raw records of pages, with ticket pricing from their API responses."""
    raw = extract(page_nodes(pages), settings)
    if captured is None:
        return raw
    latest = responses.api_latest(responses.api_keep(captured))
    return responses.merge_pricing(raw, responses.api_pricing(latest), settings)


def build_catalogue(
    spark: SparkSession, pages_at: str, out: str, responses_at: str | None = None,
    settings: Settings = Settings(), by_slug: bool = False, partitions: int | None = None,
) -> None:
    """Write raw records, the three linked tables, bundles, requests and reports.

    Pages are parsed once and records worked out once: raw records are written
    first, bundles from them next, and everything else reads those two back with
    only the columns it needs. So a lost executor costs tasks, not the work
    before them. ``out`` must be storage that all executors share. ``partitions``
    deals the pages out first, for inputs of few splits.
    """
    pages = read_pages(spark, pages_at)
    captured = read_responses(spark, responses_at) if responses_at else None
    write_table(page_rejects(pages), f"{out}/page_rejects")
    raw, kept = extract(page_nodes(spread(pages, partitions)), settings), None
    if captured is not None:
        # bodies are parsed, sorted and moved once; pricing and the kept responses read the outcome
        parsed = scratch.kept(responses.wanted(captured), "responses")
        write_table(responses.api_latest(responses.readable(parsed)), f"{out}/api_latest")
        write_table(responses.unreadable(parsed), f"{out}/api_rejects")
        latest = spark.read.parquet(f"{out}/api_latest")
        kept = responses.api_strip(latest)
        write_table(responses.api_pricing(latest), f"{out}/pricing")
        raw = responses.merge_pricing(raw, spark.read.parquet(f"{out}/pricing"), settings)
    write_table(raw, f"{out}/raw")
    raw = spark.read.parquet(f"{out}/raw")
    write_table(records.bundle(raw, settings), f"{out}/bundle")

    bundles = spark.read.parquet(f"{out}/bundle")
    for name, df in records.split_bundles(bundles).items():
        write_table(df, f"{out}/{name}")
    write_table(outbox(bundles), f"{out}/outbox")
    write_bundles(bundles, f"{out}/bundle_json", by_slug)
    report = page_report(raw, kept)
    write_table(report, f"{out}/report")
    write_table(catalogue_totals(spark.read.parquet(f"{out}/report")), f"{out}/totals")
