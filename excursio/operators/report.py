"""Run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LISTS = ("highlights", "inclusions", "exclusions", "terms", "faq", "nearbyAttractions")


def page_report(raw: DataFrame, responses: DataFrame | None = None) -> DataFrame:
    """Counts and headline values of each raw record.

    ``responses`` are the captured responses that stay in the record; they are
    counted per page before the join.
    """
    counted = raw.select(
        "page_id",
        "slug",
        F.col("hero.name").alias("name"),
        F.col("hero.city").alias("city"),
        F.col("hero.category").alias("category"),
        F.expr("coalesce(size(gallery), 0)").alias("n_images"),
        *[F.expr(f"coalesce(size({c}), 0)").alias(f"n_{c.lower()}") for c in _LISTS],
        F.expr("array_join(tabs, ', ')").alias("tabs"),
        F.expr("array_join(sections, ', ')").alias("sections"),
        F.col("ticketPrices.minPrice").alias("min_price"),
        F.col("location.latitude").alias("latitude"),
        F.col("location.longitude").alias("longitude"),
    )
    if responses is None:
        return counted.withColumn("n_responses", F.lit(0).cast("bigint"))
    n = responses.groupBy("page_id").agg(F.count("*").alias("n_responses"))
    return counted.join(n, "page_id", "left").withColumn(
        "n_responses", F.coalesce("n_responses", F.lit(0).cast("bigint"))
    )


def catalogue_totals(report: DataFrame) -> DataFrame:
    """Totals by city and category, by city, and overall."""
    return report.rollup("city", "category").agg(
        F.grouping_id().alias("level"),
        F.count("*").alias("pages"),
        F.sum("n_images").alias("images"),
        F.min("min_price").alias("min_price"),
        F.max("min_price").alias("max_price"),
    )


def bundle_report(bundle: DataFrame) -> DataFrame:
    """Headline values of each bundle."""
    return bundle.select(
        "page_id",
        F.col("activity.name").alias("name"),
        F.col("activity.id").alias("activity_id"),
        F.col("metadata.total_plans").alias("n_plans"),
        F.expr("get(plans, 0).id").alias("plan_id"),
        F.col("metadata.total_gallery_images").alias("n_images"),
        F.expr("array_join(activity.category, ',')").alias("category"),
        F.col("activity.city").alias("city"),
        F.col("activity.country").alias("country"),
    )
