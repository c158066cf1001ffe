"""Captured API responses: selection, latest per key, ticket pricing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from excursio.functions.sql import Sql, quote, struct, when
from excursio.functions.text import contains, contains_any, json_or_null, repeated_keys
from excursio.functions.urls import response_key
from excursio.schemas import BOOKABLE_DATES, raw_field
from excursio.settings import API_DATES_KEY, API_KEY_JUNK, API_URL_JUNK, Settings


def wanted(responses: DataFrame, *also: str) -> DataFrame:
    """JSON responses of wanted addresses; ``.js`` in an address also refuses ``.json`` files."""
    repeated_keys(responses.sparkSession)
    rows = responses.filter(
        F.expr(f"contains(content_type, 'application/json') AND NOT {contains_any('url', API_URL_JUNK)}")
    )
    return rows.select(
        "page_id",
        "seq",
        "url",
        "status",
        F.expr(response_key("url")).alias("key"),
        F.expr(json_or_null("body")).alias("data"),
        *also,
    )


def readable(rows: DataFrame) -> DataFrame:
    """Those of the wanted responses that are kept."""
    return rows.filter("key IS NOT NULL AND data IS NOT NULL")


def unreadable(rows: DataFrame) -> DataFrame:
    """The others, with the reason."""
    reason = "CASE WHEN data IS NULL THEN 'body is not JSON or too large' ELSE 'address without host' END"
    return rows.filter("key IS NULL OR data IS NULL").select("page_id", "seq", "url", F.expr(reason).alias("reason"))


def api_keep(responses: DataFrame, *also: str) -> DataFrame:
    """Readable JSON responses of wanted addresses, with ``key`` and ``data``, and other columns named."""
    return readable(wanted(responses, *also))


def api_rejects(responses: DataFrame) -> DataFrame:
    """Wanted responses that ``api_keep`` leaves out, with the reason."""
    return unreadable(wanted(responses))


def api_latest(kept: DataFrame) -> DataFrame:
    """Last response of each page and key; ``pos`` is where the key came up first.

    Aggregated before the shuffle, so a page that holds many captures of one key
    sends one row per task.
    """
    return (
        kept.groupBy("page_id", "key")
        .agg(
            F.min("seq").alias("pos"),
            F.max_by(F.struct("seq", "url", "status", "data"), "seq").alias("r"),
        )
        .select("page_id", "key", "pos", "r.seq", "r.url", "r.status", "r.data")
    )


def api_strip(latest: DataFrame) -> DataFrame:
    """Without tracking and address look-ups."""
    return latest.filter(f"NOT {contains_any('key', API_KEY_JUNK)}")


def bookable_dates(latest: DataFrame, *also: str) -> DataFrame:
    """Non-empty date lists, one row per response that carries one, with other columns named."""
    numeric = "rlike(schema_of_variant({0}), '^(BIGINT|DECIMAL|DOUBLE|FLOAT)')"

    def number(field: str) -> str:
        value = f"variant_get(d, '$.{field}')"
        return (
            f"CASE WHEN {numeric.format(value)} "
            f"THEN try_variant_get(d, '$.{field}', 'double') END"
        )

    dates = (
        "transform(try_variant_get(data, '$.data', 'array<variant>'), d -> named_struct("
        "'date', try_variant_get(d, '$.date', 'string'), "
        f"'minPrice', {number('minPrice')}, 'capacity', {number('capacity')}))"
    )
    return (
        latest.filter(contains("key", API_DATES_KEY))
        .select("page_id", "pos", F.expr(f"CAST({dates} AS {BOOKABLE_DATES})").alias("dates"), *also)
        .filter("size(dates) > 0")
    )


def api_pricing(latest: DataFrame) -> DataFrame:
    """Ticket pricing of a page: the list of the last dates key, price and
    capacity of its first entry (not the lowest)."""
    return (
        bookable_dates(latest)
        .groupBy("page_id")
        .agg(F.max_by("dates", "pos").alias("dates"))
        .select(
            "page_id",
            F.expr("get(dates, 0).minPrice").alias("minPrice"),
            F.expr("get(dates, 0).capacity").alias("capacity"),
            F.col("dates").alias("bookableDates"),
        )
    )


PRICING = ("minPrice", "capacity", "bookableDates")


def priced(tickets: Sql, pricing: Sql, settings: Settings = Settings()) -> Sql:
    """Ticket prices of a page with those of its responses, where there are any."""
    kind = raw_field("ticketPrices").simpleString()
    merged = struct(prices=f"{tickets}.prices", currency=quote(settings.currency), packageName=f"{tickets}.packageName",
                    packageDetails=f"{tickets}.packageDetails", **{f: f"{pricing}.{f}" for f in PRICING})
    return f"CAST({when(f'{pricing} IS NULL', tickets, merged)} AS {kind})"


def merge_pricing(
    raw: DataFrame, pricing: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Put API pricing into the raw records it belongs to.

    Both sides hold one row per page, so no key can be skewed; the optimizer
    broadcasts the pricing when its size allows. Beyond that it moves raw records:
    ``price_pages`` over tables in buckets moves none.
    """
    p = pricing.select("page_id", F.struct(*PRICING).alias("_pricing"))
    return (
        raw.join(p, "page_id", "left")
        .withColumn("ticketPrices", F.expr(priced("ticketPrices", "_pricing", settings)))
        .select(*raw.columns)
    )


def price_pages(pages: DataFrame, pricing: DataFrame) -> DataFrame:
    """Captured pages with their API pricing in a column ``_pricing``, which ``extract`` merges.

    For tables that lie in as many buckets by page (``save_bucketed``): nothing moves then,
    and a task holds the pricing of one bucket, not its pages.
    """
    p = pricing.select("page_id", F.struct(*PRICING).alias("_pricing"))
    return pages.join(p.hint("shuffle_hash"), "page_id", "left")
