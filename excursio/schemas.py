"""Schemas of the relations; none of them is inferred."""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T

NODES = (
    "ARRAY<STRUCT<pre: INT, size: INT, parent: INT, depth: INT, n_children: INT, "
    "prev_tag: STRING, tag: STRING, attrs: MAP<STRING, STRING>, t0: INT, t1: INT>>"
)

API_RESPONSES = (
    "page_id BIGINT, seq BIGINT, url STRING, status INT, content_type STRING, body STRING"
)

BOOKABLE_DATES = "ARRAY<STRUCT<date: STRING, minPrice: DOUBLE, capacity: DOUBLE>>"

# Raw record of one page. Fields no page rule sets (tags, rating, timings, rules,
# thingsToDo, location.text, distance, category) can still come with JSON records.
RAW = f"""
    page_id BIGINT, url STRING, slug STRING,
    breadcrumbs ARRAY<STRUCT<text: STRING, url: STRING>>,
    hero STRUCT<name: STRING, city: STRING, category: STRING, coverImage: STRING,
        images: ARRAY<STRUCT<url: STRING, alt: STRING, title: STRING, caption: STRING,
            type: STRING, width: INT, height: INT, sequence: INT>>,
        heroImage: STRING, tags: ARRAY<STRING>, rating: STRING>,
    gallery ARRAY<STRUCT<url: STRING, alt: STRING, title: STRING, caption: STRING,
        type: STRING, width: INT, height: INT, sequence: INT>>,
    description STRUCT<`full`: STRING>,
    highlights ARRAY<STRING>, inclusions ARRAY<STRING>, exclusions ARRAY<STRING>,
    terms ARRAY<STRING>,
    ticketPrices STRUCT<prices: ARRAY<STRING>, currency: STRING, packageName: STRING,
        packageDetails: ARRAY<STRING>, minPrice: DOUBLE, capacity: DOUBLE,
        bookableDates: {BOOKABLE_DATES}>,
    location STRUCT<address: STRING, googleMapsLink: STRING, latitude: DOUBLE,
        longitude: DOUBLE, text: STRING>,
    nearbyAttractions ARRAY<STRUCT<name: STRING, url: STRING, image: STRING, price: STRING,
        location: STRING, rating: STRING, distance: STRING, category: STRING>>,
    faq ARRAY<STRUCT<question: STRING, answer: STRING>>,
    tabs ARRAY<STRING>,
    seo STRUCT<title: STRING, metaDescription: STRING, canonical: STRING, robots: STRING,
        language: STRING, themeColor: STRING, openGraph: MAP<STRING, STRING>,
        twitterCard: MAP<STRING, STRING>,
        favicons: ARRAY<STRUCT<rel: STRING, href: STRING, sizes: STRING>>>,
    structuredData MAP<STRING, VARIANT>,
    sections ARRAY<STRING>,
    metadata STRUCT<scrapedAt: STRING, pageUrl: STRING, totalImages: INT>,
    timings STRUCT<openingTime: STRING, closingTime: STRING, closedDays: STRING,
        lastEntry: STRING, bestVisitingTime: STRING>,
    rules ARRAY<STRING>, thingsToDo ARRAY<STRING>
"""

# Raw record as it stands in JSON: a field whose JSON type decides the result is
# read as VARIANT and settled afterwards.
RAW_JSON = """
    url STRING, slug STRING,
    breadcrumbs ARRAY<STRUCT<text: STRING, url: STRING>>,
    hero STRUCT<name: STRING, city: STRING, category: STRING, coverImage: STRING,
        images: ARRAY<VARIANT>, heroImage: STRING, tags: ARRAY<STRING>, rating: STRING>,
    gallery ARRAY<VARIANT>,
    description STRUCT<`full`: STRING>,
    highlights ARRAY<STRING>, inclusions ARRAY<STRING>, exclusions ARRAY<STRING>,
    terms ARRAY<STRING>,
    ticketPrices STRUCT<prices: ARRAY<STRING>, currency: STRING, packageName: STRING,
        packageDetails: ARRAY<STRING>, minPrice: VARIANT, capacity: VARIANT,
        bookableDates: ARRAY<STRUCT<date: STRING, minPrice: VARIANT, capacity: VARIANT>>>,
    location STRUCT<address: STRING, googleMapsLink: STRING, latitude: VARIANT,
        longitude: VARIANT, text: STRING>,
    nearbyAttractions ARRAY<STRUCT<name: STRING, url: STRING, image: STRING, price: STRING,
        location: STRING, rating: STRING, distance: STRING, category: STRING>>,
    faq ARRAY<STRUCT<question: STRING, answer: STRING>>,
    tabs ARRAY<STRING>,
    seo STRUCT<title: STRING, metaDescription: STRING, canonical: STRING, robots: STRING,
        language: STRING, themeColor: STRING, openGraph: MAP<STRING, STRING>,
        twitterCard: MAP<STRING, STRING>,
        favicons: ARRAY<STRUCT<rel: STRING, href: STRING, sizes: STRING>>>,
    structuredData MAP<STRING, VARIANT>,
    sections ARRAY<STRING>,
    metadata STRUCT<scrapedAt: STRING, pageUrl: STRING, totalImages: INT>,
    timings STRUCT<openingTime: STRING, closingTime: STRING, closedDays: STRING,
        lastEntry: STRING, bestVisitingTime: STRING>,
    rules ARRAY<STRING>, thingsToDo ARRAY<STRING>,
    apiResponses MAP<STRING, VARIANT>
"""


@cache
def parsed(ddl: str) -> T.StructType:
    """Schema object of one of the texts above (needs a running session)."""
    return T.StructType.fromDDL(ddl)


def raw_field(name: str) -> T.DataType:
    return parsed(RAW)[name].dataType
