"""Queries over raw records that Spark derives from the orders table."""

from __future__ import annotations

from pyspark.sql import functions as F

from excursio.functions.sql import null, struct
from excursio.operators import linkage, publish, records, report
from excursio.schemas import RAW, parsed
from excursio.settings import Settings, WEEK
from excursio.sources import records as record_source
from excursio.sources.sinks import bundle_lines, latest_per_slug, table_lines
from excursio.workload.captured import category_sql
from excursio.workload.registry import (
    clean_sql, each_row, first_sql, hash32_sql, oracle_facts, pick, query, spark_facts, table,
)

S = Settings(provider="Demo")
_K = "CAST(o_orderkey AS <string>)"
_NONE = "CAST(NULL AS <texts>)"
_WORDS = (
    "Museum", "Art Gallery", "Old temple", "Hill Fort", "Theme Park", "City parks", "Rose garden",
    "Night Safari", "Beaches", "Island", "Ganges cruise", "Mountain", "Hill view", "Lake", "Kayak",
    "Sightseeing", "Outdoor", "Transport", "Cab", "Music", "Dinner", "Comfort Stay", "Sparkle",
    "Harbour Taxi", "Theme",
)
FACTS = f"""
    SELECT o_orderkey AS page_id, o_orderkey AS k, {_K} AS ks,
        CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE concat('place-', CAST(o_orderkey % 5000 AS <string>)) END AS slug,
        CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE concat('https://travel.example.com/x/', {_K}) END AS url,
        {pick("o_orderkey", *[f"'  {w}  No '" for w in _WORDS])} AS name_head,
        CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE concat({pick("o_orderkey", *[f"'  {w}  No '" for w in _WORDS])}, {_K}) END AS name,
        {pick("o_orderkey", "'Kolkata'", "' New  Delhi '", "''", "NULL", "'Goa'")} AS city,
        {pick("o_orderkey", "'Culture And Heritage'", "'Leisure'", "''", "NULL", "'Walks'", "'Stay'", "'Dining'")} AS category,
        {pick("o_orderkey", _NONE, "<list>(' a  b ', '', 'x')", "<list>('solo')")} AS tags,
        {pick("o_orderkey", "'4.5 of 5'", "NULL", "''", "' 3'", "'new'")} AS rating,
        CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN ''
            ELSE repeat(concat(o_orderpriority, '  visit '), CAST(1 + o_orderkey % 30 AS INT)) END AS about,
        {pick("o_orderkey", "<list>('Non-Refundable  ticket', 'Carry ID', ' ')", _NONE, "<list>('Free entry')")} AS terms,
        {pick("o_orderkey", _NONE, "<list>('No food')", _NONE, "CAST(<list>() AS <texts>)")} AS rules,
        {pick("o_orderkey", "<list>('₹ 1,234', '₹ 5')", _NONE, "<list>('₹ 1.2.3')", "<list>('free')", "<list>('')")} AS prices,
        CASE o_orderkey % 7 WHEN 0 THEN o_totalprice WHEN 1 THEN 0 ELSE NULL END AS min_price,
        {pick("o_orderkey", "'INR'", "NULL", "'USD'", "''")} AS currency,
        {pick("o_orderkey", "'Entry  Ticket'", "NULL", "''")} AS package,
        {pick("o_orderkey", _NONE, "<list>('One  day', 'Guide')", "CAST(<list>() AS <texts>)")} AS details,
        {pick("o_orderkey", "' Main  Road '", "''", "NULL")} AS address,
        {pick("o_orderkey", "NULL", "'By the river'")} AS place_text,
        CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice / 10000 END AS lat,
        {pick("o_orderkey", "'Zoo'", "' '", "NULL")} AS near_name,
        {pick("o_orderkey", "NULL", "'09:00 AM'", "' '")} AS opens,
        {pick("o_orderkey", "'05:00 PM'", "''", "NULL", "'late'")} AS closes,
        {pick("o_orderkey", "NULL", "'Monday'", "'until sunset'", "'Mon-Wed'", "'wed'", "'Tuesday & FRIDAY'", "'weds, sat'", "'Sundays'", "'thursday'")} AS closed_days,
        {pick("o_orderkey", "''", "'https://cdn.example.com/c.jpg'", "'https://cdn.example.com/site-logo.png'")} AS cover,
        {pick("o_orderkey", "'https://cdn.example.com/h.jpg'", "''", "'https://cdn.example.com/c.jpg'", "NULL")} AS hero,
        {pick("o_orderkey", "NULL", "'https://cdn.example.com/og.jpg'")} AS og,
        {pick("o_orderkey", "''", "'Title  here'", "NULL")} AS seo_title,
        {pick("o_orderkey", "''", "' Meta  text '", "NULL", "NULL")} AS seo_meta,
        {pick("o_orderkey", "NULL", "'https://travel.example.com/canon'")} AS canonical,
        CAST(o_orderkey % 9 AS INT) AS n_images,
        concat('2026-02-', lpad(CAST(1 + o_orderkey % 28 AS <string>), 2, '0'), 'T00:00:00.000Z') AS scraped
    FROM <t:orders>"""
_O = f"({oracle_facts(FACTS, 'orders')})"

# Image i of a page: repeats, an icon, a drawing and one without address.
_IMAGE_URL = (
    "CASE {i} % 6 WHEN 1 THEN 'https://cdn.example.com/h.jpg' WHEN 2 THEN concat('https://cdn.example.com/', ks, '.jpg') "
    "WHEN 3 THEN 'https://cdn.example.com/arrow-down.png' WHEN 4 THEN 'https://cdn.example.com/x.svg' "
    "WHEN 5 THEN '' ELSE 'https://cdn.example.com/map-pin.png' END"
)
_IMAGE_ALT = "CASE {i} % 4 WHEN 1 THEN '' WHEN 2 THEN 'Alt  text' WHEN 3 THEN ' ' END"
_IMAGE_CAPTION = "CASE {i} % 3 WHEN 1 THEN 'Cap' WHEN 2 THEN '' END"


def raw_from_orders(spark, sf):
    images = (
        "transform(slice(sequence(1, 9), 1, n_images), i -> "
        + struct(
            url=_IMAGE_URL.format(i="i"), alt=_IMAGE_ALT.format(i="i"), title=null("STRING"),
            caption=_IMAGE_CAPTION.format(i="i"), type=null("STRING"), width="0", height="0",
            sequence="i",
        )
        + ")"
    )
    values = {
        "page_id": "page_id", "url": "url", "slug": "slug",
        "hero": struct(
            name="name", city="city", category="category", coverImage="cover",
            images=f"slice({images}, 1, 2)", heroImage="hero", tags="tags", rating="rating",
        ),
        "gallery": images,
        "description": struct(full="about"),
        "highlights": "details", "inclusions": "terms", "exclusions": null("ARRAY<STRING>"),
        "terms": "terms", "rules": "rules", "thingsToDo": "tags",
        "ticketPrices": struct(
            prices="prices", currency="currency", packageName="package", packageDetails="details",
            minPrice="CAST(min_price AS DOUBLE)", capacity=null("DOUBLE"), bookableDates="NULL",
        ),
        "location": struct(
            address="address", googleMapsLink="canonical", latitude="lat", longitude="-lat",
            text="place_text",
        ),
        "nearbyAttractions": "array("
        + ", ".join(
            struct(name=n, url="canonical", image="og", price="NULL", location="NULL", rating="NULL",
                   distance="NULL", category="category")
            for n in ("near_name", "'  Old  pier '")
        ) + ")",
        "timings": struct(
            openingTime="opens", closingTime="closes", closedDays="closed_days", lastEntry="opens",
            bestVisitingTime="NULL",
        ),
        "seo": struct(
            title="seo_title", metaDescription="seo_meta", canonical="canonical", robots="NULL",
            language="NULL", themeColor="NULL",
            openGraph="CASE WHEN og IS NOT NULL THEN map('og:image', og) END",
            twitterCard="NULL", favicons="NULL",
        ),
        "metadata": struct(
            scrapedAt="CASE WHEN k % 5 <> 0 THEN scraped END", pageUrl="url", totalImages="0"
        ),
    }
    facts = spark_facts(FACTS, spark, sf, "orders", deal="o_orderkey")
    return facts.select(
        *[F.expr(values.get(f.name, "NULL")).cast(f.dataType).alias(f.name) for f in parsed(RAW).fields]
    )


# ---- oracle pieces -------------------------------------------------------------------

_NAME = clean_sql("name")
_KEY = first_sql("url", "slug", "CAST(page_id AS VARCHAR)")
_ID = f"(1000000 + {hash32_sql(_KEY)} % 1000000000)"
_CITY = clean_sql(first_sql("city", "'Kolkata'"))
_PARSED = (
    "TRY_CAST(nullif(regexp_extract(regexp_replace(prices[1], '[^0-9.]', '', 'g'), "
    "'^[0-9]*\\.?[0-9]*'), '') AS DOUBLE)"
)
_PRICE = f"coalesce(CAST(min_price AS DOUBLE), {_PARSED}, 0)"
_PLAN_PRICE = f"coalesce(CAST(min_price AS DOUBLE), nullif({_PARSED}, 0), 50)"
_VISITORS = clean_sql(first_sql("name", "'Experience'"))
_PLAN_NAME = clean_sql(first_sql("package", f"'Entry Ticket - ' || {_VISITORS}"))
# First gallery image of the raw record that counts for the picture chain.
_G1 = "CASE WHEN n_images > 0 THEN 'https://cdn.example.com/h.jpg' END"
_PICTURE = first_sql("hero", "cover", _G1)


def cleaned_list(x: str) -> str:
    return (
        f"array_to_string(list_filter(list_transform(coalesce({x}, CAST([] AS VARCHAR[])), "
        f"lambda t: {clean_sql('t')}), lambda t: t <> ''), '|')"
    )


def join_raw(x: str) -> str:
    return f"array_to_string(coalesce({x}, CAST([] AS VARCHAR[])), '|')"


def joined(c: str):
    return F.array_join(c, "|")


@query(
    "activity_text",
    f"""SELECT page_id, {_ID} AS id, slug, {_NAME} AS name,
        {clean_sql(f"CASE WHEN about <> '' THEN substr(about, 1, 300) || '...' ELSE {_NAME} END")} AS info,
        {clean_sql('about')} AS description,
        {clean_sql("array_to_string(terms, chr(10))")} AS additional_info,
        {clean_sql(first_sql('seo_title', _NAME))} AS meta_title,
        {clean_sql(first_sql('seo_meta', 'substr(about, 1, 160)'))} AS meta_description,
        array_to_string(coalesce(tags, CAST([] AS VARCHAR[])), ', ') AS keywords,
        {first_sql('canonical', 'url')} AS canonical_url FROM {_O}""",
)
def activity_text(spark, sf):
    a = records.activity(raw_from_orders(spark, sf), S)
    return a.select(
        "page_id", F.col("id").cast("bigint").alias("id"), "slug", "name", "info", "description",
        "additional_info", F.col("meta_data.title").alias("meta_title"),
        F.col("meta_data.description").alias("meta_description"), "meta_data.keywords",
        "meta_data.canonical_url",
    )


@query(
    "activity_category",
    f"SELECT page_id, {category_sql('category', _NAME, 'slug')} AS category FROM {_O}",
)
def activity_category(spark, sf):
    return records.activity(raw_from_orders(spark, sf), S).select(
        "page_id", F.col("category")[0].alias("category")
    )


@query(
    "activity_lists",
    f"""SELECT page_id, {cleaned_list('tags')} AS tags, {cleaned_list('tags')} AS descriptors,
        {cleaned_list('terms')} AS must_know, {cleaned_list('details')} AS highlights,
        {cleaned_list('terms')} AS inclusions, '' AS exclusions, {cleaned_list('tags')} AS itinerary,
        {cleaned_list("list_value(near_name, '  Old  pier ')")} AS pois,
        array_to_string(list_transform(list_filter(list_value(opens, closes), lambda t: t <> ''),
            lambda t: {clean_sql('t')}), '|') AS operating_hours,
        {join_raw('coalesce(rules, terms)')} AS rules, {join_raw('terms')} AS cancel_terms,
        NOT coalesce(list_contains(terms, 'Non-Refundable  ticket'), false) AS refundable FROM {_O}""",
)
def activity_lists(spark, sf):
    a = records.activity(raw_from_orders(spark, sf), S)
    names = ("tags", "descriptors", "must_know", "highlights", "inclusions", "exclusions",
             "itinerary", "pois", "operating_hours")
    return a.select(
        "page_id", *[joined(c).alias(c) for c in names],
        joined("general_policy.rules").alias("rules"),
        joined("cancellation_policy.terms").alias("cancel_terms"),
        F.col("cancellation_policy.refundable").alias("refundable"),
    )


@query(
    "activity_price",
    f"""SELECT page_id, {_PRICE} AS final_price, {_PRICE} AS payable, {first_sql('currency', "'INR'")} AS currency,
        CAST(CASE rating WHEN '4.5 of 5' THEN 4.5 WHEN ' 3' THEN 3 ELSE 0 END AS DOUBLE) AS rating FROM {_O}""",
)
def activity_price(spark, sf):
    return records.activity(raw_from_orders(spark, sf), S).select(
        "page_id", F.col("listing_price.final_price").alias("final_price"),
        F.col("listing_price.minimum_payable_price").alias("payable"),
        F.col("listing_price.currency_code").alias("currency"), "rating",
    )


@query(
    "activity_place",
    f"""SELECT page_id, {_CITY} AS city, upper(substr({_CITY}, 1, 3)) AS city_code,
        {clean_sql(first_sql('address', 'place_text', _CITY))} AS address,
        coalesce(lat, 0) AS latitude, coalesce(-lat, 0) AS longitude, coalesce(canonical, '') AS map_url,
        {first_sql(_PICTURE, 'og')} AS image_url, {first_sql('og', _PICTURE)} AS meta_image,
        coalesce(opens, '') AS opening_time, coalesce(closed_days, '') AS closed_days,
        'India' AS country, 'IND' AS country_code FROM {_O}""",
)
def activity_place(spark, sf):
    return records.activity(raw_from_orders(spark, sf), S).select(
        "page_id", "city", "city_code", "address", "latitude", "longitude", "map_url", "image_url",
        F.col("meta_data.image_url").alias("meta_image"), "schedule.opening_time",
        "schedule.closed_days", "country", "country_code",
    )


@query(
    "activity_constants",
    f"""SELECT page_id, true AS availability, false AS sold_out, false AS is_featured,
        'Instant Confirmation & Digital E-Ticket' AS delivery, 'APPROXIMATE' AS accuracy, '{{}}' AS refund,
        '{{}}' AS ratings, 'ONDC' AS source, 10000000 + {hash32_sql(f"'activity:' || {_KEY}")} % 90000000 AS product,
        '2026-01-01T00:00:00' AS created FROM {_O}""",
)
def activity_constants(spark, sf):
    return records.activity(raw_from_orders(spark, sf), S).select(
        "page_id", "availability", "sold_out", "is_featured",
        F.col("ticket_delivery_info").alias("delivery"), F.col("geo_accuracy").alias("accuracy"),
        F.to_json("refund_policy").alias("refund"), F.to_json("rating_distribution").alias("ratings"),
        "association.source", F.col("association.productId").cast("bigint").alias("product"),
        F.expr("date_format(convert_timezone('UTC', CAST(created_at AS TIMESTAMP_NTZ)), "
               "\"yyyy-MM-dd'T'HH:mm:ss\")").alias("created"),
    )


@query(
    "plan_core",
    f"""SELECT page_id, {_ID} + 100 AS id, {_ID} AS activity_id,
        {first_sql('slug', "'experience'")} || '-entry-ticket' AS slug,
        {first_sql('slug', "'experience'")} AS activity_slug, {_PLAN_NAME} AS name,
        {clean_sql(f"CASE WHEN about <> '' THEN substr(about, 1, 150) || '...' ELSE {_PLAN_NAME} END")} AS info,
        CASE WHEN len(details) > 0 THEN array_to_string(details, chr(10))
             ELSE {clean_sql(first_sql('substr(about, 1, 300)', _VISITORS))} END AS description,
        {_PICTURE} AS image_url, {category_sql('category', _NAME, 'slug')} AS category,
        {_PLAN_PRICE} AS price, 1 AS min_count, 10 AS max_count FROM {_O}""",
)
def plan_core(spark, sf):
    return records.plan(raw_from_orders(spark, sf), S).select(
        "page_id", F.col("id").cast("bigint").alias("id"),
        F.col("activity_id").cast("bigint").alias("activity_id"), "slug", "activity_slug", "name",
        "info", "description", "image_url", F.col("categories")[0].alias("category"),
        F.col("listing_price.final_price").alias("price"),
        F.col("min_purchase_count").alias("min_count"), F.col("max_purchase_count").alias("max_count"),
    )


@query(
    "plan_properties",
    f"""SELECT page_id, {join_raw('terms')} AS inclusions, '' AS exclusions, {join_raw('details')} AS highlights,
        {join_raw('terms')} AS terms, {cleaned_list('tags')} AS tags FROM {_O}""",
)
def plan_properties(spark, sf):
    return records.plan(raw_from_orders(spark, sf), S).select(
        "page_id", *[joined(f"properties.{c}").alias(c) for c in ("inclusions", "exclusions", "highlights", "terms")],
        joined("tags").alias("tags"),
    )


@query(
    "plan_pois",
    f"""WITH p AS (SELECT page_id, {_KEY} AS key, unnest(list_value(near_name, '  Old  pier ')) AS n,
            coalesce(canonical, '') AS url, coalesce(og, '') AS image, coalesce(category, '') AS category FROM {_O})
        SELECT page_id, {clean_sql('n')} AS name, url, image, category, true AS admission,
            CAST(1000000 + {hash32_sql(f"'poi:' || key || '#' || {clean_sql('n')}")} % 1000000000 AS VARCHAR) AS poi_id
        FROM p WHERE {clean_sql('n')} <> ''""",
)
def plan_pois(spark, sf):
    return each_row(records.plan(raw_from_orders(spark, sf), S), "pois", "p").select(
        "page_id", "p.name", "p.url", "p.image", "p.category", "p.admission", "p.poi_id"
    )


def _day_sql(key: str, full: str) -> str:
    closed = (
        f"(contains(lower(coalesce(closed_days, '')), '{full}') OR "
        f"contains(lower(coalesce(closed_days, '')), '{key.lower()}'))"
    )
    opens, closes = first_sql("opens", "'10:00 AM'"), first_sql("closes", "'06:00 PM'")
    return (
        f"SELECT page_id, '{key}' AS day, NOT {closed} AS is_open, "
        f"CASE WHEN {closed} THEN 'Closed' ELSE 'Open' END AS info, "
        f"CASE WHEN {closed} THEN '' ELSE {opens} END AS opening, "
        f"CASE WHEN {closed} THEN '' ELSE {closes} END AS closing, "
        f"CASE WHEN {closed} THEN '' ELSE {opens} || '-' || {closes} END AS slots, "
        f"{_PLAN_PRICE} AS adult_male, {_PLAN_PRICE} AS senior_female, CAST(0 AS DOUBLE) AS infant FROM o"
    )


@query(
    "plan_week",
    f"WITH o AS (SELECT * FROM {_O}) "
    + " UNION ALL ".join(_day_sql(k, f) for k, f in (
        ("Mon", "monday"), ("Tues", "tuesday"), ("Weds", "wednesday"), ("Thur", "thursday"), ("Fri", "friday"),
        ("Sat", "saturday"), ("Sun", "sunday"))),
)
def plan_week(spark, sf):
    days = "array(" + ", ".join(
        f"named_struct('day', '{k}', 'd', week_opening_info.{k})" for k, _ in WEEK
    ) + ")"
    plans = records.plan(raw_from_orders(spark, sf), S).select("page_id", F.expr(f"inline({days})"))
    return plans.select(
        "page_id", "day", F.col("d.is_Open").alias("is_open"), "d.info",
        F.col("d.opening_Time").alias("opening"), F.col("d.closing_Time").alias("closing"),
        F.expr("array_join(transform(d.timing_Slot_List, s -> concat(s.start, '-', s.end)), ',')").alias("slots"),
        F.col("d.price_PerPerson.Adult.Male").alias("adult_male"),
        F.col("d.price_PerPerson.Senior.Female").alias("senior_female"),
        F.col("d.price_PerPerson.Infant.Male").alias("infant"),
    )


_SHOWN = clean_sql(first_sql("name", "slug", "'Experience'"))
_I = "CAST(i AS INT)"
ITEMS = f"""
    WITH o AS (SELECT *, {_SHOWN} AS shown, {_KEY} AS key FROM {_O}),
    x AS (
        SELECT page_id, key, shown, 1 AS pos, cover AS u, shown || ' - Cover' AS alt, CAST(NULL AS VARCHAR) AS caption, 'cover' AS type FROM o
        UNION ALL SELECT page_id, key, shown, 2, hero, shown || ' - Hero', NULL, 'hero' FROM o
        UNION ALL SELECT page_id, key, shown, 2 + i, {_IMAGE_URL.format(i='i')}, {_IMAGE_ALT.format(i='i')},
            {_IMAGE_CAPTION.format(i='i')}, 'hero_gallery' FROM o, (SELECT unnest(range(1, 3)) AS i) WHERE i <= n_images
        UNION ALL SELECT page_id, key, shown, 100 + i, {_IMAGE_URL.format(i='i')}, {_IMAGE_ALT.format(i='i')},
            {_IMAGE_CAPTION.format(i='i')}, 'gallery' FROM o, (SELECT unnest(range(1, 10)) AS i) WHERE i <= n_images),
    f AS (SELECT *, {clean_sql(first_sql('alt', 'caption', 'shown'))} AS a, {clean_sql(first_sql('caption', 'alt'))} AS c
          FROM x WHERE u <> '' AND NOT ends_with(u, '.svg') AND NOT contains(u, 'logo')
          AND NOT contains(u, 'favicon') AND NOT contains(u, 'map-pin')
          QUALIFY row_number() OVER (PARTITION BY page_id, u ORDER BY pos) = 1),
    n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rank FROM f)"""


GALLERY = f"""{ITEMS} SELECT page_id, 1000000 + {hash32_sql("'gallery:' || key")} % 1000000000 + rank AS id,
        1000000 + {hash32_sql('key')} % 1000000000 AS activity_id, u AS url,
        {first_sql('a', 'shown')} AS title, {first_sql('c', 'a', 'shown')} AS description, type, rank AS "order" FROM n"""


@query("gallery_rows", GALLERY)
def gallery_rows(spark, sf):
    return records.gallery(raw_from_orders(spark, sf), S).select(
        "page_id", F.col("id").cast("bigint").alias("id"), F.col("activity_id").cast("bigint").alias("activity_id"),
        "url", "title", "description", "type", F.col("order").cast("bigint").alias("order"),
    )


@query(
    "gallery_labels",
    f"""{ITEMS}, t AS (SELECT page_id AS p, array_to_string(list_filter(list_value({clean_sql('category')}, {clean_sql('city')}),
            lambda s: s <> ''), '|') AS tags, {clean_sql(first_sql('seo_title', 'shown'))} AS meta_title,
            {clean_sql(first_sql('seo_meta', 'substr(about, 1, 160)'))} AS meta_description FROM o)
        SELECT page_id, tags, meta_title, meta_description, count(*) AS images FROM n JOIN t ON n.page_id = t.p
        GROUP BY ALL""",
)
def gallery_labels(spark, sf):
    g = records.gallery(raw_from_orders(spark, sf), S)
    return g.groupBy("page_id", joined("tags").alias("tags"), "meta_title", "meta_description").agg(
        F.count("*").alias("images")
    )


@query(
    "gallery_unlinked",
    f"""{ITEMS} SELECT page_id, 1000000 + {hash32_sql("'gallery:' || key")} % 1000000000 AS activity_id,
        count(*) AS images FROM n GROUP BY ALL""",
)
def gallery_unlinked(spark, sf):
    g = records.gallery(raw_from_orders(spark, sf), S, linked=False)
    return g.groupBy("page_id", F.col("activity_id").cast("bigint").alias("activity_id")).agg(
        F.count("*").alias("images")
    )


@query(
    "bundle_metadata",
    f"""{ITEMS} SELECT o.page_id, 'Demo' AS provider, coalesce(url, '') AS source_url, slug,
        CASE WHEN k % 5 <> 0 THEN scraped ELSE '2026-01-01T00:00:00.000Z' END AS scraped_at,
        1 AS total_plans, coalesce(g.images, 0) AS total_gallery_images, {_ID} AS activity_id, {_ID} + 100 AS plan_id
        FROM o LEFT JOIN (SELECT page_id, count(*) AS images FROM n GROUP BY page_id) g USING (page_id)""",
)
def bundle_metadata(spark, sf):
    return records.bundle(raw_from_orders(spark, sf), S).select(
        "page_id", "metadata.provider", "metadata.source_url", "metadata.slug", "metadata.scraped_at",
        "metadata.total_plans", F.col("metadata.total_gallery_images").cast("bigint").alias("total_gallery_images"),
        F.col("activity.id").cast("bigint").alias("activity_id"),
        F.expr("CAST(plans[0].id AS BIGINT)").alias("plan_id"),
    )


@query(
    "bundle_gallery_order",
    f"""{ITEMS} SELECT page_id, coalesce(urls, '') AS urls, coalesce(images, 0) AS images FROM o LEFT JOIN (
        SELECT page_id, string_agg(u, ' ' ORDER BY rank) AS urls, count(*) AS images FROM n GROUP BY page_id)
        USING (page_id)""",
)
def bundle_gallery_order(spark, sf):
    return records.bundle(raw_from_orders(spark, sf), S).select(
        "page_id", F.array_join("gallery.url", " ").alias("urls"),
        F.expr("CAST(size(gallery) AS BIGINT)").alias("images"),
    )


@query(
    "bundle_custom_id",
    f"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN {_ID} ELSE page_id % 3 END AS activity_id,
        CASE WHEN page_id % 3 = 0 THEN {_ID} ELSE page_id % 3 END + 100 AS plan_id FROM {_O}""",
)
def bundle_custom_id(spark, sf):
    return records.bundle(raw_from_orders(spark, sf), S, custom_id="page_id % 3").select(
        "page_id", F.col("activity.id").cast("bigint").alias("activity_id"),
        F.expr("CAST(plans[0].id AS BIGINT)").alias("plan_id"),
    )


@query(
    "bundle_latest_per_slug",
    f"""SELECT {first_sql('slug', "'output'")} AS slug, page_id,
        CASE WHEN k % 5 <> 0 THEN scraped ELSE '2026-01-01T00:00:00.000Z' END AS scraped_at FROM {_O}
        QUALIFY row_number() OVER (PARTITION BY slug ORDER BY
            CASE WHEN k % 5 <> 0 THEN scraped ELSE '2026-01-01T00:00:00.000Z' END DESC, page_id DESC) = 1""",
)
def bundle_latest(spark, sf):
    return latest_per_slug(records.bundle(raw_from_orders(spark, sf), S)).select(
        "slug", "page_id", "metadata.scraped_at"
    )


@query(
    "bundle_rejects",
    f"SELECT CAST(count(*) FILTER (WHERE k % 10 <> 0) AS BIGINT) AS good, "
    f"CAST(count(*) FILTER (WHERE k % 10 = 0) AS BIGINT) AS rejected FROM {_O}",
)
def bundle_rejects(spark, sf):
    b = records.bundle(raw_from_orders(spark, sf), S)
    damaged = b.withColumn("activity", F.expr("CASE WHEN page_id % 10 <> 0 THEN activity END"))
    good, bad = record_source.check_bundles(damaged)
    marks = good.select(F.lit(1).alias("g")).unionAll(bad.select(F.lit(0).alias("g")))
    return marks.agg(
        F.expr("count_if(g = 1)").alias("good"), F.expr("count_if(g = 0)").alias("rejected")
    )


# ---- links between tables --------------------------------------------------------------

@query(
    "activity_plan_join",
    f"SELECT page_id, {_ID} AS activity_id, {_ID} + 100 AS plan_id, {_NAME} AS activity_name, {_PLAN_PRICE} AS price FROM {_O}",
)
def activity_plan_join(spark, sf):
    raw = raw_from_orders(spark, sf)
    a = records.activity(raw, S).select("page_id", "id", "name")
    p = records.plan(raw, S).select("page_id", "activity_id", "id", F.col("listing_price.final_price").alias("price"))
    return linkage.activity_plans(a, p).select(
        "page_id", F.col("activity_id").cast("bigint").alias("activity_id"),
        F.col("plan_id").cast("bigint").alias("plan_id"), "activity_name", F.col("plan_price").alias("price"),
    )


@query(
    "activity_gallery_join",
    """SELECT o_orderkey AS page_id, o_orderstatus AS status, l_linenumber AS "order", l_partkey AS part
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def activity_gallery_join(spark, sf):
    a = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("page_id"), F.col("o_orderkey").alias("id"), "o_orderstatus"
    )
    g = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("page_id"), F.col("l_orderkey").alias("activity_id"),
        F.col("l_linenumber").alias("order"), F.col("l_partkey").alias("part"),
    )
    return linkage.activity_gallery(a, g).select(
        "page_id", F.col("activity_o_orderstatus").alias("status"), F.col("image_order").alias("order"),
        F.col("image_part").alias("part"),
    )


@query(
    "activity_gallery_salted",
    """SELECT u % 10 AS page_id, count(*) AS images, CAST(sum(event_id) AS BIGINT) AS ids FROM
       (SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS u, event_id FROM events) GROUP BY 1""",
)
def activity_gallery_salted(spark, sf):
    """A third of all children under one parent: dealt out over salts."""
    g = table(spark, sf, "events").select(
        F.expr("(CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END) % 10").alias("page_id"), "event_id"
    )
    a = g.select("page_id").distinct().withColumn("name", F.lit("x"))
    joined_rows = linkage.join_children(a, g, ["page_id"], F.col("event_id"), "left", small_group=500)
    return joined_rows.groupBy("page_id").agg(F.count("*").alias("images"), F.sum("event_id").alias("ids"))


# ---- reports ---------------------------------------------------------------------------

@query(
    "report_pages",
    f"""SELECT page_id, slug, name, city, category, n_images AS n_images, CAST(coalesce(len(terms), 0) AS INTEGER) AS n_terms,
        CAST(coalesce(len(details), 0) AS INTEGER) AS n_highlights, 0 AS n_exclusions, 2 AS n_nearbyattractions,
        CAST(min_price AS DOUBLE) AS min_price, lat AS latitude,
        (SELECT count(*) FROM lineitem WHERE l_orderkey = page_id) AS n_responses FROM {_O}""",
)
def report_pages(spark, sf):
    calls = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("page_id"))
    return report.page_report(raw_from_orders(spark, sf), calls).select(
        "page_id", "slug", "name", "city", "category", "n_images", "n_terms", "n_highlights",
        "n_exclusions", "n_nearbyattractions", "min_price", "latitude", "n_responses",
    )


@query(
    "report_totals",
    f"""SELECT city, category, CAST(grouping(city, category) AS BIGINT) AS level, count(*) AS pages,
        CAST(sum(n_images) AS BIGINT) AS images, min(CAST(min_price AS DOUBLE)) AS min_price,
        max(CAST(min_price AS DOUBLE)) AS max_price FROM {_O} GROUP BY ROLLUP (city, category)""",
)
def report_totals(spark, sf):
    return report.catalogue_totals(report.page_report(raw_from_orders(spark, sf))).withColumn(
        "level", F.col("level").cast("bigint")
    )


@query(
    "report_bundles",
    f"SELECT page_id, {_NAME} AS name, {_ID} AS activity_id, 1 AS n_plans, {_ID} + 100 AS plan_id, "
    f"{category_sql('category', _NAME, 'slug')} AS category, {_CITY} AS city, 'India' AS country FROM {_O}",
)
def report_bundles(spark, sf):
    r = report.bundle_report(records.bundle(raw_from_orders(spark, sf), S)).drop("n_images")
    return r.withColumns({c: F.col(c).cast("bigint") for c in ("activity_id", "plan_id")})


# ---- publishing ------------------------------------------------------------------------

@query(
    "publish_outbox",
    f"""{ITEMS}, r AS (
        SELECT page_id, slug, 1 AS stage, CAST(1 AS BIGINT) AS n, '/api/v1/activity/activityInfo' AS url, {_ID} AS id,
            '2026-01-01T00:00:00.000Z' AS created_at FROM o
        UNION ALL SELECT page_id, slug, 2, 1, '/api/v1/activity/activityInfo/' || slug ||
            '/planInfo?link_pois=true&group_plan=true', {_ID} + 100, NULL FROM o
        UNION ALL SELECT n.page_id, o.slug, 3, rank, '/api/v1/activity/activitySubInfo/' || o.slug || '/imageInfo',
            1000000 + {hash32_sql("'gallery:' || n.key")} % 1000000000 + rank, '2026-01-01T00:00:00.000Z'
            FROM n JOIN o ON n.page_id = o.page_id)
        SELECT *, 'POST' AS method FROM r""",
)
def publish_outbox(spark, sf):
    box = publish.outbox(records.bundle(raw_from_orders(spark, sf), S))
    said = F.from_json("body", "id BIGINT, created_at STRING").alias("said")
    return box.select("page_id", "slug", "stage", F.col("n").cast("bigint").alias("n"), "url", "method", said).select(
        "page_id", "slug", "stage", "n", "url", "method", "said.id", "said.created_at")


# ---- JSON records ----------------------------------------------------------------------

_JSON = """
    SELECT event_id AS page_id, concat('{"slug":"e', CAST(event_id AS <string>), '","hero":{"name":"', event_type, '","images":[]},',
        '"ticketPrices":{"minPrice":', CASE event_id % 4 WHEN 0 THEN '75.5' WHEN 1 THEN '"75"' WHEN 2 THEN 'null' ELSE '0' END,
        ',"prices":["₹ ', CAST(user_id AS <string>), '"]},"gallery":["https://c.example.com/', CAST(event_id AS <string>),
        '.jpg",{"url":"https://c.example.com/b.jpg","caption":"C"},{"url":5},7],"location":{"latitude":',
        CASE event_id % 3 WHEN 0 THEN '1.5' WHEN 1 THEN '"2.5"' ELSE 'true' END, '}}') AS value
    FROM <t:events>"""


@query(
    "json_records",
    """SELECT event_id AS page_id, 'e' || event_id AS slug, event_type AS name,
       CAST(CASE event_id % 4 WHEN 0 THEN 75.5 WHEN 3 THEN 0 ELSE user_id END AS DOUBLE) AS price,
       CAST(CASE WHEN event_id % 3 = 0 THEN 1.5 ELSE 0 END AS DOUBLE) AS latitude,
       'https://c.example.com/' || event_id || '.jpg https://c.example.com/b.jpg' AS urls FROM events""",
)
def json_records(spark, sf):
    """Records with a page_id of their own."""
    raw = record_source.raw_from_json_text(spark_facts(_JSON, spark, sf, "events", deal="event_id"))
    b = records.bundle(raw, S)
    return b.select(
        "page_id", "activity.slug", "activity.name",
        F.col("activity.listing_price.final_price").alias("price"), "activity.latitude",
        F.array_join("gallery.url", " ").alias("urls"),
    )


_SAME = """
    SELECT concat('{"slug":"', CASE event_id % 3 WHEN 0 THEN 'same' WHEN 1 THEN concat('e', CAST(event_id AS <string>)) ELSE '' END,
        '","hero":{"name":"', event_type, '"},"apiResponses":{"/a?x":{"url":"https://h/a?x","status":', CASE event_id % 2 WHEN 0 THEN '200' ELSE '500' END,
        ',"data":{"n":0,"n":', CAST(event_id AS <string>), '}},"/b":{"url":"https://h/b","status":200,"data":null}}}') AS value
    FROM <t:events>"""


@query(
    "json_keys",
    """SELECT count(*) AS records, count(*) AS page_ids, count(*) AS joined, sum(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END)::BIGINT AS same_slug
       FROM events""",
)
def json_keys(spark, sf):
    """Records that share a slug or have no address stay apart, and a join of them does not multiply."""
    from excursio.sources.records import raw_from_json_text

    lines = spark_facts(_SAME, spark, sf, "events")
    raw = raw_from_json_text(lines)
    joined = linkage.activity_plans(records.activity(raw, S), records.plan(raw, S))
    return joined.agg(
        F.count("*").alias("records"), F.count_distinct("page_id").alias("page_ids"), F.count("plan_id").alias("joined"),
        F.count_if(F.col("activity_slug") == "same").alias("same_slug"),
    )


@query(
    "json_responses",
    """SELECT key, status, count(*) AS n, sum(CASE WHEN key = '/a?x' THEN event_id END)::BIGINT AS total FROM (
           SELECT event_id, '/a?x' AS key, CASE event_id % 2 WHEN 0 THEN 200 ELSE 500 END AS status FROM events
           UNION ALL SELECT event_id, '/b', 200 FROM events) GROUP BY key, status""",
)
def json_responses(spark, sf):
    rows = record_source.kept_responses(record_source.json_text_records(spark_facts(_SAME, spark, sf, "events")))
    return rows.groupBy("key", "status").agg(
        F.count("*").alias("n"), F.sum(F.expr("try_variant_get(data, '$.n', 'bigint')")).alias("total")
    )


# ---- columns that hold the same value everywhere -----------------------------------------

@query(
    "activity_flags",
    f"""SELECT page_id, true AS authorization_, true AS website, true AS ttd, false AS homepage, false AS landingpage,
        true AS partial, true AS prepaid, true AS postpaid, CAST(0 AS BIGINT) AS min_duration, CAST(0 AS BIGINT) AS max_duration,
        CAST(0 AS BIGINT) AS duration, CAST(0 AS BIGINT) AS reviews, '' AS place_id, '' AS landmark, '' AS pincode, '' AS state,
        '' AS state_code, 'fixed' AS price_type, CAST(0 AS BIGINT) AS other_prices, {_PRICE} AS original_price,
        coalesce(opens, '') AS last_entry, '' AS best_time, '2026-01-01T00:00:00' AS updated FROM {_O}""",
)
def activity_flags(spark, sf):
    return records.activity(raw_from_orders(spark, sf), S).select(
        "page_id", F.col("authorization").alias("authorization_"), F.col("website_available").alias("website"),
        F.col("ttd_available").alias("ttd"), F.col("show_on_homepage").alias("homepage"),
        F.col("show_on_landingpage").alias("landingpage"), F.col("partial_payment").alias("partial"),
        F.col("prepaid_payment").alias("prepaid"), F.col("postpaid_payment").alias("postpaid"),
        *[F.col(c).cast("bigint").alias(c) for c in ("min_duration", "max_duration", "duration")],
        F.col("reviews_count").cast("bigint").alias("reviews"), "place_id", "landmark", "pincode", "state", "state_code",
        F.col("listing_price.type").alias("price_type"), F.col("listing_price.other_prices_exist").cast("bigint").alias("other_prices"),
        F.col("listing_price.original_price").alias("original_price"), F.col("schedule.last_entry").alias("last_entry"),
        F.col("schedule.best_visiting_time").alias("best_time"),
        F.expr("date_format(convert_timezone('UTC', CAST(updated_at AS TIMESTAMP_NTZ)), \"yyyy-MM-dd'T'HH:mm:ss\")").alias("updated"),
    )


@query(
    "plan_flags",
    f"""SELECT page_id, 'general' AS type, true AS availability, CAST(0 AS BIGINT) AS duration, CAST(0 AS BIGINT) AS margin,
        CAST(0 AS BIGINT) AS net, 'ONDC' AS source, 10000000 + {hash32_sql(f"'plan:' || {_KEY}")} % 90000000 AS product,
        'fixed' AS price_type, CAST(0 AS BIGINT) AS other_prices, {_PLAN_PRICE} AS original_price, {_PLAN_PRICE} AS payable,
        {first_sql('currency', "'INR'")} AS currency FROM {_O}""",
)
def plan_flags(spark, sf):
    return records.plan(raw_from_orders(spark, sf), S).select(
        "page_id", "type", "availability", F.col("duration").cast("bigint").alias("duration"),
        F.col("margin").cast("bigint").alias("margin"), F.col("net_price_percentage").cast("bigint").alias("net"),
        "association.source", F.col("association.productId").cast("bigint").alias("product"),
        F.col("listing_price.type").alias("price_type"), F.col("listing_price.other_prices_exist").cast("bigint").alias("other_prices"),
        F.col("listing_price.original_price").alias("original_price"), F.col("listing_price.minimum_payable_price").alias("payable"),
        F.col("listing_price.currency_code").alias("currency"),
    )


# ---- written lines ------------------------------------------------------------------------

@query(
    "sink_table_lines",
    f"""SELECT page_id, slug, city, lat IS NULL AS no_latitude, 'page_id,slug,city,latitude' AS keys FROM (
        SELECT page_id, slug, {_CITY} AS city, lat FROM {_O})""",
)
def sink_table_lines(spark, sf):
    """Rows as JSON lines keep the order of their columns, and fields that are null."""
    a = records.activity(raw_from_orders(spark, sf), S)
    lines = table_lines(a.select("page_id", "slug", "city", F.expr("nullif(latitude, 0D)").alias("latitude")))
    return lines.select(
        F.expr("CAST(get_json_object(value, '$.page_id') AS BIGINT)").alias("page_id"),
        F.get_json_object("value", "$.slug").alias("slug"), F.get_json_object("value", "$.city").alias("city"),
        F.contains("value", F.lit('"latitude":null')).alias("no_latitude"),
        F.array_join(F.json_object_keys("value"), ",").alias("keys"),
    )


SINK_BUNDLE = f"""SELECT slug, k AS page_id, 'activity,plans,gallery,metadata' AS keys, '2026-01-01T00:00:00.000Z' AS created FROM (
        SELECT {first_sql('slug', "'output'")} AS slug, k,
            row_number() OVER (PARTITION BY {first_sql('slug', "'output'")}
                ORDER BY CASE WHEN k % 5 <> 0 THEN scraped ELSE '2026-01-01T00:00:00.000Z' END DESC, k DESC) AS r FROM {_O})
    WHERE r = 1"""


@query("sink_bundle_lines", SINK_BUNDLE)
def sink_bundle_lines(spark, sf):
    """The line of a slug is that of its last bundle; the address in it tells which page that was."""
    raw = raw_from_orders(spark, sf)
    raw = raw.withColumn("url", F.concat(F.lit("https://travel.example.com/x/"), F.col("page_id").cast("string")))
    return bundle_lines(records.bundle(raw, S)).select(
        "slug", F.expr("CAST(regexp_extract(get_json_object(value, '$.metadata.source_url'), '[0-9]+$', 0) AS BIGINT)").alias("page_id"),
        F.array_join(F.json_object_keys("value"), ",").alias("keys"), F.get_json_object("value", "$.activity.created_at").alias("created"),
    )
