"""Queries over captured responses and publish outcomes derived from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from excursio.operators import images, publish, responses
from excursio.functions.sql import each, struct
from excursio.settings import GALLERY_JUNK, IMAGE_JUNK
from excursio.workload.captured import nodes
from excursio.operators.page_fields import extract
from excursio.workload.registry import oracle_facts, pick, query, spark_facts

_E = "CAST(event_id AS <string>)"
_KK = "CAST(event_id % 40 AS <string>)"
RESPONSES = f"""
    SELECT user_id AS page_id, event_id AS seq, concat('https://h', CAST(event_id % 3 AS <string>), '.example.com',
        {pick("event_id", "'/api/bookabledates?id='", "'/api/info/'", "'/data.json?x='", "'/track/event?n='",
              "'/api/bookabledates?id='", "'/lib/chunk-'", "'/geo/ipapi/'", "'/api/gtag'", "'/api/track/init/'",
              "'/api/bookabledates?list='")}, {_KK}, CASE WHEN event_id % 11 = 0 THEN '#top' ELSE '' END) AS url,
        CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
        {pick("user_id + event_id", "'application/json'", "'application/json; charset=utf-8'",
              "'application/json'", "'text/html'", "'APPLICATION/JSON'")} AS content_type,
        CASE WHEN event_id % 13 = 5 THEN '{{bad'
             WHEN event_id % 13 = 9 THEN concat('{{"data":[],"data":[{{"date":"twice', {_E}, '","minPrice":4,"capacity":3}}]}}') WHEN event_id % 13 = 6 THEN '{{"data":[]}}'
             WHEN event_id % 13 = 7 THEN '{{"data":{{"a":1}}}}'
             WHEN event_id % 13 = 8 THEN concat('{{"data":[{{"date":"d', {_E}, '","minPrice":"9"}}]}}')
             ELSE concat('{{"data":[{{"date":"d', {_E}, '","minPrice":', CAST(event_id % 97 AS <string>), ',"capacity":',
                  CAST(event_id % 7 AS <string>), '}},{{"date":"e', {_E}, '","minPrice":1,"capacity":2}}]}}') END AS body
    FROM <t:events>""".replace("{{", "{").replace("}}", "}")

_R = f"({oracle_facts(RESPONSES, 'events')})"
KEPT = f"""
    SELECT page_id, seq, url, status, replace(body, '"data":[],', '') AS body, regexp_extract(url, '^https?://[^/?#]*([^#]*)', 1) AS key
    FROM {_R} WHERE contains(content_type, 'application/json') AND NOT contains(url, '.js')
    AND NOT contains(url, 'chunk') AND NOT contains(url, 'webpack') AND NOT contains(url, 'analytics')
    AND NOT contains(url, 'gtag') AND NOT contains(url, 'google') AND NOT contains(url, 'ipapi')
    AND TRY_CAST(body AS JSON) IS NOT NULL"""
LATEST = f"""
    SELECT *, min(seq) OVER (PARTITION BY page_id, key) AS pos FROM ({KEPT})
    QUALIFY row_number() OVER (PARTITION BY page_id, key ORDER BY seq DESC) = 1"""
_DATES = f"""
    SELECT page_id, pos, CAST(body AS JSON) AS j FROM ({LATEST})
    WHERE contains(key, 'bookabledates') AND json_type(body, '$.data') = 'ARRAY' AND json_array_length(body, '$.data') > 0"""
_PRICING = f"""
    SELECT page_id, CASE WHEN json_type(j, '$.data[0].minPrice') <> 'VARCHAR'
               THEN CAST(json_extract_string(j, '$.data[0].minPrice') AS DOUBLE) END AS min_price,
        CAST(json_extract_string(j, '$.data[0].capacity') AS DOUBLE) AS capacity,
        json_extract_string(j, '$.data[0].date') AS first_date,
        CAST(json_array_length(j, '$.data') AS BIGINT) AS n_dates
    FROM ({_DATES}) QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pos DESC) = 1"""


def captured(spark, sf):
    return spark_facts(RESPONSES, spark, sf, "events")


def latest(spark, sf):
    return responses.api_latest(responses.api_keep(captured(spark, sf)))


@query(
    "api_rejects",
    f"""SELECT page_id, seq, url, 'body is not JSON or too large' AS reason
    FROM {_R} WHERE contains(content_type, 'application/json') AND NOT contains(url, '.js')
    AND NOT contains(url, 'chunk') AND NOT contains(url, 'webpack') AND NOT contains(url, 'analytics')
    AND NOT contains(url, 'gtag') AND NOT contains(url, 'google') AND NOT contains(url, 'ipapi')
    AND TRY_CAST(body AS JSON) IS NULL""",
)
def api_rejects(spark, sf):
    return responses.api_rejects(captured(spark, sf))


@query("api_keep", f"SELECT page_id, seq, url, status, key FROM ({KEPT})")
def api_keep(spark, sf):
    return responses.api_keep(captured(spark, sf)).drop("data")


@query(
    "api_latest",
    f"SELECT page_id, key, pos, seq, url, status, json_extract_string(body, '$.data[0].date') AS first_date FROM ({LATEST})",
)
def api_latest(spark, sf):
    return latest(spark, sf).select(
        "page_id", "key", "pos", "seq", "url", "status",
        F.expr("try_variant_get(data, '$.data[0].date', 'string')").alias("first_date"),
    )


@query(
    "api_strip",
    f"SELECT page_id, key, seq FROM ({LATEST}) WHERE NOT contains(key, 'ipapi') "
    "AND NOT contains(key, 'track/init') AND NOT contains(key, 'track/event')",
)
def api_strip(spark, sf):
    return responses.api_strip(latest(spark, sf)).select("page_id", "key", "seq")


@query("api_pricing", _PRICING)
def api_pricing(spark, sf):
    return responses.api_pricing(latest(spark, sf)).select(
        "page_id", F.col("minPrice").alias("min_price"), "capacity",
        F.expr("get(bookableDates, 0).date").alias("first_date"),
        F.expr("CAST(size(bookableDates) AS BIGINT)").alias("n_dates"),
    )


PRICED_PAGES = f"""SELECT page_id, min_price, capacity, CASE WHEN n_dates IS NOT NULL THEN 'INR' END AS currency, n_dates
    FROM pages LEFT JOIN ({_PRICING}) USING (page_id)"""


@query("api_merge_pricing", PRICED_PAGES)
def api_merge_pricing(spark, sf):
    raw = extract(nodes(spark, sf))
    merged = responses.merge_pricing(raw, responses.api_pricing(latest(spark, sf)))
    return merged.select(
        "page_id", F.col("ticketPrices.minPrice").alias("min_price"),
        F.col("ticketPrices.capacity").alias("capacity"), F.col("ticketPrices.currency").alias("currency"),
        F.expr("CASE WHEN ticketPrices.bookableDates IS NOT NULL THEN CAST(size(ticketPrices.bookableDates) "
               "AS BIGINT) END").alias("n_dates"),
    )


# ---- image lists -------------------------------------------------------------------------

# Image i of an event: repeats every third, unwanted ones in between.
_URL = (
    "CASE (event_id + {i}) % 8 WHEN 0 THEN 'https://c.example.com/a.svg' WHEN 1 THEN 'https://c.example.com/logo.png' "
    "WHEN 2 THEN 'https://c.example.com/arrow-down.png' WHEN 3 THEN '' WHEN 4 THEN 'https://c.example.com/Logo.png' "
    "WHEN 5 THEN 'https://c.example.com/favicon.ico' ELSE concat('https://c.example.com/', CAST({i} % 3 AS VARCHAR), '.jpg') END"
)


def _image_oracle(junk) -> str:
    unwanted = " ".join(f"AND NOT contains(url, '{w}')" for w in junk)
    return f"""
        WITH x AS (SELECT event_id, i AS pos, {_URL.format(i='i')} AS url
                   FROM events, (SELECT unnest(range(1, 13)) AS i)),
        f AS (SELECT * FROM x WHERE url <> '' AND NOT ends_with(url, '.svg') {unwanted}
              QUALIFY row_number() OVER (PARTITION BY event_id, url ORDER BY pos) = 1)
        SELECT event_id, string_agg(url, ' ' ORDER BY pos) AS urls FROM f GROUP BY event_id"""


def _image_query(spark, sf, junk):
    url = _URL.replace("AS VARCHAR", "AS STRING")
    listed = each("sequence(1, 12)", lambda i: struct(url=url.format(i=i), pos=i))
    kept = images.filter_images(listed, junk)
    events = spark_facts("SELECT event_id FROM <t:events>", spark, sf, "events")
    return events.select("event_id", F.expr(kept).alias("kept")).filter("size(kept) > 0").select(
        "event_id", F.array_join("kept.url", " ").alias("urls")
    )


@query("image_filter", _image_oracle(("logo", "favicon", "map-pin", "arrow-down")))
def image_filter(spark, sf):
    return _image_query(spark, sf, IMAGE_JUNK)


@query("image_filter_gallery", _image_oracle(("logo", "favicon", "map-pin")))
def image_filter_gallery(spark, sf):
    return _image_query(spark, sf, GALLERY_JUNK)


# ---- publish outcomes ----------------------------------------------------------------------

RESULTS = f"""
    SELECT CONCAT('s', CAST(user_id AS <string>)) AS slug, 1 + event_id % 3 AS stage, event_id AS n,
        CASE WHEN event_type = 'error' AND user_id % 3 = 0 THEN 500 WHEN event_id % 7 = 0 THEN 409
             WHEN event_id % 2 = 0 THEN 201 ELSE 200 END AS status,
        {pick("event_id", "concat('{\"slug\":\"y\",\"slug\":\"x', " + _E + ", '\"}')", "'{\"detail\":\"taken\"}'",
              "'<html>gateway</html>'", "'{\"slug\":\"\",\"detail\":\"d\"}'", "'null'")} AS body
    FROM <t:events>"""
_RES = f"({oracle_facts(RESULTS, 'events')})"


@query(
    "publish_normalise",
    f"""SELECT n, status BETWEEN 200 AND 299 AS ok,
        CASE n % 5 WHEN 0 THEN 'x' || n WHEN 1 THEN 'taken' WHEN 3 THEN 'd' ELSE '' END AS detail,
        CASE WHEN n % 5 = 2 THEN body END AS raw FROM {_RES}""",
)
def publish_normalise(spark, sf):
    return publish.normalise(spark_facts(RESULTS, spark, sf, "events")).select(
        "n", "ok", "detail", F.expr("try_variant_get(data, '$.raw', 'string')").alias("raw")
    )


@query(
    "publish_outcome",
    f"""WITH r AS (SELECT *, status BETWEEN 200 AND 299 AS good FROM {_RES}),
        g AS (SELECT slug, coalesce(bool_and(good) FILTER (WHERE stage = 1), false) AS activity_ok,
            coalesce(bool_and(good) FILTER (WHERE stage = 2), true) AS plans_ok,
            coalesce(bool_and(good) FILTER (WHERE stage = 3), true) AS images_ok,
            count(*) FILTER (WHERE stage = 3 AND good) AS images_done,
            count(*) FILTER (WHERE stage = 3) AS images_total FROM r GROUP BY slug)
        SELECT *, activity_ok AND plans_ok AND images_ok AS ok FROM g""",
)
def publish_outcome(spark, sf):
    return publish.outcome(spark_facts(RESULTS, spark, sf, "events"))
