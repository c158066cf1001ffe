"""Queries that write files and tables into the shared folder, and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from excursio.operators import records, responses
from excursio.operators.page_fields import extract
from excursio.operators.unique_ids import resolved_ids
from excursio.sources import records as record_source
from excursio.sources.pages import page_nodes
from excursio.sources.scratch import kept, scratch_place
from excursio.sources.sinks import merge_bundles, merged_bundles, save_bucketed
from excursio.workload.records import S, SINK_BUNDLE, raw_from_orders
from excursio.workload.registry import hash32_sql, pick, query, spark_facts, table
from excursio.workload.responses import PRICED_PAGES, latest

# An element of a file: records with fields of other types than usual, and what is no record.
_N = "CAST(event_id AS <string>)"
_ELEMENT = pick(
    "event_id",
    f"""concat('{{"slug":"e', {_N}, '","metadata":{{"totalImages":"3"}}}}')""",
    f"""concat('{{"slug":"e', {_N}, '","hero":{{"rating":4}},"ticketPrices":{{"prices":"5"}}}}')""",
    f"""concat('{{"slug":"e', {_N}, '","hero":{{"tags":"solo"}}}}')""",
    f"""concat('{{"activity":{{"id":', {_N}, '}}}}')""",
    _N,
    "'null'",
    f"""concat('{{"slug":"e', {_N}, '","description":{{"full":[1]}}}}')""",
    f"""concat('{{"slug":"e', {_N}, '","gallery":[null]}}')""",
    f"""concat('{{"slug":"e', {_N}, '",\n "terms":["a",\n "b"]}}')""",
)
_FILE_OF = "event_id - event_id % 500"
_REASON = """CASE event_id % 9 WHEN 2 THEN 'hero.tags is not a list' WHEN 3 THEN 'no hero and no slug' WHEN 4 THEN 'not an object'
    WHEN 5 THEN 'not an object' WHEN 6 THEN 'description.full is not a text' WHEN 7 THEN 'gallery holds null' END"""


@query(
    "json_files",
    f"""WITH f AS (SELECT event_id, {_FILE_OF} AS file, ({_FILE_OF}) // 500 % 8 AS kind FROM events),
        r AS (SELECT file, event_id, {_REASON} AS reason FROM f WHERE kind NOT IN (5, 6))
        SELECT file, 'e' || event_id AS slug, CASE WHEN event_id % 9 = 1 THEN 5 ELSE 0 END::DOUBLE AS price, CAST(NULL AS VARCHAR) AS reason, 1::BIGINT AS n
        FROM r WHERE reason IS NULL
        UNION ALL SELECT file, NULL, NULL, reason, count(*) FROM r WHERE reason IS NOT NULL GROUP BY file, reason
        UNION ALL SELECT DISTINCT file, NULL::VARCHAR, NULL::DOUBLE, CASE kind WHEN 5 THEN 'not JSON' ELSE 'not an object' END, 1::BIGINT FROM f WHERE kind IN (5, 6)""",
)
def json_files(spark, sf):
    """Files of up to 500 records each: every record comes out once, every other element or file once with its reason."""
    rows = spark_facts(f"SELECT event_id, {_FILE_OF} AS file, {_ELEMENT} AS value FROM <t:events>", spark, sf, "events")
    kind = F.expr("file DIV 500 % 8")
    body = F.concat(F.lit("[\n"), F.array_join(F.collect_list("value"), ",\n"), F.lit("]"))  # at most 500 elements
    whole = F.when(kind == 5, F.lit('{"slug":"cut')).when(kind == 6, F.lit("[]")).otherwise(F.col("value"))
    files = rows.groupBy("file").agg(body.alias("value")).select("file", whole.alias("value"))
    place = scratch_place(spark, "json-files")
    files.write.partitionBy("file").text(place)
    file = F.regexp_extract("file", "file=([0-9]+)", 1).cast("bigint").alias("file")
    rows = record_source.json_files(spark, place).select(file, "page_id", "value")
    got = kept(record_source.json_records(rows, need=("hero", "slug")), "json-records")  # parsed once
    good, _, bad = record_source.split_json(got)
    prices = records.activity(good, S).select("page_id", "slug", F.col("listing_price.final_price").cast("double").alias("price"))
    none = F.lit(None)
    out = prices.join(got.where("reason IS NULL").select("page_id", "file"), "page_id").select(
        "file", "slug", "price", none.cast("string").alias("reason"), F.lit(1).cast("bigint").alias("n"))
    return out.unionByName(bad.groupBy("file", "reason").agg(F.count("*").alias("n")).select(
        "file", none.cast("string").alias("slug"), none.cast("double").alias("price"), "reason", "n"))


@query(
    "json_text_rejects",
    f"""SELECT event_id AS page_id, {_REASON.replace("'no hero and no slug'", "NULL")} AS reason FROM events
        WHERE event_id % 9 IN (2, 4, 5, 6, 7)""",
)
def json_text_rejects(spark, sf):
    """Texts of which no record can be made, with the reason."""
    rows = spark_facts(f"SELECT event_id AS page_id, {_ELEMENT} AS value FROM <t:events>", spark, sf, "events")
    return record_source.json_text_rejects(rows)


@query("sink_merged_bundles", SINK_BUNDLE)
def sink_merged_bundles(spark, sf):
    """Two runs over different pages: the table holds the last bundle of every slug of both."""
    raw = raw_from_orders(spark, sf)
    raw = raw.withColumn("url", F.concat(F.lit("https://travel.example.com/x/"), F.col("page_id").cast("string")))
    bundle, place = records.bundle(raw, S), scratch_place(spark, "merged")
    merge_bundles(bundle.where("page_id % 3 <> 0"), place, buckets=8)
    merge_bundles(bundle.where("page_id % 3 = 0"), place)
    return merged_bundles(spark, place).select(
        "slug", F.expr("CAST(regexp_extract(get_json_object(value, '$.metadata.source_url'), '[0-9]+$', 0) AS BIGINT)").alias("page_id"),
        F.array_join(F.json_object_keys("value"), ",").alias("keys"), F.get_json_object("value", "$.activity.created_at").alias("created"),
    )


@query("api_price_pages", PRICED_PAGES)
def api_price_pages(spark, sf):
    """Pages and pricing in the same buckets: they join where they lie."""
    name = uuid.uuid4().hex
    pages = save_bucketed(table(spark, sf, "pages").select("page_id", "url", "html"), f"pages_{name}", scratch_place(spark, "pages"), 8)
    pricing = save_bucketed(responses.api_pricing(latest(spark, sf)), f"pricing_{name}", scratch_place(spark, "pricing"), 8)
    raw = extract(page_nodes(responses.price_pages(pages, pricing)))
    return raw.select(
        "page_id", F.col("ticketPrices.minPrice").alias("min_price"), F.col("ticketPrices.capacity").alias("capacity"),
        F.col("ticketPrices.currency").alias("currency"),
        F.expr("CASE WHEN ticketPrices.bookableDates IS NOT NULL THEN CAST(size(ticketPrices.bookableDates) AS BIGINT) END").alias("n_dates"),
    )


#: A narrower range than usual, so that ids of the test table meet over several rounds.
_SPAN = 20_000_000


def _resolved_sql(rounds: int) -> str:
    """Rounds of proposals written out; what is left after the last would miss in the rows."""
    ctes = ["p0 AS (SELECT o_orderkey AS page_id, 'https://travel.example.com/c/' || o_custkey AS k FROM orders)"]
    for r in range(rounds):
        key = "k" if r == 0 else f"k || '#' || page_id || '#{r}'"
        taken = "".join(f" UNION ALL SELECT page_id, slot, 0 FROM c{i} JOIN w{i} USING (page_id)" for i in range(r))
        ctes += [
            f"q{r} AS MATERIALIZED (SELECT page_id, k, 1000000 + {hash32_sql(key)} % {_SPAN} AS id FROM p{r})",
            f"c{r} AS MATERIALIZED (SELECT page_id, id + unnest([0, 100]) AS slot FROM q{r})",
            f"o{r} AS (SELECT slot, min((late, page_id)) AS m FROM (SELECT page_id, slot, 1 AS late FROM c{r}{taken}) GROUP BY slot)",
            f"w{r} AS MATERIALIZED (SELECT m[2] AS page_id FROM o{r} WHERE m[1] = 1 GROUP BY 1 HAVING count(*) = 2)",
            f"p{r + 1} AS MATERIALIZED (SELECT page_id, k FROM q{r} WHERE page_id NOT IN (SELECT page_id FROM w{r}))",
        ]
    out = " UNION ALL ".join(f"SELECT page_id, id AS activity_id, id + 100 AS plan_id, {r}::BIGINT AS attempt FROM q{r} JOIN w{r} USING (page_id)" for r in range(rounds))
    return "WITH " + ", ".join(ctes) + " " + out


@query("id_resolved", _resolved_sql(6))
def id_resolved(spark, sf):
    """Activity and plan ids of pages of which many share an address, none twice."""
    pages = table(spark, sf, "orders").selectExpr("o_orderkey AS page_id", "concat('https://travel.example.com/c/', o_custkey) AS url")
    return resolved_ids(pages, span=_SPAN).withColumn("attempt", F.col("attempt").cast("bigint"))
