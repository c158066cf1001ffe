"""Scalar rules over the columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from excursio.functions import ids
from excursio.functions.sql import let
from excursio.functions.text import (
    clean, contains_ci, iso, leading_number, prefix, price_number, title_case,
)
from excursio.functions.urls import absolute, base_parts, path_parts, printed, response_key, srcset_pick
from excursio.operators import page_fields as pf
from excursio.operators.linkage import id_collisions
from excursio.workload.registry import (
    clean_sql, hash32_sql, oracle_facts, pick, query, spark_facts, table, title_sql,
)

# ---- white space, truncation, distinct ---------------------------------------------

_SPACED = (
    "SELECT doc_id, concat(' ', replace(text, ' ', "
    + pick("doc_id", "concat(chr(160), chr(160))", "concat(' ', chr(9), ' ')", "'\ufeff'", "' '")
    + "), chr(10)) AS text FROM <t:documents>"
)


@query(
    "text_clean",
    f"SELECT doc_id, {clean_sql('text')} AS cleaned FROM ({oracle_facts(_SPACED, 'documents')})",
)
def text_clean(spark, sf):
    docs = spark_facts(_SPACED, spark, sf, "documents")
    return docs.select("doc_id", F.expr(clean("text")).alias("cleaned"))


@query(
    "text_prefix",
    f"""SELECT doc_id, {clean_sql("substr(text, 1, 300) || '...'")} AS info,
        {clean_sql("substr(text, 1, 160)")} AS meta, replace(upper(substr({clean_sql('text')}, 1, 3)), 'ẞ', 'SS') AS code
        FROM ({oracle_facts(_SPACED, 'documents')})""",
)
def text_prefix(spark, sf):
    docs = spark_facts(_SPACED, spark, sf, "documents")
    return docs.select(
        "doc_id",
        F.expr(clean(f"concat({prefix('text', 300)}, '...')")).alias("info"),
        F.expr(clean(prefix("text", 160))).alias("meta"),
        F.expr(f"upper({prefix(clean('text'), 3)})").alias("code"),
    )


@query(
    "text_distinct",
    """WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word,
              generate_subscripts(string_split(text, ' '), 1) AS pos FROM documents),
       f AS (SELECT doc_id, word, min(pos) AS pos FROM w GROUP BY doc_id, word)
       SELECT doc_id, count(*) AS n_words, md5(string_agg(word, ' ' ORDER BY pos)) AS digest
       FROM f GROUP BY doc_id""",
)
def text_distinct(spark, sf):
    words = let(
        "array_distinct(split(text, ' '))",
        lambda w: f"named_struct('n', CAST(size({w}) AS BIGINT), 'd', md5(array_join({w}, ' ')))",
    )
    return table(spark, sf, "documents").select("doc_id", F.expr(words).alias("w")).select(
        "doc_id", F.col("w.n").alias("n_words"), F.col("w.d").alias("digest")
    )


@query(
    "text_contains",
    "SELECT doc_id, contains(lower(text), 'the') AS has_the, contains(lower(text), 'éa') AS has_ea "
    "FROM documents",
)
def text_contains(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.expr(contains_ci("text", "the")).alias("has_the"),
        F.expr(contains_ci("text", "éa")).alias("has_ea"),
    )


# ---- title case --------------------------------------------------------------------

_SEGMENTS = (
    "SELECT p_partkey, concat(replace(p_name, ' ', '-'), "
    + pick("p_partkey", "'-o''brien'", "'-iPhone'", "'-éclair_x'", "'.html-2nd'", "''")
    + ") AS segment FROM <t:part>"
)


@query(
    "title_case",
    f"SELECT p_partkey, {title_sql('segment')} AS title FROM ({oracle_facts(_SEGMENTS, 'part')})",
)
def title(spark, sf):
    return spark_facts(_SEGMENTS, spark, sf, "part").select(
        "p_partkey", F.expr(title_case("segment")).alias("title")
    )


# ---- numbers -------------------------------------------------------------------------

_PRICES = (
    "SELECT l_orderkey, l_linenumber, "
    + pick(
        "l_orderkey + l_linenumber",
        "concat('₹ ', CAST(CAST(floor(l_extendedprice) AS BIGINT) AS <string>))",
        "concat('from ₹', CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS <string>), ',',"
        " CAST(100 + CAST(floor(l_quantity) AS BIGINT) AS <string>), '.50')",
        "'₹ 1.2.3'", "''", "NULL", "'free'", "'.5'", "'7.'", "'.'",
    )
    + " AS price, "
    + pick(
        "l_orderkey", "'4.5 stars'", "' 3'", "'-2.25'", "'1e2x'", "'n/a'", "'.75'", "NULL", "'+6.'",
    )
    + " AS rating FROM <t:lineitem>"
)


@query(
    "price_number",
    f"""SELECT l_orderkey, l_linenumber, price,
        TRY_CAST(regexp_extract(regexp_replace(price, '[^0-9.]', '', 'g'),
                 '^[0-9]*\\.?[0-9]*') AS DOUBLE) AS amount
        FROM ({oracle_facts(_PRICES, 'lineitem')})""",
)
def price(spark, sf):
    return spark_facts(_PRICES, spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "price", F.expr(price_number("price")).alias("amount")
    )


@query(
    "leading_number",
    f"""SELECT l_orderkey, l_linenumber, rating,
        TRY_CAST(nullif(regexp_extract(rating,
            '^\\s*([+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?)', 1), '') AS DOUBLE) AS stars
        FROM ({oracle_facts(_PRICES, 'lineitem')})""",
)
def rating(spark, sf):
    return spark_facts(_PRICES, spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "rating", F.expr(leading_number("rating")).alias("stars")
    )


@query(
    "iso_timestamp",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS at, "
    "strftime(make_timestamp((1729980000 + event_id % 7200) * 1000000), '%Y-%m-%dT%H:%M:%S.%gZ') AS autumn FROM events",
)
def timestamps(spark, sf):
    """Event times, and instants around a change of clocks."""
    instant = "timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', ts))"
    return table(spark, sf, "events").select(
        "event_id", F.expr(iso(instant)).alias("at"),
        F.expr(iso("timestamp_seconds(1729980000 + event_id % 7200)")).alias("autumn"),
    )


# ---- identifiers ---------------------------------------------------------------------

_ADDRESS = "concat('https://travel.example.com/p/', CAST(o_orderkey AS <string>))"
_ADDRESSES = f"SELECT o_orderkey, {_ADDRESS} AS url, o_orderkey % 4 AS own FROM <t:orders>"


@query(
    "record_ids",
    f"""SELECT o_orderkey,
        CASE WHEN own <> 0 THEN own ELSE 1000000 + {hash32_sql('url')} % 1000000000 END AS id,
        10000000 + {hash32_sql("'activity:' || url")} % 90000000 AS product,
        10000000 + {hash32_sql("'plan:' || url")} % 90000000 AS plan_product,
        CAST(1000000 + {hash32_sql("'poi:' || url || '#' || 'Zoo'")} % 1000000000 AS VARCHAR) AS poi,
        1000000 + {hash32_sql("'gallery:' || url")} % 1000000000 + 1 AS first_image,
        substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' ||
        substr(h, 17, 4) || '-' || substr(h, 21) AS unique_id
        FROM (SELECT *, md5('activity:' || url) AS h FROM ({oracle_facts(_ADDRESSES, 'orders')}))""",
)
def record_ids(spark, sf):
    own = ids.caller_or("own", ids.activity_id("url"))
    return spark_facts(_ADDRESSES, spark, sf, "orders").select(
        "o_orderkey",
        F.expr(own).cast("bigint").alias("id"),
        F.expr(ids.product_id("activity", "url")).cast("bigint").alias("product"),
        F.expr(ids.product_id("plan", "url")).cast("bigint").alias("plan_product"),
        F.expr(ids.poi_id("url", "'Zoo'")).alias("poi"),
        F.expr(f"{ids.gallery_base('url')} + 1").cast("bigint").alias("first_image"),
        F.expr(ids.unique_id("activity", "url")).alias("unique_id"),
    )


_LINES = (
    "SELECT concat('https://travel.example.com/l/', CAST(l_partkey AS <string>), '/', "
    "CAST(l_suppkey AS <string>)) AS url FROM <t:lineitem>"
)


@query(
    "id_collisions",
    f"SELECT id, count(*) AS n FROM (SELECT 1000000 + {hash32_sql('url')} % 1000000000 AS id "
    f"FROM ({oracle_facts(_LINES, 'lineitem')})) GROUP BY id HAVING count(*) > 1",
)
def collisions(spark, sf):
    lines = spark_facts(_LINES, spark, sf, "lineitem")
    return id_collisions(lines.select(F.expr(ids.activity_id("url")).cast("bigint").alias("id")))


# ---- addresses -----------------------------------------------------------------------

# Every page address as it stands, and in forms that a browser prints differently.
_FORMS = (
    "SELECT page_id, " + pick(
        "page_id", "url", "concat(' HTTPS://Host.example.com:443/a b/../', CAST(page_id AS <string>))",
        "'https://bare.example.com'", "concat(url, ' ')", "concat('http://h.example.com/x/./y/', CAST(page_id AS <string>), '/..')",
    ) + " AS url FROM <t:pages>"
)
_PRINTED = (
    "SELECT page_id, CASE page_id % 5 WHEN 1 THEN 'https://host.example.com/' || page_id "
    "WHEN 2 THEN 'https://bare.example.com/' WHEN 4 THEN 'http://h.example.com/x/y/' ELSE url END AS url FROM pages"
)


@query(
    "page_address",
    f"""WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*') AS root,
            list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'),
                        lambda s: s <> '') AS parts FROM ({_PRINTED}))
        SELECT page_id, url, coalesce(parts[-1], '') AS slug,
            coalesce({title_sql('parts[1]')}, '') AS city,
            coalesce({title_sql('parts[2]')}, '') AS category,
            array_to_string(list_transform(parts, lambda s: {title_sql('s')}), ' > ') AS crumbs,
            array_to_string(list_transform(parts, lambda s, i: root || '/' ||
                array_to_string(parts[1:i], '/')), ' ') AS crumb_urls
        FROM p""",
)
def page_address(spark, sf):
    pages = spark_facts(_FORMS, spark, sf, "pages").withColumn("url", F.expr(printed("url")))
    parts = pages.select(
        "*", F.expr(path_parts("url")).alias(pf.PARTS), F.expr(base_parts("url")).alias(pf.BASE)
    )
    return parts.select(
        "page_id", "url",
        F.expr(pf.slug()).alias("slug"),
        F.expr(pf.path_title(0)).alias("city"),
        F.expr(pf.path_title(1)).alias("category"),
        F.expr(pf.breadcrumbs()).alias("b"),
    ).select(
        "page_id", "url", "slug", "city", "category",
        F.array_join("b.text", " > ").alias("crumbs"),
        F.array_join("b.url", " ").alias("crumb_urls"),
    )


_LINKS = (
    "SELECT page_id, url, "
    + pick(
        "page_id", "'/a/b.jpg'", "'img.jpg'", "'../up/x.png'", "'?q=1'", "'//cdn.example.com/y'",
        "'data:image/png;base64,AA'", "''", "'https://Other.example.com'", "'mailto:x@example.com'",
        "'/with blank.png'",
    )
    + " AS link FROM <t:pages>"
)


@query(
    "url_absolute",
    f"""WITH l AS (SELECT *, regexp_extract(url, '^[a-z]+://[^/?#]*') AS root,
            regexp_extract(url, '^([a-z]+:)', 1) AS scheme,
            coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), ''), '/') AS path
            FROM ({oracle_facts(_LINKS, 'pages')})),
        d AS (SELECT *, regexp_replace(path, '[^/]*$', '') AS dir FROM l)
        SELECT page_id, link, CASE link
            WHEN '/a/b.jpg' THEN root || link
            WHEN 'img.jpg' THEN root || dir || link
            WHEN '../up/x.png' THEN root || regexp_replace(dir, '[^/]+/$', '') || 'up/x.png'
            WHEN '?q=1' THEN root || path || link
            WHEN '//cdn.example.com/y' THEN scheme || link
            WHEN 'https://Other.example.com' THEN 'https://other.example.com/'
            WHEN 'mailto:x@example.com' THEN link
            WHEN '/with blank.png' THEN root || '/with%20blank.png'
            ELSE '' END AS resolved
        FROM d""",
)
def url_absolute(spark, sf):
    links = spark_facts(_LINKS, spark, sf, "pages")
    return links.select("page_id", "link", F.expr(absolute("link", "url")).alias("resolved"))


@query(
    "response_key",
    """SELECT page_id, coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), ''), '/')
       || regexp_extract(url, '^[^?#]*(\\?[^#]*)', 1) AS key FROM pages""",
)
def keys(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.expr(response_key("url")).alias("key"))


_SRCSETS = (
    "SELECT event_id, concat('s', CAST(event_id AS <string>), '.jpg ', CAST(event_id % 7 * 100 AS <string>), 'w, '"
    ", 'm.jpg ', CAST(event_id % 5 * 150 AS <string>), 'w,  l.jpg   ', CAST(event_id % 3 * 300 AS <string>), "
    "'w , x.jpg') AS srcset FROM <t:events>"
)


@query(
    "srcset_pick",
    f"""WITH c AS (SELECT event_id, unnest(list_value(
            struct_pack(i := 1, w := event_id % 7 * 100, u := 's' || event_id || '.jpg'),
            struct_pack(i := 2, w := event_id % 5 * 150, u := 'm.jpg'),
            struct_pack(i := 3, w := event_id % 3 * 300, u := 'l.jpg'),
            struct_pack(i := 4, w := 0, u := 'x.jpg')), recursive := true) FROM events)
        SELECT event_id, u AS picked FROM c
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY w DESC, i) = 1""",
)
def srcset(spark, sf):
    return spark_facts(_SRCSETS, spark, sf, "events").select(
        "event_id", F.expr(srcset_pick("srcset")).alias("picked")
    )


_BODIES = (
    "SELECT event_id, "
    + pick("event_id", "props", "substr(props, 1, 4)", "'null'", "concat('[', props, ']')", """concat('{"k":-1,', substr(props, 2))""")
    + " AS body FROM <t:events>"
)


@query(
    "json_lenient",
    f"""SELECT event_id, TRY_CAST(body AS JSON) IS NOT NULL AS readable,
        TRY_CAST(json_extract_string(TRY_CAST(replace(body, '"k":-1,', '') AS JSON), '$.k') AS BIGINT) AS k
        FROM ({oracle_facts(_BODIES, 'events')})""",
)
def json_lenient(spark, sf):
    from excursio.functions.text import json_or_null, repeated_keys

    repeated_keys(spark)
    parsed = spark_facts(_BODIES, spark, sf, "events").select(
        "event_id", F.expr(json_or_null("body")).alias("j")
    )
    return parsed.select(
        "event_id",
        F.col("j").isNotNull().alias("readable"),
        F.expr("try_variant_get(j, '$.k', 'bigint')").alias("k"),
    )
