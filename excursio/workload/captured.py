"""Queries over the captured pages as they are."""

from __future__ import annotations

from pyspark.sql import functions as F

from excursio.functions.nodes import attr
from excursio.operators import page_fields as pf
from excursio.operators import records, report
from excursio.settings import Settings
from excursio.sources.pages import page_nodes, page_rejects, read_pages, spread
from excursio.workload.registry import clean_sql, cores, first_sql, query, title_sql

# Oracle form of a page without comments, scripts and styles.
_BARE = (
    "regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), "
    "'<(script|style)[^>]*>.*?</(script|style)>', '', 'gs')"
)


def decode_sql(x: str) -> str:
    """Oracle form of tag removal and entity decoding."""
    plain = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                         ("&nbsp;", "\u00a0"), ("&amp;", "&")):
        plain = f"replace({plain}, '{entity}', '{char}')"
    return plain


# The category words written out once more, so that a wrong one in the settings shows.
_CATEGORY_WORDS = """
museums: museum gallery
religious-sites: temple shrine church mosque spiritual religious aarti kashi
historical-monuments: monument fort palace heritage history culture
theme-parks: theme&park
parks: park
gardens: garden
zoos: zoo safari wildlife
beaches: beach
islands: island
rivers: river boat ganges ghat
mountains: mountain
hills: hill
lakes: lake
water-sports: water diving kayak rafting
tours: tour walk sightseeing expedition
sports: sport outdoor trek
transportation: transport taxi cab transfer
entertainment: show event entertainment leisure music
"""


def category_sql(category: str, name: str, slug: str) -> str:
    """Oracle form of the category rules."""
    text = f"lower(coalesce({category}, '') || ' ' || coalesce({name}, '') || ' ' || coalesce({slug}, ''))"
    arms = " ".join(
        "WHEN " + " OR ".join(
            "(" + " AND ".join(f"contains({text}, '{w}')" for w in word.split("&")) + ")"
            for word in words.split()
        ) + f" THEN '{to}'"
        for to, words in (line.split(":") for line in _CATEGORY_WORDS.strip().splitlines())
    )
    return f"CASE {arms} ELSE 'attractions' END"


def raw_pages(spark, sf, settings=Settings()):
    return pf.extract(nodes(spark, sf), settings)


def nodes(spark, sf):
    return page_nodes(spread(read_pages(spark, f"{sf}/pages.parquet"), cores(spark)))


_H1 = clean_sql(decode_sql("regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's')"))
_TITLE = clean_sql(decode_sql("regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 's')"))
_PARTS = (
    "list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), "
    "lambda s: s <> '')"
)
_PARAGRAPHS = f"""
    SELECT page_id, string_agg(t, chr(10) || chr(10) ORDER BY pos) AS full_text FROM (
        SELECT page_id, pos, {clean_sql(decode_sql('seg'))} AS t FROM (
            SELECT page_id, unnest(segs) AS seg, generate_subscripts(segs, 1) AS pos FROM (
                SELECT page_id, list_transform(string_split({_BARE}, '<p>')[2:],
                    lambda s: regexp_replace(s, '(</p>|</article>|<div|<footer).*', '', 's')) AS segs
                FROM pages)))
    WHERE length(t) > 50 GROUP BY page_id"""


@query(
    "page_rejects",
    """SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN url END AS url,
        CASE WHEN page_id % 3 = 0 THEN 'no url' ELSE 'no html' END AS reason
        FROM pages WHERE page_id % 3 = 0 OR page_id % 5 = 0""",
)
def rejects(spark, sf):
    """A third of the pages without address, a fifth without markup."""
    pages = read_pages(spark, f"{sf}/pages.parquet")
    return page_rejects(pages.select(
        "page_id", F.expr("CASE WHEN page_id % 3 <> 0 THEN url END AS url"),
        F.expr("CASE WHEN page_id % 5 <> 0 THEN html END AS html"),
    ))


@query(
    "node_tags",
    f"""SELECT tag, count(*) AS n FROM (
        SELECT unnest(regexp_extract_all({_BARE.replace("'gs'), ", "'gs'), ", 1)},
                                         '<([a-z][a-z0-9]*)', 1)) AS tag FROM pages
        UNION ALL SELECT unnest(regexp_extract_all(regexp_replace(html, '<!--.*?-->', '', 'gs'),
                                '<(script|style)', 1)) FROM pages) GROUP BY tag""",
)
def node_tags(spark, sf):
    tags = nodes(spark, sf).select(F.explode("nodes.tag").alias("tag"))
    return tags.groupBy("tag").agg(F.count("*").alias("n"))


@query(
    "node_links",
    f"""SELECT page_id, pos, m[1] AS href, m[2] AS label FROM (
        SELECT page_id, unnest(ms) AS m, generate_subscripts(ms, 1) AS pos FROM (
            SELECT page_id, list_transform(
                regexp_extract_all({_BARE}, '<a href="[^"]*">[^<]*</a>'),
                lambda s: list_value(regexp_extract(s, 'href="([^"]*)"', 1),
                    {clean_sql(decode_sql('s'))})) AS ms FROM pages))""",
)
def node_links(spark, sf):
    staged = pf.stage(nodes(spark, sf))
    links = staged.select("page_id", "page_text", F.posexplode(pf.ANCHORS).alias("pos", "n"))
    return links.select(
        "page_id",
        (F.col("pos") + 1).cast("bigint").alias("pos"),
        F.expr(attr("n", "href")).alias("href"),
        F.expr(pf.text_of("n")).alias("label"),
    )


@query(
    "node_nesting",
    """SELECT count(*) AS pages, CAST(0 AS BIGINT) AS outside_parent,
       CAST(0 AS BIGINT) AS wrong_children FROM pages""",
)
def node_nesting(spark, sf):
    """Every element lies inside its parent, and children add up."""
    flat = nodes(spark, sf).select(
        F.expr(
            "size(filter(nodes, n -> n.parent >= 0 AND NOT (n.pre > nodes[n.parent].pre AND "
            "n.pre + n.size <= nodes[n.parent].pre + nodes[n.parent].size)))"
        ).alias("outside"),
        F.expr(
            "CASE WHEN aggregate(nodes, 0, (s, n) -> s + n.n_children) = size(nodes) - 1 "
            "AND nodes[0].size = size(nodes) - 1 THEN 0 ELSE 1 END"
        ).alias("wrong"),
    )
    return flat.agg(
        F.count("*").alias("pages"),
        F.sum("outside").cast("bigint").alias("outside_parent"),
        F.sum("wrong").cast("bigint").alias("wrong_children"),
    )


@query(
    "page_headline",
    f"""SELECT page_id, {_H1} AS name, {_TITLE} AS title,
        regexp_extract(html, '<html lang="([^"]*)"', 1) AS language, '' AS cover, 0 AS n_images
        FROM pages""",
)
def page_headline(spark, sf):
    return raw_pages(spark, sf).select(
        "page_id", "hero.name", "seo.title", "seo.language",
        F.col("hero.coverImage").alias("cover"), F.size("gallery").alias("n_images"),
    )


@query(
    "page_description",
    f"SELECT page_id, coalesce(full_text, '') AS full_text FROM pages LEFT JOIN ({_PARAGRAPHS}) "
    "USING (page_id)",
)
def page_description(spark, sf):
    return raw_pages(spark, sf).select("page_id", F.col("description.full").alias("full_text"))


_CATALOGUE = f"""
    SELECT page_id, slug, {_H1} AS name, city, category FROM (
        SELECT page_id, html, coalesce(parts[-1], '') AS slug,
               {first_sql(title_sql('parts[1]'), "'Kolkata'")} AS city,
               {category_sql(title_sql('parts[2]'), _H1, "coalesce(parts[-1], '')")} AS category
        FROM (SELECT page_id, html, {_PARTS} AS parts FROM pages))"""


@query(
    "page_catalogue",
    f"SELECT *, upper(substr(city, 1, 3)) AS city_code FROM ({_CATALOGUE})",
)
def page_catalogue(spark, sf):
    return records.activity(raw_pages(spark, sf)).select(
        "page_id", "slug", "name", "city", F.col("category")[0].alias("category"), "city_code"
    )


@query(
    "page_categories",
    f"SELECT category, count(*) AS pages FROM ({_CATALOGUE}) GROUP BY category",
)
def page_categories(spark, sf):
    return page_catalogue(spark, sf).groupBy("category").agg(F.count("*").alias("pages"))


TOTALS = f"""SELECT city, category, CAST(grouping(city, category) AS BIGINT) AS level, count(*) AS pages,
    CAST(0 AS BIGINT) AS images FROM (
        SELECT {title_sql('parts[1]')} AS city, {title_sql('parts[2]')} AS category
        FROM (SELECT {_PARTS} AS parts FROM pages))
    GROUP BY ROLLUP (city, category)"""


@query("page_totals", TOTALS)
def page_totals(spark, sf):
    return report.catalogue_totals(report.page_report(raw_pages(spark, sf))).select(
        "city", "category", F.col("level").cast("bigint").alias("level"), "pages", "images"
    )
