"""Queries over experience pages that Spark renders from the part table.

The captured pages hold none of the sections the field rules look for, so every
part becomes one full page here: the same columns ("facts") feed the markup on
Spark and the expected values in the oracle, which never sees markup.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from excursio.operators import page_fields as pf
from excursio.settings import Settings
from excursio.sources.pages import page_nodes
from excursio.workload.registry import each_row, oracle_facts, pick, query, spark_facts

_K = "CAST(p_partkey AS <string>)"
FACTS = f"""
    SELECT p_partkey AS page_id, p_partkey AS k, {_K} AS ks, p_name AS nm, p_brand AS br,
        p_type AS ty, CAST(p_size AS BIGINT) AS sz,
        CAST(CAST(floor(p_retailprice) AS BIGINT) AS <string>) AS price,
        {pick("p_partkey", "'kolkata'", "'new-delhi'", "'goa'")} AS city_seg,
        {pick("p_partkey", "'culture-and-heritage'", "'water-parks'", "'night-life'")} AS cat_seg,
        concat(replace(p_name, ' ', '-'), '-', {_K}) AS slug,
        concat('https://travel.example.com/',
            {pick("p_partkey", "'kolkata'", "'new-delhi'", "'goa'")}, '/',
            {pick("p_partkey", "'culture-and-heritage'", "'water-parks'", "'night-life'")}, '/',
            replace(p_name, ' ', '-'), '-', {_K}) AS url,
        concat('https://travel.example.com/',
            {pick("p_partkey", "'kolkata'", "'new-delhi'", "'goa'")}, '/',
            {pick("p_partkey", "'culture-and-heritage'", "'water-parks'", "'night-life'")}, '/') AS dir,
        concat('Walk past the ', p_name, ' made by ', p_brand) AS long_text,
        concat('Short ', p_type) AS short_text
    FROM <t:part>"""


def _html(*pieces: str) -> str:
    return "concat(" + ", ".join(pieces) + ")"


def _t(markup: str) -> str:
    """Literal markup with {column} holes."""
    parts, rest = [], markup
    while rest:
        before, _, rest = rest.partition("{")
        if before:
            parts.append("'" + before.replace("'", "''").replace("\n", "\\n") + "'")
        if rest:
            hole, _, rest = rest.partition("}")
            parts.append(hole)
    return "concat(" + ", ".join(parts) + ")"


HEAD = _html(
    _t("""<!DOCTYPE html><html lang="en-IN"><head><title>  {nm}\n &amp; {br} </title>"""),
    _t("""<meta name="robots" content="index"><meta name="theme-color" content="#00{sz}">"""),
    "CASE WHEN k % 7 <> 0 THEN "
    + _t("""<meta property="og:image" content="https://img.example.com/{ks}/a.jpg">"""
         """<meta property="og:title" content="{nm}">"""
         """<meta property="og:image" content="https://img.example.com/{ks}/z.jpg">""")
    + " ELSE '' END",
    "CASE WHEN k % 3 = 0 THEN " + _t("""<META NAME=description CONTENT='See {nm}'>""") + " ELSE '' END",
    _t("""<meta name="twitter:card" content="summary"><meta property="twitter:site" content="@{br}">"""
       """<meta name="twitter:card" content="card {ks}">"""),
    _t("""<link rel="Canonical" href="/c/{ks}"><link rel="icon" href="/f{sz}.ico" sizes="16x16">"""
       """<link rel="mask-icon" href="/m.svg"><link rel="shortcut icon" href="s.ico">"""),
    _t("""<script type="application/ld+json">{'{'}"@type":"Place","n":{ks}}</script>"""),
    "CASE WHEN k % 2 = 0 THEN '<script type=\"application/ld+json\">{bad</script>' ELSE "
    "'<script type=\"application/ld+json\">{\"@type\":\"Thing\"}</script>' END",
    _t("""<script type="application/ld+json">{'{'}"@type":"Place","n":{ks}0}</script>"""),
    _t("""<script type="Application/LD+JSON">{'{'}"sz":0,"sz":{sz}}</script>"""),
    "'<script>var a = \"<img src=x.jpg>\";</script></head>'",
)

OVERVIEW = (
    "CASE WHEN k % 5 <> 0 THEN "
    + _t("""<section id="overview"><p>{long_text}</p><p>{short_text}<p>Select a date for {long_text}"""
         """<p>{long_text}  &nbsp;again</section><p>Outside of the section {long_text}</p>""")
    + " ELSE "
    + _t("""<div><p>{short_text}</p><p>{long_text} and then walk back to where it began</p>"""
         """<h2>Plan</h2><p>After the heading {long_text} and back to where it began</p></div>""")
    + " END"
)
LISTS = _html(
    _t("""<template><p>Hidden paragraph of {nm} that is long enough to be taken for text</p><img src="/hidden.jpg">"""
       """<template><h3>Entry Ticket</h3></template><script>"</template>"</script><h2>FAQ</h2></template>"""),
    "CASE WHEN k % 4 <> 0 THEN "
    + _t("""<section id="highlights"><h2>Highlights</h2><ul><li>{nm}<li>{br} guide</li><li>abc</li>"""
         """<li> {nm} </li><li>{ty} tour</ul></section>""")
    + " ELSE "
    + _t("""<section id="highlights"><span>Highlights</span><p>All about {nm}</p><span>tiny</span>"""
         """<span>All about {nm}</span></section>""")
    + " END",
    _t("""<div class="x"><img src="/i.svg" alt="INCLUSIONS"><span>{br} ticket</span><span>no</span></div>"""
       """<div><img src="/i.svg" alt="Inclusions"><b><span>Map of {nm}</span></b></div>"""
       """<div><img src="/i.svg" alt="INCLUSIONS"><span>{br} ticket</span></div>"""
       """<div><img src="/i.svg" alt="Inclusions"><span>ab</span></div>"""
       """<div><img src="/e.svg" alt="Exclusions"><span>Meals {ty}</span></div>"""
       """<div><img src="/e.svg" alt="EXCLUSIONS"><i>no span</i></div>"""),
    "CASE WHEN k % 3 <> 1 THEN "
    + _t("""<section id="terms_and_condtions"><ul><li>Carry ID {sz}</li><li>{'Non-Refundable'}</li>"""
         """<li>Ok</li></ul></section>""")
    + " ELSE "
    + _t("""<section id="my_terms"><p>Terms &amp; Conditions of {br}</p><p>Entry closes for {ty}</p></section>""")
    + " END",
)
PACKAGE = (
    "CASE WHEN k % 6 = 0 THEN '<h3>Nothing here</h3>' WHEN k % 6 = 1 THEN "
    + _t("""<div class="outer"><svg/><b></b><div><h3>{nm} Package</h3></div><p>₹{price}.50</p></div>""")
    + " ELSE "
    + _t("""<div><svg viewBox="0 0 1 1"><title>Icon</title><path d="M0"/><circle/></svg><h3>Entry  Ticket {br}</h3><p>₹ {price} now ₹ {price}</p><p>or ₹{sz}</p>"""
         """<ul class="highlightList"><li>Valid for {nm}</li><li>tiny</li></ul></div>""")
    + " END"
)
LOCATION = (
    "CASE WHEN k % 4 = 2 THEN "
    + _t("""<a href="https://www.google.com/maps?query=10.{sz}%2C-20.5">map</a>""")
    + " WHEN k % 4 = 3 THEN '' ELSE "
    + _t("""<section id="location"><span>Location Details</span><p>Road {sz}</p><span>{br}</span>"""
         """<p>Road {sz}</p><a href="https://www.google.com/maps?query={sz}.25%2C88.{sz}&amp;z=1">"""
         """<span>Get Directions</span></a></section>""")
    + " END"
)
NEARBY = (
    "CASE WHEN k % 8 = 0 THEN '<h2>Elsewhere</h2>' ELSE "
    + _t("""<div class="near"><div><h2>You Might Also Like</h2></div>"""
         """<a href="/go/{ks}"><img alt="{nm}" data-src="/n/{ks}.jpg"><span>₹ {price}</span>"""
         """<span>{br} CITY</span><div>4.{sz} stars</div></a>"""
         """<a href="rel/{sz}"><p>{ty}</p><span>4.5</span><span>KOLKATA</span></a>"""
         """<a href="/again"><svg/><span>{ty}</span></a><a href="#top"><p>No slash</p></a></div>""")
    + " END"
)
FAQ = (
    "CASE WHEN k % 5 = 4 THEN '' ELSE "
    + _t("""<div class="faq"><h2>FAQs about {nm}</h2><details><summary>Where is {br}?</summary>"""
         """<p>In {city_seg}</p></details><details><summary>No answer</summary></details>"""
         """<div data-state="open"><button>How big?</button><div class="my-content">Size <b>{sz}</b></div></div>"""
         """</div>""")
    + " END"
)
IMAGES = _t(
    """<img src="/g/{ks}.jpg" alt="{nm}" title="{br}" width="640px" height=480>"""
    """<img src="s.jpg" srcset="s.jpg 320w, l{sz}.jpg 1280w, m.jpg"><img src="/g/{ks}.jpg">"""
    """<img src="https://cdn.delite/{ks}.png" alt="H"><img src="//cdn.rzervit.example/{sz}.png">"""
    """<img src="data:image/png;base64,cdn.delite"><img src="/brand-logo.png"><img src="/arrow-down.png">"""
    """<img data-src="/lazy{sz}.webp">"""
)
TABS = _t(
    """<button class="rounded-lg border min-w-fit px-2">Tab {sz}</button>"""
    """<button class="rounded border min-w-fit">A tab label that is far too long {nm}</button>"""
    """<button class="rounded border">Not a tab</button><h2>{ty} area</h2><h2> {ty}  area</h2>"""
)
PAGE = _html(
    HEAD, "'<body><header>'", _t("""<h1> {nm}  <i>by</i> {br}</h1>"""), "'</header>'", OVERVIEW,
    LISTS, PACKAGE, LOCATION, NEARBY, FAQ, IMAGES, TABS, "'<footer>End</footer></body></html>'",
)


def rendered(spark, sf, page: str = PAGE):
    facts = spark_facts(FACTS, spark, sf, "part", deal="p_partkey")
    return facts.select("page_id", "url", F.expr(page).alias("html"))


def listing_raw(spark, sf, settings=Settings(), page: str = PAGE):
    return pf.extract(page_nodes(rendered(spark, sf, page)), settings)


_O = f"({oracle_facts(FACTS, 'part')})"
_JOIN = "array_to_string(list_filter({0}, lambda x: x IS NOT NULL), '{1}')"


def listed(*items: str, sep: str = "|") -> str:
    """Oracle list of distinct texts in order of first occurrence, joined."""
    values = "list_value(" + ", ".join(items) + ")"
    firsts = (
        f"list_filter({values}, lambda x, i: x IS NOT NULL AND list_position({values}, x) = i)"
    )
    return f"array_to_string({firsts}, '{sep}')"


@query(
    "field_hero",
    f"""SELECT page_id, nm || ' by ' || br AS name,
        CASE city_seg WHEN 'kolkata' THEN 'Kolkata' WHEN 'goa' THEN 'Goa' ELSE 'New Delhi' END AS city,
        CASE k % 3 WHEN 0 THEN 'Culture And Heritage' WHEN 1 THEN 'Water Parks' ELSE 'Night Life' END AS category,
        CASE WHEN k % 7 <> 0 THEN 'https://img.example.com/' || ks || '/a.jpg' ELSE '' END AS cover,
        'https://cdn.delite/' || ks || '.png' AS hero
        FROM {_O}""",
)
def field_hero(spark, sf):
    return listing_raw(spark, sf).select(
        "page_id", "hero.name", "hero.city", "hero.category",
        F.col("hero.coverImage").alias("cover"), F.col("hero.heroImage").alias("hero"),
    )


@query(
    "field_hero_images",
    f"""SELECT page_id, unnest(list_value('https://cdn.delite/' || ks || '.png',
            'https://cdn.rzervit.example/' || sz || '.png')) AS image,
        unnest(list_value(1, 2)) AS sequence, unnest(list_value('H', '')) AS alt FROM {_O}""",
)
def field_hero_images(spark, sf):
    return each_row(listing_raw(spark, sf), "hero.images", "i").select(
        "page_id", F.col("i.url").alias("image"), "i.sequence", "i.alt"
    )


@query(
    "field_description",
    f"""SELECT page_id, CASE WHEN k % 5 <> 0
            THEN CASE WHEN length(long_text) > 30 THEN long_text || chr(10) || chr(10) ELSE '' END
                 || long_text || ' again'
            ELSE long_text || ' and then walk back to where it began' END AS full_text
        FROM {_O}""",
)
def field_description(spark, sf):
    return listing_raw(spark, sf).select("page_id", F.col("description.full").alias("full_text"))


@query(
    "field_highlights",
    f"""SELECT page_id, CASE WHEN k % 4 <> 0 THEN {listed('nm', "br || ' guide'", "ty || ' tour'")}
        ELSE 'All about ' || nm END AS highlights FROM {_O}""",
)
def field_highlights(spark, sf):
    return listing_raw(spark, sf).select("page_id", F.array_join("highlights", "|").alias("highlights"))


@query(
    "field_inclusions",
    f"""SELECT page_id, {listed("br || ' ticket'", "'Map of ' || nm")} AS inclusions,
        'Meals ' || ty AS exclusions FROM {_O}""",
)
def field_inclusions(spark, sf):
    return listing_raw(spark, sf).select(
        "page_id", F.array_join("inclusions", "|").alias("inclusions"),
        F.array_join("exclusions", "|").alias("exclusions"),
    )


@query(
    "field_terms",
    f"""SELECT page_id, CASE WHEN k % 3 <> 1 THEN 'Carry ID ' || sz || '|Non-Refundable'
        ELSE 'Entry closes for ' || ty END AS terms FROM {_O}""",
)
def field_terms(spark, sf):
    return listing_raw(spark, sf).select("page_id", F.array_join("terms", "|").alias("terms"))


@query(
    "field_tickets",
    f"""SELECT page_id, CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN '₹' || price
            ELSE {listed("'₹ ' || price", "'₹' || sz")} END AS prices,
        CASE WHEN k % 6 <> 0 THEN 'INR' END AS currency,
        CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN nm || ' Package' ELSE 'Entry Ticket ' || br END AS package,
        CASE WHEN k % 6 > 1 THEN 'Valid for ' || nm END AS details FROM {_O}""",
)
def field_tickets(spark, sf):
    return listing_raw(spark, sf).select(
        "page_id", F.array_join("ticketPrices.prices", "|").alias("prices"),
        F.col("ticketPrices.currency").alias("currency"),
        F.col("ticketPrices.packageName").alias("package"),
        F.array_join("ticketPrices.packageDetails", "|").alias("details"),
    )


@query(
    "field_location",
    f"""SELECT page_id, CASE WHEN k % 4 < 2 THEN {listed("'Road ' || sz", "br", sep=', ')} END AS address,
        CASE k % 4 WHEN 2 THEN 'https://www.google.com/maps?query=10.' || sz || '%2C-20.5' WHEN 3 THEN NULL
            ELSE 'https://www.google.com/maps?query=' || sz || '.25%2C88.' || sz || '&z=1' END AS link,
        CASE k % 4 WHEN 2 THEN CAST('10.' || sz AS DOUBLE) WHEN 3 THEN NULL ELSE sz + 0.25 END AS latitude,
        CASE k % 4 WHEN 2 THEN -20.5 WHEN 3 THEN NULL ELSE CAST('88.' || sz AS DOUBLE) END AS longitude
        FROM {_O}""",
)
def field_location(spark, sf):
    return listing_raw(spark, sf).select(
        "page_id", "location.address", F.col("location.googleMapsLink").alias("link"),
        "location.latitude", "location.longitude",
    )


@query(
    "field_nearby",
    f"""WITH o AS (SELECT * FROM {_O} WHERE k % 8 <> 0),
        c AS (SELECT page_id, 1 AS pos, nm AS name, 'https://travel.example.com/go/' || ks AS url,
                  'https://travel.example.com/n/' || ks || '.jpg' AS image, '₹ ' || price AS price,
                  CASE WHEN br || ' CITY' = upper(br || ' CITY') THEN br || ' CITY' ELSE '' END AS location,
                  '4.' || sz || ' stars' AS rating FROM o
              UNION ALL SELECT page_id, 2, ty, dir || 'rel/' || sz, '', '',
                  CASE WHEN ty = upper(ty) AND length(ty) > 2 THEN ty ELSE '4.5' END, '4.5' FROM o)
        SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY page_id, name ORDER BY pos) = 1""",
)
def field_nearby(spark, sf):
    cards = each_row(listing_raw(spark, sf), "nearbyAttractions", "c")
    return cards.select(
        "page_id", (F.col("pos") + 1).alias("pos"), "c.name", "c.url", "c.image", "c.price",
        "c.location", "c.rating",
    )


@query(
    "field_faq",
    f"""SELECT page_id, unnest(list_value('Where is ' || br || '?', 'How big?')) AS question,
        unnest(list_value('In ' || city_seg, 'Size ' || sz)) AS answer FROM {_O} WHERE k % 5 <> 4""",
)
def field_faq(spark, sf):
    return each_row(listing_raw(spark, sf), "faq", "f").select(
        "page_id", "f.question", "f.answer"
    )


@query(
    "field_gallery",
    f"""WITH c AS (SELECT page_id, k, unnest(list_value(
            CASE WHEN k % 8 <> 0 THEN 'https://travel.example.com/n/' || ks || '.jpg' END,
            'https://travel.example.com/g/' || ks || '.jpg', dir || 'l' || sz || '.jpg',
            'https://cdn.delite/' || ks || '.png', 'https://cdn.rzervit.example/' || sz || '.png',
            'https://travel.example.com/lazy' || sz || '.webp')) AS url,
            unnest(list_value(nm, nm, '', 'H', '', '')) AS alt,
            unnest(list_value('', br, '', '', '', '')) AS caption,
            unnest(list_value(0, 640, 0, 0, 0, 0)) AS width,
            unnest(list_value(0, 480, 0, 0, 0, 0)) AS height,
            unnest(list_value(1, 2, 3, 4, 5, 6)) AS pos FROM {_O})
        SELECT page_id, url, alt, caption, width, height,
            row_number() OVER (PARTITION BY page_id ORDER BY pos) AS sequence
        FROM c WHERE url IS NOT NULL""",
)
def field_gallery(spark, sf):
    return each_row(listing_raw(spark, sf), "gallery", "g").select(
        "page_id", "g.url", "g.alt", "g.caption", "g.width", "g.height",
        F.col("g.sequence").cast("bigint").alias("sequence"),
    )


@query(
    "field_seo",
    f"""SELECT page_id, nm || ' & ' || br AS title,
        CASE WHEN k % 3 = 0 THEN 'See ' || nm ELSE '' END AS description,
        'https://travel.example.com/c/' || ks AS canonical, 'index' AS robots, 'en-IN' AS language,
        '#00' || sz AS theme FROM {_O}""",
)
def field_seo(spark, sf):
    return listing_raw(spark, sf).select(
        "page_id", "seo.title", F.col("seo.metaDescription").alias("description"), "seo.canonical",
        "seo.robots", "seo.language", F.col("seo.themeColor").alias("theme"),
    )


@query(
    "field_social",
    f"""SELECT page_id, CASE WHEN k % 7 <> 0 THEN 'https://img.example.com/' || ks || '/z.jpg' END AS og_image,
        CASE WHEN k % 7 <> 0 THEN nm END AS og_title, 'card ' || ks AS twitter_card,
        '@' || br AS twitter_site, CASE WHEN k % 7 <> 0 THEN 2 ELSE 0 END AS n_og FROM {_O}""",
)
def field_social(spark, sf):
    return listing_raw(spark, sf).select(
        "page_id",
        F.expr("try_element_at(seo.openGraph, 'og:image')").alias("og_image"),
        F.expr("try_element_at(seo.openGraph, 'og:title')").alias("og_title"),
        F.expr("try_element_at(seo.twitterCard, 'twitter:card')").alias("twitter_card"),
        F.expr("try_element_at(seo.twitterCard, 'twitter:site')").alias("twitter_site"),
        F.expr("size(seo.openGraph)").alias("n_og"),
    )


@query(
    "field_favicons",
    f"""SELECT page_id, unnest(list_value('icon', 'shortcut icon')) AS rel,
        unnest(list_value('https://travel.example.com/f' || sz || '.ico', dir || 's.ico')) AS href,
        unnest(list_value('16x16', '')) AS sizes FROM {_O}""",
)
def field_favicons(spark, sf):
    return each_row(listing_raw(spark, sf), "seo.favicons", "f").select(
        "page_id", "f.rel", "f.href", "f.sizes"
    )


@query(
    "field_structured_data",
    f"""SELECT page_id, unnest(CASE WHEN k % 2 = 0 THEN list_value('Place', 'schema_3')
                               ELSE list_value('Place', 'Thing', 'schema_3') END) AS name,
        unnest(CASE WHEN k % 2 = 0 THEN list_value(CAST(ks || '0' AS BIGINT), NULL)
               ELSE list_value(CAST(ks || '0' AS BIGINT), NULL, NULL) END) AS n,
        unnest(CASE WHEN k % 2 = 0 THEN list_value(NULL, sz) ELSE list_value(NULL, NULL, sz) END) AS sz
        FROM {_O}""",
)
def field_structured_data(spark, sf):
    entries = listing_raw(spark, sf).select(
        "page_id", F.explode_outer("structuredData").alias("name", "v")
    ).filter("name IS NOT NULL")
    return entries.select(
        "page_id", "name",
        F.expr("try_variant_get(v, '$.n', 'bigint')").alias("n"),
        F.expr("try_variant_get(v, '$.sz', 'bigint')").alias("sz"),
    )


@query(
    "field_tabs_sections",
    f"""SELECT page_id, 'Tab ' || sz AS tabs, {listed(
        "CASE WHEN k % 5 = 0 THEN 'Plan' END", "CASE WHEN k % 4 <> 0 THEN 'Highlights' END",
        "CASE WHEN k % 8 = 0 THEN 'Elsewhere' ELSE 'You Might Also Like' END",
        "CASE WHEN k % 5 <> 4 THEN 'FAQs about ' || nm END", "ty || ' area'")} AS sections FROM {_O}""",
)
def field_tabs_sections(spark, sf):
    return listing_raw(spark, sf).select(
        "page_id", F.array_join("tabs", "|").alias("tabs"), F.array_join("sections", "|").alias("sections")
    )


@query(
    "field_metadata",
    f"""SELECT page_id, '2026-01-01T00:00:00.000Z' AS scraped_at, url AS page_url,
        CASE WHEN k % 8 = 0 THEN 5 ELSE 6 END AS images FROM {_O}""",
)
def field_metadata(spark, sf):
    return listing_raw(spark, sf).select(
        "page_id", F.col("metadata.scrapedAt").alias("scraped_at"),
        F.col("metadata.pageUrl").alias("page_url"), F.col("metadata.totalImages").alias("images"),
    )
