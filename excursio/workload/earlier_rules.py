"""Queries for the earlier generation of page rules (``rules="v3"``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from excursio.settings import Settings
from excursio.workload.listings import _O, _html, _t, listed, listing_raw
from excursio.workload.registry import each_row, query

V3 = Settings(rules="v3")

_TOP = (
    "CASE WHEN k % 4 = 0 THEN "
    + _t("""<header><h1>{nm}</h1></header><p>{long_text}, the short one</p>"""
         """<p>{long_text}, then back along the river to where the walk began</p><h2>x</h2>""")
    + " ELSE "
    + _t("""<main><div class="a"><div class="b"><span><h1>{nm}</h1></span></div>"""
         """<p>{long_text}, then back along the river</p><p>Your cart {long_text} {long_text}</p>"""
         """<p>{short_text}</p></div><p>Beside the box {long_text} {long_text}</p></main>""")
    + " END"
)
_ROW = (
    "CASE WHEN k % 3 = 0 THEN "
    + _t("""<button class="rounded border min-w-fit">Tab {sz}</button><div class="flex gap-2"><button>Other</button></div>""")
    + " ELSE "
    + _t("""<div class="flexible gap-2"><button>Wrong</button></div><div class="x  flex gap-3"><button>Row {sz}</button>"""
         """<button>ab</button><button> {ty} </button></div>""")
    + " END"
)
_ACCORDION = (
    "CASE WHEN k % 4 = 1 THEN "
    + _t("""<div><div class="flex"><h2> Highlights </h2></div><div><p>Everything on {nm}</p><span>tiny</span></div></div>""")
    + " ELSE "
    + _t("""<div><div class="flex"><h2>Highlights</h2></div><div><ul><li>See {nm}</li><li>five5</li>"""
         """<li>See {nm}</li><li>Meet {br}</li></ul></div></div><ul><li>Not in there</li></ul>""")
    + " END"
)
_MARKED = _t(
    """<div><img alt="INCLUSIONS"><span>Pass {sz}</span></div><div><img alt="INCLUSIONS"><span>abc</span></div>"""
    """<div><img alt="Inclusions"><span>Later rule</span></div><div><img alt="Exclusions"><span>Food {ty}</span></div>"""
)
_TERMS = (
    "CASE WHEN k % 5 = 0 THEN "
    + _t("""<section><div><div><div><h2>Terms</h2></div></div></div><ul><li>Too far away</li></ul></section>""")
    + " ELSE "
    + _t("""<section><div><div><h2>The Terms</h2></div></div><ul><li>Carry {br}</li><li>short</li><li>Carry {br}</li></ul></section>""")
    + " END"
)
_PLACE = _t(
    """<section><div><h2>Location</h2></div><span>Road {sz}</span><p>Location Details</p>"""
    """<a href="https://www.google.com/maps?query={sz}.5%2C-7.25">Get Directions</a></section>"""
)
_QUESTIONS = (
    "CASE WHEN k % 3 = 1 THEN "
    + _t("""<div><h3>FAQ</h3><details><summary>Q {sz}</summary><p>A {br}</p></details><i></i><i></i></div>""")
    + " ELSE "
    + _t("""<details><summary>Size of {nm}?</summary><i>It is</i><b>{sz}</b></details>"""
         """<details><summary>Nothing</summary></details><details><p>No question</p></details>""")
    + " END"
)
_PAGE = _html("'<html><body>'", _TOP, _ROW, _ACCORDION, _MARKED, _TERMS, _PLACE, _QUESTIONS)


def earlier(spark, sf):
    return listing_raw(spark, sf, V3, _PAGE)


@query(
    "earlier_description",
    f"""SELECT page_id, CASE WHEN k % 4 = 0
            THEN CASE WHEN length(long_text || ', the short one') > 80
                 THEN long_text || ', the short one' || chr(10) || chr(10) ELSE '' END
                 || long_text || ', then back along the river to where the walk began'
        ELSE long_text || ', then back along the river' END AS full_text
        FROM {_O}""",
)
def description(spark, sf):
    return earlier(spark, sf).select("page_id", F.col("description.full").alias("full_text"))


@query(
    "earlier_lists",
    f"""SELECT page_id,
        CASE WHEN k % 3 = 0 THEN 'Tab ' || sz ELSE 'Row ' || sz || '|' || ty END AS tabs,
        CASE WHEN k % 4 = 1 THEN 'Everything on ' || nm
             ELSE {listed("'See ' || nm", "'Meet ' || br")} END AS highlights,
        'Pass ' || sz AS inclusions, 'Food ' || ty AS exclusions,
        CASE WHEN k % 5 = 0 THEN '' ELSE 'Carry ' || br END AS terms FROM {_O}""",
)
def lists(spark, sf):
    names = ("tabs", "highlights", "inclusions", "exclusions", "terms")
    return earlier(spark, sf).select("page_id", *[F.array_join(c, "|").alias(c) for c in names])


@query(
    "earlier_location",
    f"""SELECT page_id, 'Road ' || sz AS address, CAST(sz || '.5' AS DOUBLE) AS latitude,
        CAST(-7.25 AS DOUBLE) AS longitude FROM {_O}""",
)
def place(spark, sf):
    return earlier(spark, sf).select(
        "page_id", "location.address", "location.latitude", "location.longitude"
    )


@query(
    "earlier_faq",
    f"""SELECT page_id, CASE WHEN k % 3 = 1 THEN 'Q ' || sz ELSE 'Size of ' || nm || '?' END AS question,
        CASE WHEN k % 3 = 1 THEN 'A ' || br ELSE 'It is ' || sz END AS answer FROM {_O}""",
)
def questions(spark, sf):
    return each_row(earlier(spark, sf), "faq", "f").select(
        "page_id", "f.question", "f.answer"
    )
