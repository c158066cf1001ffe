"""Field rules on small pages (expected values follow from reading the rules)."""

import pytest

from excursio.operators.page_fields import extract
from excursio.settings import Settings
from excursio.sources.pages import page_nodes, page_rejects

URL = "https://x.example/kolkata/culture-and-heritage/city-museum"
PAGES = {
    "overview": "<section id=overview><p>" + "a" * 30 + "</p><p>" + "b" * 31
    + "</p><p>Select a date " + "c" * 40 + "</p></section>",
    "no_overview": "<div><p>" + "d" * 51 + "</p><h2>T</h2><p>" + "e" * 60 + "</p></div>",
    "lists": "<div id=highlights><li>One item</li><li>abc</li><li>One item</li></div>"
    "<section id=terms_and_condtions><p>Terms &amp; Conditions here</p><p>A longer term</p></section>",
    "icons": '<div><img alt="INCLUSIONS"><span>Guide</span></div><div><img alt="Inclusions"><span>Map</span></div>'
    '<div><img alt="Exclusions"><span>Food</span></div>',
    "package": "<div><h3>Entry Ticket</h3><p>₹ 1,200</p><p>₹ 1,200 ₹99.50</p><ul><li>A detail</li></ul></div>",
    "location": '<section id=location><span>Main Road</span><a href="https://www.google.com/maps?query=22.5%2C88.3">'
    "Get Directions</a></section>",
    "nearby": "<div><h2>You might also like</h2><a href=/a><img alt=Zoo><span>₹ 20</span></a>"
    "<a href=/b><img alt=Zoo></a><a href=/c><span>Fort</span><span>4.5</span><span>KOLKATA</span></a></div>",
    "faq": "<div><h2>FAQ</h2><details><summary>Q</summary><p>A</p></details><details><summary>R</summary></details><hr></div>",
    "images": '<img srcset="s.jpg 320w, l.jpg 1280w"><img src=x.svg><img src=/logo.png><img src="data:x">'
    "<img src=l.jpg>",
    "seo": '<meta property="og:image" content=1><meta property="og:image" content=2>'
    '<meta name="twitter:a" content=x><meta property="twitter:b" content=y><link rel=icon href=/i.png>',
    "jsonld": '<script type="application/ld+json">{"@type":"A","n":1}</script>'
    '<script type="application/ld+json">{"@type":"A","n":2}</script>'
    '<script type="application/ld+json">{bad</script><script type="application/ld+json">{"n":3}</script>'
    '<script type="application/ld+json">null</script>',
    "empty": "",
    "host_only": "<h1>x</h1>",
}


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        (i, "https://h.example" if k == "host_only" else URL, h) for i, (k, h) in enumerate(PAGES.items())
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in extract(page_nodes(df)).collect()}
    return {k: got[i] for i, k in enumerate(PAGES)}


def test_description(raw):
    assert raw["overview"].description.full == "b" * 31
    assert raw["no_overview"].description.full == "d" * 51
    assert raw["empty"].description.full == ""


def test_lists(raw):
    assert raw["lists"].highlights == ["One item"]
    assert raw["lists"].terms == ["A longer term"]
    assert raw["icons"].inclusions == ["Guide", "Map"] and raw["icons"].exclusions == ["Food"]


def test_package(raw):
    t = raw["package"].ticketPrices
    assert t.prices == ["₹ 1,200", "₹99"] and t.currency == "INR"
    assert t.packageName == "Entry Ticket" and t.packageDetails == ["A detail"]
    assert raw["empty"].ticketPrices is None


def test_location(raw):
    place = raw["location"].location
    assert (place.address, place.latitude, place.longitude) == ("Main Road", 22.5, 88.3)


def test_nearby(raw):
    cards = raw["nearby"].nearbyAttractions
    assert [c.name for c in cards] == ["Zoo", "Fort"]
    assert cards[0].price == "₹ 20" and cards[0].url == "https://x.example/a"
    # A bare rating is its own upper case, so it is taken for the place too.
    assert cards[1].location == "4.5" and cards[1].rating == "4.5"
    assert raw["empty"].nearbyAttractions == []


def test_faq(raw):
    assert [(f.question, f.answer) for f in raw["faq"].faq] == [("Q", "A")]


def test_images(raw):
    urls = [g.url for g in raw["images"].gallery]
    assert urls == ["https://x.example/kolkata/culture-and-heritage/l.jpg"]
    assert raw["images"].metadata.totalImages == 1


def test_seo_first_and_last(raw):
    r = raw["seo"]
    assert r.hero.coverImage == "1" and r.seo.openGraph == {"og:image": "2"}
    assert r.seo.twitterCard == {"twitter:a": "x", "twitter:b": "y"}
    assert r.seo.favicons[0].href == "https://x.example/i.png"


def test_structured_data(raw):
    data = {k: v.toPython() for k, v in raw["jsonld"].structuredData.items()}
    assert data == {"A": {"@type": "A", "n": 2}, "schema_3": {"n": 3}}


def test_address(raw):
    assert raw["empty"].slug == "city-museum" and raw["host_only"].slug == ""
    assert [b.text for b in raw["empty"].breadcrumbs] == ["Kolkata", "Culture And Heritage", "City Museum"]
    assert raw["host_only"].breadcrumbs == [] and raw["host_only"].hero.city == ""


def test_partitions_do_not_matter(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    one = extract(page_nodes(df.repartition(1))).selectExpr("page_id", "to_json(struct(*)) j").collect()
    many = extract(page_nodes(df.repartition(64))).selectExpr("page_id", "to_json(struct(*)) j").collect()
    assert sorted(one) == sorted(many) and len(one) > 0


def test_other_columns_stay_and_large_batches_are_cut(spark, monkeypatch):
    import excursio.sources.pages as pages

    monkeypatch.setattr(pages, "_BATCH_CHARS", 10)
    df = spark.createDataFrame(
        [(i, URL, f"<p>{i}</p>", f"t{i}") for i in range(20)],
        "page_id bigint, url string, html string, tag string",
    )
    rows = page_nodes(df).selectExpr("page_id", "tag", "cast(page_text as string) t").collect()
    assert {(r.page_id, r.tag, r.t) for r in rows} == {(i, f"t{i}", str(i)) for i in range(20)}


def test_rejects(spark):
    df = spark.createDataFrame(
        [(1, None, "x"), (2, URL, None), (3, URL, "")], "page_id bigint, url string, html string"
    )
    assert {(r.page_id, r.reason) for r in page_rejects(df).collect()} == {(1, "no url"), (2, "no html")}
    assert [r.page_id for r in page_nodes(df).collect()] == [3]


def test_rules_are_checked():
    with pytest.raises(ValueError):
        Settings(rules="v9")


def _flat(spark, body):
    df = spark.createDataFrame([(1, "https://h/x", body)], "page_id bigint, url string, html string")
    return extract(page_nodes(df))


@pytest.mark.parametrize("kind", ["icons", "paragraphs"])
def test_flat_pages_take_linear_time(spark, kind):
    import time

    def page(n):
        if kind == "icons":
            return "<div>" + "<img alt='INCLUSIONS'><span>One thing</span>" * n + "</div>"
        return "<h2><i>t</i></h2>" * n + "<p>A paragraph that is long enough to be taken for text of the page</p>" * n

    def seconds(n):
        start = time.time()
        row = _flat(spark, page(n)).select("inclusions", "description.full").first()
        assert row.inclusions == (["One thing"] if kind == "icons" else [])
        return time.time() - start

    seconds(200)
    small = min(seconds(2000) for _ in range(2))
    assert seconds(8000) < 8 * small + 2


def test_case_of_rel_and_type_and_titles_of_drawings(spark):
    r = _flat(spark, "<svg><title>Icon</title></svg><title>Real</title><link rel='ICON' href='/i.ico'><link rel='Canonical' href='/c'>"
              "<script type='Application/LD+JSON'>{\"@type\":\"A\",\"x\":1,\"x\":2}</script>").first()
    assert [f.href for f in r.seo.favicons] == ["https://h/i.ico"] and r.seo.canonical == "https://h/c" and r.seo.title == "Real"
    assert r.structuredData["A"].toPython() == {"@type": "A", "x": 2}


def test_own_address_is_the_printed_one(spark):
    df = spark.createDataFrame([(1, "https://H.example.com", "<p>"), (2, " https://h/a b/../c ", "<p>"), (3, "app:x", "<p>")],
                               "page_id bigint, url string, html string")
    got = {r.page_id: (r.url, r.slug, r.metadata.pageUrl) for r in extract(page_nodes(df)).collect()}
    assert got == {1: ("https://h.example.com/", "", "https://h.example.com/"), 2: ("https://h/c", "c", "https://h/c"), 3: ("app:x", "", "app:x")}


def test_markup_is_made_once(spark):
    """Nothing of the markup is worked out before its rows are dealt; rows without it are left out."""
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(k, "http://a.b/") for k in range(8)], "page_id bigint, url string").repartition(3, "page_id")
    made = rows.select("page_id", F.when(F.col("page_id") != 1, F.col("url")).alias("url"),
                       F.when(F.col("page_id") != 2, F.concat(F.lit("<p>made "), F.col("page_id").cast("string"))).alias("html"))
    found = page_nodes(made)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("<p>made ") == 1
    assert {r.page_id: bytes(r.page_text).decode() for r in found.collect()} == {k: f"made {k}" for k in (0, 3, 4, 5, 6, 7)}
