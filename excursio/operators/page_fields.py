"""Fields of a page. Every function is an SQL expression over one page row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from excursio.functions.arrays import (
    distinct_longer, first, first_by_key, map_last_wins, or_empty,
)
from excursio.functions.nodes import (
    Test, attr, attr_contains, attr_is, attr_is_ci, attr_starts, both, climb, content, either, has_attr,
    inside, is_inside, meta, nearest, next_of, next_sibling, parent, select, select_first, tag, words,
)
from excursio.functions.sql import (
    Sql, any_of, coalesce, each, keep, let, null, quote, struct, when,
)
from excursio.functions.text import (
    WS, collapse_ascii, contains, contains_any, contains_ci, fallback, filled, json_or_null,
    leading_int, leading_number, repeated_keys, title_case,
)
from excursio.functions.urls import absolute_from, base_parts, path_parts, printed, srcset_pick
from excursio.operators.images import filter_images
from excursio.operators.responses import priced
from excursio.schemas import BOOKABLE_DATES, RAW, parsed, raw_field
from excursio.settings import IMAGE_LIMIT, Settings

# Columns of a staged page row: the element kinds that several fields look at,
# selected once.
NODES, TEXT, URL = "nodes", "page_text", "url"
PARTS, BASE, IMGS, METAS, LINKS = "_parts", "_base", "_imgs", "_metas", "_links"
ANCHORS, PARAGRAPHS, HEADINGS, WITH_ID = "_anchors", "_paragraphs", "_headings", "_with_id"
_STAGED = {
    IMGS: tag("img"),
    METAS: tag("meta"),
    LINKS: tag("link"),
    ANCHORS: both(tag("a"), has_attr("href")),
    PARAGRAPHS: tag("p"),
    HEADINGS: tag("h1", "h2", "h3"),
    WITH_ID: has_attr("id"),
}


def absolute(url: Sql) -> Sql:
    """Absolute address of a link on the page."""
    return absolute_from(url, BASE)


def stage(page_nodes: DataFrame) -> DataFrame:
    repeated_keys(page_nodes.sparkSession)
    page_nodes = page_nodes.withColumn(URL, F.expr(printed(URL)))
    return page_nodes.select(
        "*",
        F.expr(path_parts(URL)).alias(PARTS),
        F.expr(base_parts(URL)).alias(BASE),
        *[F.expr(select(NODES, test)).alias(name) for name, test in _STAGED.items()],
    )


def text_of(n: Sql) -> Sql:
    return words(TEXT, n)


def texts_of(items: Sql) -> Sql:
    return each(items, text_of)


def headings(*names: str) -> Sql:
    return select(HEADINGS, tag(*names))


def titled(level: tuple[str, ...], test: Callable[[Sql], Sql]) -> Sql:
    """First heading whose text passes."""
    return first(keep(headings(*level), lambda h: let(text_of(h), test)))


def under(box: Sql, *names: str) -> Sql:
    return select(inside(NODES, box), tag(*names))


# ---- address and hero --------------------------------------------------------

def slug() -> Sql:
    return coalesce(f"try_element_at({PARTS}, -1)", "''")


def breadcrumbs() -> Sql:
    def crumb(part: Sql, i: Sql) -> Sql:
        to = f"concat('/', array_join(slice({PARTS}, 1, {i} + 1), '/'))"
        return struct(text=title_case(part), url=absolute(to))

    return each(PARTS, crumb)


def path_title(i: int) -> Sql:
    return coalesce(title_case(f"get({PARTS}, {i})"), "''")


def hero_name() -> Sql:
    return text_of(first(headings("h1")))


def cover_image() -> Sql:
    return meta(METAS, "og:image")


def source_of(img: Sql) -> Sql:
    return absolute(fallback(attr(img, "src"), attr(img, "data-src")))


def _image(url: Sql, img: Sql, caption: Sql, sequence: Sql) -> Sql:
    def pixels(side: str) -> Sql:
        return f"coalesce(try_cast({leading_int(attr(img, side))} AS INT), 0)"

    return struct(
        url=url, alt=attr(img, "alt"), title=null("STRING"), caption=caption,
        type=null("STRING"), width=pixels("width"), height=pixels("height"), sequence=sequence,
    )


def hero_images(hosts: tuple[str, ...]) -> Sql:
    """First images of the content hosts; numbered before empty ones are dropped."""
    chosen = f"slice({select(IMGS, attr_contains('src', *hosts))}, 1, {IMAGE_LIMIT})"
    numbered = each(chosen, lambda n, i: _image(source_of(n), n, null("STRING"), f"{i} + 1"))
    return keep(numbered, lambda i: f"{i}.url <> ''")


def hero(settings: Settings) -> Sql:
    def build(images: Sql, cover: Sql) -> Sql:
        return struct(
            name=hero_name(), city=path_title(0), category=path_title(1), coverImage=cover,
            images=images, heroImage=fallback(f"{first(images)}.url", cover),
            tags=null("ARRAY<STRING>"), rating=null("STRING"),
        )

    return let(
        hero_images(settings.image_hosts),
        lambda images: let(cover_image(), lambda cover: build(images, cover)),
    )


# ---- text sections -----------------------------------------------------------

def by_id(name: str) -> Sql:
    return select_first(WITH_ID, attr_is("id", name))


def _long_paragraphs(items: Sql, longer: int, without: tuple[str, ...] = ()) -> Sql:
    def wanted(t: Sql) -> Sql:
        refused = f" AND NOT {contains_any(t, without)}" if without else ""
        return f"length({t}) > {longer}{refused}"

    return f"array_join({keep(texts_of(items), wanted)}, '\\n\\n')"


def leading_paragraphs(longer: int) -> Sql:
    """Paragraphs up to the first one that follows an ``h2`` or lies in one."""
    def first_in(h: Sql, upcoming: Sql) -> Sql:
        return let(
            f"get({upcoming}, {h}.pre + 1)",
            lambda k: when(f"{PARAGRAPHS}[{k}].pre <= {h}.pre + {h}.size", k),
        )

    def cut(upcoming: Sql) -> Sql:
        after = f"CAST(array_position({each(PARAGRAPHS, lambda n: f"{n}.prev_tag <=> 'h2'")}, true) AS INT)"
        within = f"array_min({each(keep(headings('h2'), lambda h: f'{h}.size > 0'), lambda h: first_in(h, upcoming))})"
        return let(
            f"least(nullif({after}, 0) - 1, {within})",
            lambda stop: when(f"{stop} IS NULL", PARAGRAPHS, f"slice({PARAGRAPHS}, 1, {stop})"),
        )

    return _long_paragraphs(let(next_of(PARAGRAPHS), cut), longer)


def description(rules: str = "v4") -> Sql:
    if rules == "v4":
        block, longer, spare = by_id("overview"), 30, 50
        without = ("Select a date", "Final price")
    else:
        box = let(first(headings("h1")), lambda h: nearest(NODES, h, tag("div")))
        block, longer, spare = let(box, lambda b: parent(NODES, b)), 50, 80
        without = ("Select a date", "Final price", "Please select", "Your cart")
    scoped = let(block, lambda b: _long_paragraphs(under(b, "p"), longer, without))
    return struct(full=coalesce(let(scoped, filled), leading_paragraphs(spare)))


def tabs(rules: str = "v4") -> Sql:
    marked = select(
        NODES,
        both(tag("button"), attr_contains("class", "rounded"), attr_contains("class", "border"),
             attr_contains("class", "min-w-fit")),
    )
    found = keep(texts_of(marked), lambda t: f"length({t}) < 30")
    if rules == "v4":
        return found

    def in_row(n: Sql) -> Sql:
        names = f"split({attr(n, 'class')}, {quote(WS + '+')})"
        return (
            f"{n}.tag = 'div' AND array_contains({names}, 'flex') "
            f"AND arrays_overlap({names}, array('gap-2', 'gap-3', 'gap-4'))"
        )

    row = let(select_first(NODES, in_row), lambda r: under(r, "button"))
    spare = keep(texts_of(row), lambda t: f"length({t}) > 2 AND length({t}) < 30")
    return let(found, lambda f: when(f"size({f}) > 0", f, spare))


def _items_or_texts(block: Sql, longer: int, refuse: Callable[[Sql], Sql] | None = None) -> Sql:
    """List items of a block; if there are none, its longer paragraphs and spans."""
    def texts(within: Sql) -> Sql:
        items = distinct_longer(texts_of(select(within, tag("li"))), longer)
        spare = distinct_longer(texts_of(select(within, tag("p", "span"))), 10)
        if refuse is not None:
            spare = keep(spare, lambda t: f"NOT {refuse(t)}")
        return let(items, lambda i: when(f"size({i}) > 0", i, spare))

    return let(block, lambda b: let(inside(NODES, b), texts))


def highlights(rules: str = "v4") -> Sql:
    if rules == "v4":
        return _items_or_texts(by_id("highlights"), 3, lambda t: f"({t} = 'Highlights')")
    title = titled(("h2",), lambda t: f"{t} = 'Highlights'")
    row = let(title, lambda h: parent(NODES, h))
    return _items_or_texts(let(row, lambda r: next_sibling(NODES, r)), 5)


def marked_items(longer: int, *alts: str) -> Sql:
    """First span beside each image with one of the alternative texts."""
    def found(spans: Sql, upcoming: Sql) -> Sql:
        def beside(img: Sql) -> Sql:
            def first_in(box: Sql) -> Sql:
                span = f"get({spans}, get({upcoming}, {box}.pre + 1))"
                return let(span, lambda s: when(f"{s}.pre <= {box}.pre + {box}.size", s))

            return let(parent(NODES, img), first_in)

        return keep(each(select(IMGS, attr_is("alt", *alts)), beside), lambda s: f"{s} IS NOT NULL")

    spans = let(select(NODES, tag("span")), lambda s: let(next_of(s), lambda n: found(s, n)))
    return distinct_longer(texts_of(spans), longer)


def inclusions(rules: str = "v4") -> Sql:
    if rules == "v4":
        return marked_items(2, "INCLUSIONS", "Inclusions")
    return marked_items(3, "INCLUSIONS")


def exclusions(rules: str = "v4") -> Sql:
    return marked_items(2 if rules == "v4" else 3, "Exclusions", "EXCLUSIONS")


def terms(rules: str = "v4") -> Sql:
    if rules == "v4":
        block = select_first(
            WITH_ID,
            either(attr_is("id", "terms_and_condtions"),
                   both(tag("section"), attr_contains("id", "terms"))),
        )
        return _items_or_texts(block, 3, lambda t: contains(t, "Terms & Conditions"))

    def few(n: Sql) -> Sql:
        return f"size({under(n, 'li')}) BETWEEN 1 AND 19"

    title = titled(("h2",), lambda t: contains(t, "Terms"))
    reached = let(title, lambda h: climb(NODES, parent(NODES, h), 2, few))
    return or_empty(
        let(reached, lambda n: when(few(n), distinct_longer(texts_of(under(n, "li")), 5)))
    )


# ---- tickets, place, neighbours, questions -------------------------------------

def _children_over(n: int) -> Test:
    return lambda at: f"{at}.n_children > {n}"


def ticket_prices(settings: Settings) -> Sql:
    title = titled(("h3",), lambda t: contains_any(t, ("Entry Ticket", "Package")))

    def some_or_null(items: Sql) -> Sql:
        return let(items, lambda a: when(f"size({a}) > 0", a))

    def build(h: Sql, box: Sql) -> Sql:
        prices = f"regexp_extract_all({text_of(box)}, {quote(r'₹\s*[0-9,]+')}, 0)"
        return when(
            f"{box} IS NOT NULL",
            struct(
                prices=some_or_null(f"array_distinct({prices})"),
                currency=quote(settings.currency),
                packageName=text_of(h),
                packageDetails=some_or_null(distinct_longer(texts_of(under(box, "li")), 5)),
                minPrice=null("DOUBLE"),
                capacity=null("DOUBLE"),
                bookableDates=null(BOOKABLE_DATES),
            ),
        )

    def around(h: Sql) -> Sql:
        box = climb(NODES, parent(NODES, h), 3, _children_over(2))
        return let(box, lambda b: build(h, b))

    return let(title, around)


def location(rules: str = "v4") -> Sql:
    if rules == "v4":
        block = by_id("location")
    else:
        title = titled(("h2",), lambda t: contains(t, "Location"))
        block = let(title, lambda h: climb(NODES, parent(NODES, h), 3, _children_over(2)))

    on_map = attr_contains("href", "google.com/maps")

    def coordinate(href: Sql, group: int) -> Sql:
        pair = quote(r"query=([-0-9.]+)%2C([-0-9.]+)")
        return leading_number(f"regexp_extract({href}, {pair}, {group})")

    def build(box: Sql, to: Sql) -> Sql:
        lines = keep(
            distinct_longer(texts_of(under(box, "span", "p")), 2),
            lambda t: f"{t} <> 'Location Details' AND NOT {contains(t, 'Get Directions')}",
        )
        href = when(f"{to} IS NOT NULL", absolute(attr(to, "href")))
        return let(
            href,
            lambda u: struct(
                address=when(f"{box} IS NOT NULL", f"array_join({lines}, ', ')"),
                googleMapsLink=u,
                latitude=coordinate(u, 1),
                longitude=coordinate(u, 2),
                text=null("STRING"),
            ),
        )

    def with_link(box: Sql) -> Sql:
        scoped = first(keep(ANCHORS, lambda a: f"{on_map(a)} AND {is_inside(a, box)}"))
        return let(
            coalesce(scoped, select_first(ANCHORS, on_map)), lambda to: build(box, to)
        )

    return let(block, with_link)


def nearby() -> Sql:
    title = titled(
        ("h2",), lambda t: any_of(contains_ci(t, w) for w in ("might also like", "nearby", "similar"))
    )

    def many_links(at: Sql) -> Sql:
        return f"size({keep(ANCHORS, lambda a: is_inside(a, at))}) > 2"

    def fields(a: Sql, img: Sql, parts: Sql) -> Sql:
        def having(test: Callable[[Sql], Sql]) -> Sql:
            return coalesce(first(keep(parts, test)), "''")

        return struct(
            name=fallback(attr(img, "alt"), first(parts)),
            url=absolute(attr(a, "href")),
            image=when(f"{img} IS NULL", "''", source_of(img)),
            price=having(lambda t: contains(t, "₹")),
            location=having(
                lambda t: f"{t} = upper({t}) AND length({t}) > 2 AND NOT {contains(t, '₹')}"
            ),
            rating=having(lambda t: f"{t} RLIKE {quote(r'^[0-9]\.[0-9]')}"),
            distance=null("STRING"),
            category=null("STRING"),
        )

    def card(a: Sql) -> Sql:
        def read(within: Sql) -> Sql:
            parts = keep(
                distinct_longer(texts_of(select(within, tag("span", "p", "div"))), 1),
                lambda t: f"length({t}) < 200",
            )
            return let(
                select_first(within, tag("img")),
                lambda img: let(parts, lambda ts: fields(a, img, ts)),
            )

        return let(inside(NODES, a), read)

    def cards(box: Sql) -> Sql:
        return keep(ANCHORS, lambda a: f"{is_inside(a, box)} AND {contains(attr(a, 'href'), '/')}")

    box = let(title, lambda h: climb(NODES, parent(NODES, h), 4, many_links))
    named = keep(each(let(box, cards), card), lambda c: f"{c}.name <> ''")
    return first_by_key(named, lambda c: f"{c}.name")


def faq(rules: str = "v4") -> Sql:
    def pair(q: Sql, answer: Sql) -> Sql:
        return struct(question=text_of(q), answer=answer)

    def entries(items: Sql, question: Test, answer: Callable[[Sql, Sql, Sql], Sql]) -> Sql:
        def entry(item: Sql) -> Sql:
            return let(
                inside(NODES, item),
                lambda within: let(
                    select_first(within, question),
                    lambda q: when(f"{q} IS NOT NULL", answer(item, within, q)),
                ),
            )

        return keep(each(items, entry), lambda e: f"{e} IS NOT NULL")

    def replied(item: Sql, within: Sql, q: Sql) -> Sql:
        reply = either(attr_contains("class", "content"), attr_is("role", "region"), tag("p"))
        return let(
            select_first(within, reply), lambda a: when(f"{a} IS NOT NULL", pair(q, text_of(a)))
        )

    def box_items(h: Sql) -> Sql:
        return let(
            climb(NODES, parent(NODES, h), 4, _children_over(3)),
            lambda box: select(inside(NODES, box), either(tag("details"), has_attr("data-state"))),
        )

    title = titled(("h2", "h3"), lambda t: contains_ci(t, "faq"))
    asked = either(tag("summary", "button"), attr_contains("class", "trigger"))
    found = entries(let(title, box_items), asked, replied)
    if rules == "v4":
        return found

    def rest(item: Sql, within: Sql, q: Sql) -> Sql:
        others = keep(within, lambda n: f"{n}.parent = {item}.pre AND {n}.tag <> 'summary'")
        joined = f"array_join({texts_of(others)}, ' ')"
        return let(joined, lambda t: when(f"{t} <> ''", pair(q, t)))

    spare = entries(select(NODES, tag("details")), tag("summary"), rest)
    return let(found, lambda f: when(f"size({f}) > 0", f, spare))


# ---- images, metadata ----------------------------------------------------------

def gallery() -> Sql:
    def image(img: Sql) -> Sql:
        srcset = fallback(attr(img, "srcset"), attr(img, "data-srcset"))
        picked = let(srcset, lambda s: when(f"{s} <> ''", absolute(srcset_pick(s)), "''"))
        url = let(picked, lambda p: when(f"{p} <> ''", p, source_of(img)))
        return _image(url, img, attr(img, "title"), "0")

    def numbered(g: Sql, i: Sql) -> Sql:
        same = {f: f"{g}.{f}" for f in ("url", "alt", "title", "caption", "type", "width", "height")}
        return struct(**same, sequence=f"{i} + 1")

    return each(filter_images(each(IMGS, image)), numbered)


def open_graph() -> Sql:
    tags = select(METAS, attr_starts("property", "og:"))
    return map_last_wins(
        each(tags, lambda m: struct(key=attr(m, "property"), value=attr(m, "content")))
    )


def twitter_card() -> Sql:
    tags = select(METAS, either(attr_starts("name", "twitter:"), attr_starts("property", "twitter:")))
    return map_last_wins(
        each(
            tags,
            lambda m: struct(
                key=fallback(attr(m, "name"), attr(m, "property")), value=attr(m, "content")
            ),
        )
    )


def favicons() -> Sql:
    icons = select(LINKS, attr_is_ci("rel", "icon", "shortcut icon", "apple-touch-icon"))
    return each(
        icons,
        lambda n: struct(
            rel=attr(n, "rel"), href=absolute(attr(n, "href")), sizes=attr(n, "sizes")
        ),
    )


def seo() -> Sql:
    canonical = select_first(LINKS, attr_is_ci("rel", "canonical"))
    # a drawing can have a title of its own
    title = first(keep(select(NODES, tag("title")), lambda n: f"{nearest(NODES, n, tag('svg'))} IS NULL"))
    return struct(
        title=let(title, lambda n: collapse_ascii(content(TEXT, n))),
        metaDescription=meta(METAS, "description"),
        canonical=let(canonical, lambda n: absolute(attr(n, "href"))),
        robots=meta(METAS, "robots"),
        language=attr(first(NODES), "lang"),
        themeColor=meta(METAS, "theme-color"),
        openGraph=open_graph(),
        twitterCard=twitter_card(),
        favicons=favicons(),
    )


def structured_data() -> Sql:
    def key(v: Sql, i: Sql) -> Sql:
        several = f"array_join(try_variant_get({v}, '$[\"@type\"]', 'array<string>'), ',')"
        named = f"try_variant_get({v}, '$[\"@type\"]', 'string')"
        return fallback(coalesce(several, named), f"concat('schema_', {i})")

    def entry(n: Sql, i: Sql) -> Sql:
        return let(json_or_null(content(TEXT, n)), lambda v: struct(key=key(v, i), value=v))

    scripts = select(NODES, both(tag("script"), attr_is_ci("type", "application/ld+json")))
    # JSON null has no properties to read, so it counts as unreadable.
    read = keep(
        each(scripts, entry), lambda e: f"{e}.value IS NOT NULL AND NOT is_variant_null({e}.value)"
    )
    return map_last_wins(read)


def sections() -> Sql:
    shown = keep(texts_of(headings("h2")), lambda t: f"length({t}) BETWEEN 1 AND 79")
    return f"array_distinct({shown})"


def page_metadata(images: Sql, settings: Settings) -> Sql:
    return struct(scrapedAt=quote(settings.run_iso), pageUrl=URL, totalImages=f"size({images})")


# ---- raw record ------------------------------------------------------------------

def field_rules(settings: Settings = Settings()) -> dict[str, Sql]:
    """Expression of every raw field over a staged page row."""
    rules = settings.rules
    return {
        "slug": slug(),
        "breadcrumbs": breadcrumbs(),
        "hero": hero(settings),
        "gallery": gallery(),
        "description": description(rules),
        "highlights": highlights(rules),
        "inclusions": inclusions(rules),
        "exclusions": exclusions(rules),
        "terms": terms(rules),
        "ticketPrices": ticket_prices(settings),
        "location": location(rules),
        "nearbyAttractions": or_empty(nearby(), raw_field("nearbyAttractions").elementType.simpleString()),
        "faq": or_empty(faq(rules), raw_field("faq").elementType.simpleString()),
        "tabs": tabs(rules),
        "seo": seo(),
        "structuredData": structured_data(),
        "sections": sections(),
    }


def extract(page_nodes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Raw record of every page: one projection, no shuffle. A column ``_pricing`` goes into the ticket prices."""
    rules = field_rules(settings) | {
        "page_id": "page_id",
        "url": URL,
        "metadata": page_metadata("gallery", settings),
    }
    unset = {n: null(raw_field(n).simpleString()) for n in ("timings", "rules", "thingsToDo")}
    fields = rules | unset
    if "_pricing" in page_nodes.columns:
        fields["ticketPrices"] = let(fields["ticketPrices"], lambda t: priced(t, "_pricing", settings))
    return stage(page_nodes).select(
        *[F.expr(fields[n]).alias(n) for n in parsed(RAW).fieldNames()]
    )
