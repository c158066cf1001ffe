"""Rules that turn a raw record into its linked records.

Every rule is an expression over one raw row, so activity, plan, gallery and the
whole bundle are narrow projections and work on streams as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from excursio.functions import ids
from excursio.functions.arrays import clean_list, first_by_key, or_empty
from excursio.functions.sql import (
    Sql, all_of, any_of, case, coalesce, each, keep, let, null, quote, some, struct, when,
)
from excursio.functions.text import (
    clean, contains, contains_ci, fallback, leading_number, prefix, price_number, text,
)
from excursio.operators.images import usable
from excursio.settings import (
    CATEGORY_FALLBACK, CLOSES, GALLERY_JUNK, OPENS, TICKET_DELIVERY, WEEK, Settings,
)

FULL = "description.full"
TRUE, FALSE, ZERO, NO_TEXT = "true", "false", "0", "''"
NO_MAP = "CAST(map() AS MAP<STRING, STRING>)"


def category_text(category: Sql, name: Sql, slug: Sql) -> Sql:
    """What the category rules look at."""
    return f"lower(concat({text(category)}, ' ', {text(name)}, ' ', {text(slug)}))"


def map_category(sought: Sql, rules) -> Sql:
    """First rule one of whose words occurs in the text; of a tuple, all words must."""
    def hit(word: str | tuple[str, ...]) -> Sql:
        return all_of(contains(sought, w) for w in ((word,) if isinstance(word, str) else word))

    return case(
        *[(any_of(hit(w) for w in words), quote(to)) for to, words in rules],
        other=quote(CATEGORY_FALLBACK),
    )


def prepare(raw: DataFrame, settings: Settings = Settings(), custom_id: Sql | None = None) -> DataFrame:
    """Add the values that several of the linked records use (``_`` columns).

    ``custom_id`` is an expression for a caller's activity id; null or 0 means
    that one is derived from the page address.
    """
    key = fallback("url", "slug", "CAST(page_id AS STRING)")
    raw = raw.select("*", F.expr(key).alias("_key"), F.expr(clean("hero.name")).alias("_name"))
    raw = raw.select("*", F.expr(category_text("hero.category", "_name", "slug")).alias("_sought"))
    steps: dict[str, Sql] = {
        "_id": ids.caller_or(custom_id, ids.activity_id("_key")),
        "_category": map_category("_sought", settings.category_rules),
        "_tags": clean_list("hero.tags"),
        "_listed": price_number("get(ticketPrices.prices, 0)"),
        "_currency": fallback("ticketPrices.currency", quote(settings.currency)),
        "_picture": fallback("hero.heroImage", "hero.coverImage", "get(gallery, 0).url"),
        "_shared": text("try_element_at(seo.openGraph, 'og:image')"),
        "_city": clean(fallback("hero.city", quote(settings.default_city))),
        "_visitors": clean(fallback("hero.name", "'Experience'")),
        "_shown": clean(fallback("hero.name", "slug", "'Experience'")),
        "_now": f"TIMESTAMP {quote(settings.run_iso)}",
    }
    return raw.select("*", *[F.expr(e).alias(n) for n, e in steps.items()])


# ---- pieces ----------------------------------------------------------------------

def shortened(n: int, spare: Sql) -> Sql:
    """First n characters of the description with dots, then cleaned."""
    return clean(when(f"{FULL} <> ''", f"concat({prefix(FULL, n)}, '...')", spare))


def activity_price() -> Sql:
    return coalesce("ticketPrices.minPrice", "_listed", "0D")


def plan_price(settings: Settings) -> Sql:
    """A parsed price of 0 falls back too; a numeric 0 does not."""
    return coalesce("ticketPrices.minPrice", "nullif(_listed, 0D)", f"{settings.fallback_price}D")


def listing_price(price: Sql) -> Sql:
    return struct(
        type="'fixed'", final_price=price, currency_code="_currency", original_price=price,
        other_prices_exist=ZERO, minimum_payable_price=price,
    )


def refundable(terms: Sql) -> Sql:
    return f"NOT {some(or_empty(terms), lambda t: contains_ci(t, 'non-refundable'))}"


def association(kind: str, settings: Settings) -> Sql:
    return struct(source=quote(settings.source), productId=ids.product_id(kind, "_key"))


def is_closed(closed_days: Sql, key: str, full: str) -> Sql:
    """The day's full name or its lower-cased key occurs in the text."""
    return any_of(contains_ci(text(closed_days), w) for w in (full, key.lower()))


def per_person(price: Sql) -> Sql:
    nobody, same = struct(Male="0D", Female="0D"), struct(Male=price, Female=price)
    return struct(Infant=nobody, Child=same, Adult=same, Senior=same)


def week_opening(price: Sql) -> Sql:
    opens = fallback("timings.openingTime", quote(OPENS))
    closes = fallback("timings.closingTime", quote(CLOSES))

    def day(key: str, full: str) -> Sql:
        closed = is_closed("timings.closedDays", key, full)
        slots = f"array({struct(start=opens, end=closes, is_Available=TRUE)})"
        return struct(
            is_Open=f"NOT {closed}",
            info=when(closed, "'Closed'", "'Open'"),
            opening_Time=when(closed, NO_TEXT, opens),
            closing_Time=when(closed, NO_TEXT, closes),
            timing_Slot_List=when(closed, f"slice({slots}, 1, 0)", slots),
            price_PerPerson=per_person(price),
        )

    return struct(**{key: day(key, full) for key, full in WEEK})


def plan_pois() -> Sql:
    def poi(a: Sql) -> Sql:
        return let(
            clean(f"{a}.name"),
            lambda name: struct(
                poi_id=ids.poi_id("_key", name), name=name, url=text(f"{a}.url"),
                image=text(f"{a}.image"), distance=text(f"{a}.distance"),
                category=text(f"{a}.category"), admission=TRUE,
            ),
        )

    cards = "coalesce(nearbyAttractions, array())"
    return keep(each(cards, poi), lambda p: f"{p}.name <> ''")


# ---- records ---------------------------------------------------------------------

def activity_rules(settings: Settings) -> dict[str, Sql]:
    """Fields of the activity record, in order, over a prepared raw row."""
    price, terms = activity_price(), or_empty("terms")
    picture = fallback("_picture", "_shared")
    return {
        "id": "_id",
        "unique_id": ids.unique_id("activity", "_key"),
        "slug": text("slug"),
        "name": "_name",
        "info": shortened(300, "_name"),
        "description": clean(FULL),
        "additional_info": clean("array_join(terms, '\\n')"),
        "descriptors": "_tags",
        "schedule": struct(
            opening_time=text("timings.openingTime"),
            closing_time=text("timings.closingTime"),
            closed_days=text("timings.closedDays"),
            last_entry=text("timings.lastEntry"),
            best_visiting_time=text("timings.bestVisitingTime"),
        ),
        "association": association("activity", settings),
        "image_url": picture,
        "tags": "_tags",
        "category": "array(_category)",
        "availability": TRUE,
        "authorization": TRUE,
        "sold_out": FALSE,
        "website_available": TRUE,
        "ttd_available": TRUE,
        "is_featured": FALSE,
        "show_on_homepage": FALSE,
        "show_on_landingpage": FALSE,
        "partial_payment": TRUE,
        "prepaid_payment": TRUE,
        "postpaid_payment": TRUE,
        "cancellation_policy": struct(refundable=refundable("terms"), terms=terms),
        # An empty list of rules counts as given.
        "general_policy": struct(rules=or_empty(coalesce("rules", "terms"))),
        "refund_policy": NO_MAP,
        "longitude": "coalesce(location.longitude, 0D)",
        "latitude": "coalesce(location.latitude, 0D)",
        "must_know": clean_list("terms"),
        "min_duration": ZERO,
        "max_duration": ZERO,
        "highlights": clean_list("highlights"),
        "inclusions": clean_list("inclusions"),
        "exclusions": clean_list("exclusions"),
        "itinerary": clean_list("thingsToDo"),
        "operating_hours": each(
            keep("array(timings.openingTime, timings.closingTime)", lambda t: f"{t} <> ''"), clean
        ),
        "ticket_delivery_info": quote(TICKET_DELIVERY),
        "pois": clean_list("nearbyAttractions.name"),
        "meta_data": struct(
            title=clean(fallback("seo.title", "_name")),
            description=clean(fallback("seo.metaDescription", prefix(FULL, 160))),
            keywords="array_join(coalesce(hero.tags, array()), ', ', '')",
            canonical_url=fallback("seo.canonical", "url"),
            image_url=fallback("_shared", picture),
        ),
        "rating": coalesce(leading_number("hero.rating"), "0D"),
        "map_url": text("location.googleMapsLink"),
        "place_id": NO_TEXT,
        "geo_accuracy": "'APPROXIMATE'",
        "rating_distribution": NO_MAP,
        "reviews_count": ZERO,
        "duration": ZERO,
        "listing_price": listing_price(price),
        "landmark": NO_TEXT,
        "address": clean(fallback("location.address", "location.text", "_city")),
        "pincode": NO_TEXT,
        "city": "_city",
        "city_code": f"upper({prefix('_city', 3)})",
        "state": NO_TEXT,
        "state_code": NO_TEXT,
        "country": quote(settings.country),
        "country_code": quote(settings.country_code),
        "created_at": "_now",
        "updated_at": "_now",
    }


def plan_rules(settings: Settings) -> dict[str, Sql]:
    """Fields of the plan record, in order, over a prepared raw row."""
    price = plan_price(settings)
    act_slug = fallback("slug", "'experience'")
    name = clean(fallback("ticketPrices.packageName", "concat('Entry Ticket - ', _visitors)"))
    return {
        "id": "_id + 100",
        "unique_id": ids.unique_id("plan", "_key"),
        "slug": f"concat({act_slug}, '-entry-ticket')",
        "activity_id": "_id",
        "activity_slug": act_slug,
        "name": name,
        "info": shortened(150, name),
        "description": when(
            "size(ticketPrices.packageDetails) > 0",
            "array_join(ticketPrices.packageDetails, '\\n')",
            clean(fallback(prefix(FULL, 300), "_visitors")),
        ),
        "type": "'general'",
        "image_url": "_picture",
        "tags": "_tags",
        "categories": "array(_category)",
        "properties": struct(
            inclusions=or_empty("inclusions"), exclusions=or_empty("exclusions"),
            highlights=or_empty("highlights"), terms=or_empty("terms"),
        ),
        "availability": TRUE,
        "duration": ZERO,
        "min_purchase_count": "1",
        "max_purchase_count": "10",
        "week_opening_info": week_opening(price),
        "listing_price": listing_price(price),
        "association": association("plan", settings),
        "pois": plan_pois(),
        "margin": ZERO,
        "net_price_percentage": ZERO,
    }


def gallery_shots() -> Sql:
    """Pictures of one page that stay, in order, as they were captured.

    Cover, hero, hero images, page gallery; first of each address wins.
    """
    def lead(url: Sql, suffix: str, kind: str) -> Sql:
        none = null("STRING")
        alt = f"concat(_shown, {quote(' - ' + suffix)})"
        return f"array({struct(url=url, alt=alt, title=none, caption=none, kind=quote(kind))})"

    def listed(images: Sql, kind: str) -> Sql:
        return each(
            usable_of(f"coalesce({images}, array())"),
            lambda i: struct(url=f"{i}.url", alt=f"{i}.alt", title=f"{i}.title", caption=f"{i}.caption",
                             kind=fallback(f"{i}.type", quote(kind))),
        )

    def usable_of(images: Sql) -> Sql:
        return keep(images, lambda i: usable(f"{i}.url", GALLERY_JUNK))

    chain = "concat(" + ", ".join((
        usable_of(lead("hero.coverImage", "Cover", "cover")),
        usable_of(lead("hero.heroImage", "Hero", "hero")),
        listed("hero.images", "hero_gallery"),
        listed("gallery", "gallery"),
    )) + ")"
    return first_by_key(chain, lambda i: f"{i}.url")


def gallery_items(linked: bool = True, shots: Sql = "_shots") -> Sql:
    """Gallery records of one page out of its pictures, in order, as an array.

    Not ``linked`` takes the gallery's own base number as activity id.
    """
    tags = keep(
        f"array({clean('hero.category')}, {clean('hero.city')})", lambda t: f"{t} <> ''"
    )

    # What all images of a page share is worked out once per page, not per image.
    base = ids.gallery_base("_key")
    page = struct(
        base=base,
        activity="_id" if linked else base,
        shown="_shown",
        tags=tags,
        title=clean(fallback("seo.title", "_shown")),
        about=clean(fallback("seo.metaDescription", prefix(FULL, 160))),
        now="_now",
    )

    def cleaned(p: Sql, i: Sql) -> Sql:
        return struct(
            url=f"{i}.url", alt=clean(fallback(f"{i}.alt", f"{i}.title", f"{i}.caption", f"{p}.shown")),
            caption=clean(fallback(f"{i}.caption", f"{i}.alt")), kind=f"{i}.kind",
        )

    def record(p: Sql, i: Sql, pos: Sql) -> Sql:
        return struct(
            id=f"{p}.base + {pos} + 1",
            activity_id=f"{p}.activity",
            url=f"{i}.url",
            title=fallback(f"{i}.alt", f"{p}.shown"),
            description=fallback(f"{i}.caption", f"{i}.alt", f"{p}.shown"),
            tags=f"{p}.tags",
            meta_title=f"{p}.title",
            meta_description=f"{p}.about",
            type=f"{i}.kind",
            order=f"{pos} + 1",
            created_at=f"{p}.now",
            updated_at=f"{p}.now",
        )

    return let(page, lambda p: each(each(shots, lambda i: cleaned(p, i)), lambda i, pos: record(p, i, pos)))


def _flat(rules: dict[str, Sql]) -> list:
    return [F.expr(e).alias(n) for n, e in rules.items()]


def activity(raw: DataFrame, settings: Settings = Settings(), custom_id: Sql | None = None) -> DataFrame:
    """One activity per raw record."""
    return prepare(raw, settings, custom_id).select("page_id", *_flat(activity_rules(settings)))


def plan(raw: DataFrame, settings: Settings = Settings(), custom_id: Sql | None = None) -> DataFrame:
    """One plan per raw record."""
    return prepare(raw, settings, custom_id).select("page_id", *_flat(plan_rules(settings)))


def gallery(
    raw: DataFrame, settings: Settings = Settings(), custom_id: Sql | None = None,
    linked: bool = True,
) -> DataFrame:
    """Gallery images, one row each."""
    items = prepare(raw, settings, custom_id).select("*", F.expr(gallery_shots()).alias("_shots")).select(
        "page_id", F.expr(gallery_items(linked)).alias("g")
    )
    # The plain generator would make the optimizer filter on size(g) first and
    # so work out every gallery twice.
    return items.select("page_id", F.inline_outer("g")).filter("id IS NOT NULL")


def bundle(raw: DataFrame, settings: Settings = Settings(), custom_id: Sql | None = None) -> DataFrame:
    """Activity, plans, gallery and metadata of each page, without a shuffle."""
    prepared = prepare(raw, settings, custom_id).select("*", F.expr(gallery_shots()).alias("_shots"))
    meta = struct(
        provider=quote(settings.provider),
        source_url=text("url"),
        slug=text("slug"),
        scraped_at=fallback("metadata.scrapedAt", quote(settings.run_iso)),
        generated_at=quote(settings.run_iso),
        # One plan to a page; counted before records are made, so that a count alone makes none.
        total_plans="1",
        total_gallery_images="size(_shots)",
    )
    return prepared.select(
        "page_id",
        F.expr(struct(**activity_rules(settings))).alias("activity"),
        F.expr(f"array({struct(**plan_rules(settings))})").alias("plans"),
        F.expr(gallery_items()).alias("gallery"),
        F.expr(meta).alias("metadata"),
    )


def split_bundles(bundle: DataFrame) -> dict[str, DataFrame]:
    """Activity, plan and gallery tables out of written bundles.

    Reads back what was worked out once; only the columns of the one table are
    touched.
    """
    return {
        "activity": bundle.select("page_id", "activity.*"),
        "plan": bundle.select("page_id", F.inline("plans")),
        "gallery": bundle.select("page_id", F.inline("gallery")),
    }
