"""JSON records: raw records, bundles, captured responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from excursio.functions.sql import Sql, all_of, case, coalesce, each, let, quote, some, struct, when
from excursio.functions.text import json_or_null, repeated_keys
from excursio.functions.variants import given, is_list, is_number, is_text, kind, listed, opened, typed, typed_fields
from excursio.schemas import API_RESPONSES, RAW, RAW_JSON, parsed


def read_responses(spark: SparkSession, location: str) -> DataFrame:
    """Captured API responses stored as Parquet."""
    return spark.read.schema(parsed(API_RESPONSES)).parquet(location)


def _number(v: Sql) -> Sql:
    """Only a JSON number counts; a number in quotes does not."""
    kinds = "'^(BIGINT|DECIMAL|DOUBLE|FLOAT)'"
    return when(
        f"schema_of_variant({v}) RLIKE {kinds}", f"try_variant_get({v}, '$', 'double')"
    )


def _image(v: Sql) -> Sql:
    """An image is an object with an address or just the address."""
    kinds = dict.fromkeys(("alt", "title", "caption", "type"), "string") | dict.fromkeys(("width", "height", "sequence"), "int")

    def build(o: Sql) -> Sql:
        given = when(is_text(f"{o}.url"), f"try_variant_get({o}.url, '$', 'string')")
        plain = when(is_text(v), f"try_variant_get({v}, '$', 'string')")
        return struct(url=when(f"{o} IS NOT NULL", given, plain), **{k: f"{o}.{k}" for k in kinds})

    return let(opened(v, ["url", *kinds], kinds), build)


def settle(records: DataFrame) -> DataFrame:
    """Records as they stand in JSON to raw records.

    They come with the ``page_id`` that stands for the record; it must be unique.
    """
    hero = struct(
        **{f: f"hero.{f}" for f in ("name", "city", "category", "coverImage")},
        images=each("hero.images", _image),
        heroImage="hero.heroImage", tags="hero.tags", rating="hero.rating",
    )
    tickets = struct(
        **{f: f"ticketPrices.{f}" for f in ("prices", "currency", "packageName", "packageDetails")},
        minPrice=_number("ticketPrices.minPrice"),
        capacity=_number("ticketPrices.capacity"),
        bookableDates=each(
            "ticketPrices.bookableDates",
            lambda d: struct(
                date=f"{d}.date", minPrice=_number(f"{d}.minPrice"), capacity=_number(f"{d}.capacity")
            ),
        ),
    )
    place = struct(
        address="location.address", googleMapsLink="location.googleMapsLink",
        latitude=_number("location.latitude"), longitude=_number("location.longitude"),
        text="location.text",
    )
    settled = {
        "hero": hero, "gallery": each("gallery", _image), "ticketPrices": tickets, "location": place,
    }
    return records.select(
        *[F.expr(settled.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in parsed(RAW).fields]
    )


def kept_responses(records: DataFrame) -> DataFrame:
    """The captured responses inside JSON records, one row each: page_id, key, url, status, data."""
    rows = records.select("page_id", F.explode("apiResponses").alias("key", "r"))
    return rows.select(
        "page_id", "key", F.expr("try_variant_get(r, '$.url', 'string')").alias("url"),
        F.expr("try_variant_get(r, '$.status', 'int')").alias("status"),
        F.expr("variant_get(r, '$.data')").alias("data"),
    )


#: Lists that must be lists where they are given at all: the transforms go through them.
_LISTS = ("hero.tags", "hero.images", "gallery", "terms", "highlights", "inclusions", "exclusions", "thingsToDo", "nearbyAttractions")
#: Values that must be texts where they are given: the transforms cut them or search in them.
_TEXTS = ("description.full", "timings.closedDays")
#: Lists whose elements are looked into, so that null is no element.
_ELEMENTS = ("hero.images", "gallery", "nearbyAttractions")


#: The object itself, and the names of its fields that are objects, opened.
_OPENED = "_o"


def _field(path: str) -> Sql:
    """A field of a record as VARIANT, in the columns that ``_opened_records`` adds."""
    outer, _, inner = path.rpartition(".")
    return f"{_OPENED}_{outer}.`{inner}`" if outer else f"{_OPENED}.`{inner}`"


def _refusal(v: Sql) -> Sql:
    """Why no record can be made of a JSON value; null if one can."""
    prices = _field("ticketPrices.prices")
    rules = [(f"{v} IS NULL", "not JSON"), (f"{_OPENED} IS NULL", "not an object")]
    rules += [(f"{given(_field(f))} AND NOT {is_list(_field(f))}", f"{f} is not a list") for f in _LISTS]
    rules += [(f"{given(_field(f))} AND NOT {is_text(_field(f))}", f"{f} is not a text") for f in _TEXTS]
    rules += [(some(listed(_field(f)), lambda e: f"({e} IS NULL OR is_variant_null({e}))"), f"{f} holds null") for f in _ELEMENTS]
    details = _field("ticketPrices.packageDetails")
    rules += [
        (some(listed(_field("terms")), lambda e: f"NOT {is_text(e)}"), "terms holds what is no text"),
        (f"{is_text(details)} AND {given(details)}", "ticketPrices.packageDetails is not a list"),
        (f"NOT {is_number(_field('ticketPrices.minPrice'))} AND NOT coalesce({kind(prices, '$[0]')} IN ('STRING', 'VOID'), true)",
         "ticketPrices.prices[0] is not a text"),
    ]
    return case(*[(test, quote(reason)) for test, reason in rules])


def _once(rows: DataFrame, value: Sql, name: str) -> DataFrame:
    """Add a column that is worked out once a row.

    The optimizer puts the expressions of plain columns wherever they are named, also into filters
    that it moves below them; it does not do so with rows that a generator makes.
    """
    return rows.select("*", F.explode_outer(F.array(F.expr(value))).alias(name))


def json_records(texts: DataFrame, need: tuple[str, ...] = ()) -> DataFrame:
    """Rows (value, page_id, ...) as records: the other columns, the fields as they stand in JSON, and ``reason``.

    A text is parsed once, and every field is taken out by its type: a number where a text
    belongs becomes that text, what fits in no way counts as missing and leaves the rest as
    it is. ``reason`` says why no record can be made, and is null for a record; all of ``texts``
    come out. Of the fields in ``need`` one must be there.
    """
    repeated_keys(texts.sparkSession)
    kept = [c for c in texts.columns if c != "value"]
    types = parsed(RAW_JSON)
    inner = [f for f in types.fields if isinstance(f.dataType, T.StructType)]
    whole = _once(texts.select(*kept, F.col("value").alias("_text")), json_or_null("_text"), "_v").drop("_text")
    # an object is opened in one pass, and so is each object in it
    whole = whole.select("*", F.expr(opened("_v", types.fieldNames())).alias(_OPENED))
    whole = whole.select("*", *[F.expr(opened(_field(f.name), f.dataType.fieldNames())).alias(f"{_OPENED}_{f.name}") for f in inner])
    reason = _refusal("_v")
    if need:
        absent = all_of(f"coalesce({kind(_field(f))}, 'VOID') = 'VOID'" for f in need)
        reason = coalesce(reason, when(absent, quote("no " + " and no ".join(need))))
    whole = _once(whole, reason, "reason")
    # of a text in place of the list of prices, the first character counts
    prices = _field("ticketPrices.prices")
    first = when(is_text(prices), f"array(left(try_variant_get({prices}, '$', 'string'), 1))")
    own = {"ticketPrices": {"prices": coalesce(first, typed(prices, T.ArrayType(T.StringType())))}}
    fields = {f.name: typed(_field(f.name), f.dataType) for f in types.fields if f not in inner}
    fields |= {f.name: typed_fields(f"{_OPENED}_{f.name}", f.dataType, own.get(f.name)) for f in inner}
    return whole.select(
        *kept, *[F.expr(f"CAST({fields[f.name]} AS {f.dataType.simpleString()})").alias(f.name) for f in types.fields], "reason")


def json_files(spark: SparkSession, location: str) -> DataFrame:
    """JSON files as rows (file, page_id, value): one per file, or per element where a file holds a list.

    The page_id stands for the file and the place in it. Spark lists no file of zero bytes, so
    those come out nowhere; a file of white space alone is a row like any other.
    """
    repeated_keys(spark)
    files = spark.read.text(location, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    elements = f"CASE WHEN value RLIKE {quote(r'^[ \t\r\n]*\[')} THEN transform({listed(json_or_null('value'))}, e -> to_json(e)) END"
    # a file with an empty list is one row like a damaged file: neither has a record
    whole = let(elements, lambda e: f"CASE WHEN size({e}) > 0 THEN {e} ELSE array(value) END")
    rows = files.select("file", F.posexplode(F.expr(whole)).alias("pos", "one"))
    return rows.select("file", F.xxhash64("file", "pos").alias("page_id"), F.col("one").alias("value"))


def split_json(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw records, their responses, and the rejects (the columns before the fields, url, reason) of ``json_records``."""
    good = records.where("reason IS NULL")
    fields = set(parsed(RAW_JSON).fieldNames()) - {"url"}
    bad = records.where("reason IS NOT NULL").select(*[c for c in records.columns if c not in fields])
    return settle(good), kept_responses(good), bad


def read_raw_json(spark: SparkSession, location: str, kept_at: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw records from JSON files, their responses, and the rejects with file and reason.

    Every file, or element of a file that holds a list, is in one of the first and the last.
    A record with neither ``hero`` nor ``slug`` is something else, for instance a bundle; it would
    silently turn into defaults. With ``kept_at`` the files are read and parsed once and
    written there, and all three read that; without it, write the frames before files change.
    """
    records = json_records(json_files(spark, location), need=("hero", "slug"))
    if kept_at is not None:
        records.write.mode("overwrite").parquet(kept_at)
        records = spark.read.schema(records.schema).parquet(kept_at)
    return split_json(records)


def _text_rows(lines: DataFrame, column: str) -> DataFrame:
    """Without a ``page_id`` column, one stands for the text and the place of its row."""
    page_id = F.col("page_id") if "page_id" in lines.columns else F.xxhash64(column, F.monotonically_increasing_id())
    return lines.select(page_id.alias("page_id"), F.col(column).alias("value"))


def json_text_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """Records as they stand in a column of JSON texts."""
    return json_records(_text_rows(lines, column)).where("reason IS NULL").drop("reason")


def raw_from_json_text(lines: DataFrame, column: str = "value") -> DataFrame:
    """Raw records from a column of JSON texts; ``json_text_rejects`` has the others."""
    return settle(json_text_records(lines, column))


def json_text_rejects(lines: DataFrame, column: str = "value") -> DataFrame:
    """page_id and reason of the texts that are no record."""
    return json_records(_text_rows(lines, column)).where("reason IS NOT NULL").select("page_id", "reason")


def read_bundles(
    spark: SparkSession, location: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Bundles from JSON files, and the rejects that have no activity.

    Missing plans and gallery become empty lists.
    """
    files = spark.read.schema(schema).option("multiLine", True).json(location)
    return check_bundles(files)


def check_bundles(bundles: DataFrame) -> tuple[DataFrame, DataFrame]:
    lists = {
        c: F.coalesce(F.col(c), F.array().cast(bundles.schema[c].dataType))
        for c in ("plans", "gallery")
    }
    good = bundles.filter("activity IS NOT NULL").withColumns(lists)
    bad = bundles.filter("activity IS NULL").withColumn("reason", F.lit("no activity"))
    return good, bad
