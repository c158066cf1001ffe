"""Publish requests of a catalogue and the roll-up of their outcomes."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from excursio.functions.sql import Sql, null, quote, struct, when
from excursio.functions.text import fallback, json_or_null, repeated_keys

# The three stages of the publishing service.
ACTIVITY, PLAN, IMAGE = 1, 2, 3
ACTIVITY_PATH = "/api/v1/activity/activityInfo"
PLAN_QUERY = "/planInfo?link_pois=true&group_plan=true"
IMAGE_PATH = "/api/v1/activity/activitySubInfo/"

JSON_OPTIONS = (
    "map('timestampFormat', \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\", 'timeZone', 'UTC', "
    "'ignoreNullFields', 'false')"
)


def as_json(x: Sql) -> Sql:
    return f"to_json({x}, {JSON_OPTIONS})"


# Time stamps of a run; the records carry them last.
STAMPS = ("created_at", "updated_at")


def _body(item: Sql, fields: list[str]) -> tuple[Sql, Sql]:
    """JSON of a record without the stamps of its run, and of these."""
    def of(names: list[str]) -> Sql:
        return when(f"{item} IS NOT NULL", as_json(struct(**{n: f"{item}.`{n}`" for n in names})))

    stamps = [f for f in fields if f in STAMPS]
    return of([f for f in fields if f not in STAMPS]), of(stamps) if stamps else null("STRING")


def outbox(bundle: DataFrame, base_url: str = "") -> DataFrame:
    """Requests of every bundle: slug, stage, n, in no order.

    The bundles are worked out once. Activity, plans and images become rows before
    they become JSON, so no task holds all bodies of a bundle. ``digest`` tells
    requests apart by what they say: run stamps take no part in it.
    """
    base = quote(base_url.rstrip("/"))
    kinds = {f.name: f.dataType for f in bundle.schema.fields}
    types = {"activity": kinds["activity"], "plan": kinds["plans"].elementType, "image": kinds["gallery"].elementType}

    def entry(stage: int, n: Sql, name: str, value: Sql) -> Sql:
        parts = {k: value if k == name else null(t.simpleString()) for k, t in types.items()}
        return struct(stage=str(stage), n=n, **parts)

    def entries(stage: int, name: str, column: str) -> Sql:
        return f"transform(coalesce({column}, array()), (x, i) -> {entry(stage, 'i + 1', name, 'x')})"

    whole = f"array({entry(ACTIVITY, '1', 'activity', 'activity')})"
    every = f"concat({whole}, {entries(PLAN, 'plan', 'plans')}, {entries(IMAGE, 'image', 'gallery')})"
    # The outer generator keeps the optimizer from working the list out twice.
    rows = bundle.select("page_id", F.col("activity.slug").alias("slug"), F.explode_outer(F.expr(every)).alias("e"))

    bodies = {k: _body(f"e.{k}", t.fieldNames()) for k, t in types.items()}
    by_stage = "CASE e.stage WHEN 1 THEN {0} WHEN 2 THEN {1} ELSE {2} END"
    path = by_stage.format(
        quote(ACTIVITY_PATH), f"concat({quote(ACTIVITY_PATH + '/')}, slug, {quote(PLAN_QUERY)})",
        f"concat({quote(IMAGE_PATH)}, slug, '/imageInfo')")
    said, stamps = (by_stage.format(*[b[k] for b in bodies.values()]) for k in (0, 1))
    made = rows.select(
        "page_id", "slug", "e.stage", "e.n", F.lit("POST").alias("method"),
        F.expr(f"concat({base}, {path})").alias("url"), F.expr(said).alias("said"), F.expr(stamps).alias("stamps"))
    # cut by bytes: by characters, every body would be walked through twice
    opened = "CAST(substr(CAST(said AS BINARY), 1, octet_length(said) - 1) AS STRING)"
    joined = f"CASE WHEN stamps IS NULL THEN said ELSE concat({opened}, ',', substr(stamps, 2)) END"
    return made.select(
        "page_id", "slug", "stage", "n", "method", "url", F.expr(joined).alias("body"),
        F.expr("sha2(concat_ws('\n', method, url, said), 256)").alias("digest"))


def pending(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Requests that a run has still to send, after the results of runs before.

    results: slug, stage, n, status, the request's digest, and ``at``, by which they are ordered. A
    request is settled if the last result of its slug, stage and number is a success of
    that digest; so failed requests come again, and changed ones, also those that were
    changed back. Of results of the same time a failure counts, as to send again does no harm.
    A null slug is a slug like any other.

    What is decided is narrow. Requests without a ``body`` are joined to the last results
    and read once. That join is a merge: rows that come out of lists are many more than Spark
    expects by the size of the files, so it would send all last results to the driver. Those with one are filtered by the keys and digests that are left,
    which Spark broadcasts if they are few: they are read twice, so give a written table.
    """
    key = ["slug", "stage", "n"]
    # One struct: nulls in it are equal, and results are not dealt out again between aggregate and join.
    whole = F.struct(*key).alias("_key")
    good = F.expr("coalesce(status BETWEEN 200 AND 299, false)")
    last = results.groupBy(whole).agg(F.max(F.struct("at", (~good).alias("failed"), "digest")).alias("_last"))
    settled = last.where("NOT _last.failed").select("_key", F.col("_last.digest").alias("_said"), F.lit(True).alias("_settled"))

    def left(rows: DataFrame) -> DataFrame:
        joined = rows.select("*", whole).join(settled.hint("merge"), "_key", "left")
        return joined.where("_settled IS NULL OR NOT _said <=> digest").select(*rows.columns)

    if "body" not in requests.columns:
        return left(requests)
    a, b = requests.alias("a"), left(requests.select(*key, "digest").distinct()).alias("b")
    return a.join(b, reduce(and_, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*key, "digest")]), "left_semi")


def normalise(results: DataFrame) -> DataFrame:
    """Add ``ok``, the JSON body (or the text under ``raw``) and a detail text."""
    repeated_keys(results.sparkSession)
    data = f"coalesce({json_or_null('body')}, to_variant_object(named_struct('raw', body)))"
    detail = fallback(
        "try_variant_get(data, '$.slug', 'string')", "try_variant_get(data, '$.detail', 'string')"
    )
    return results.withColumns(
        {"ok": F.expr("status BETWEEN 200 AND 299"), "data": F.expr(data)}
    ).withColumn("detail", F.expr(detail))


def outcome(results: DataFrame) -> DataFrame:
    """Outcome of each slug; a stage without requests counts as done.

    Only counters are aggregated, before the shuffle, so a slug with very many
    images costs one row per task.
    """
    def failed(stage: int) -> str:
        return f"count_if(stage = {stage} AND NOT ok)"

    return (
        results.withColumn("ok", F.expr("coalesce(status BETWEEN 200 AND 299, false)"))
        .groupBy("slug")
        .agg(
            F.expr(f"count_if(stage = {ACTIVITY} AND ok) > 0 AND {failed(ACTIVITY)} = 0").alias(
                "activity_ok"
            ),
            F.expr(f"{failed(PLAN)} = 0").alias("plans_ok"),
            F.expr(f"{failed(IMAGE)} = 0").alias("images_ok"),
            F.expr(f"count_if(stage = {IMAGE} AND ok)").alias("images_done"),
            F.expr(f"count_if(stage = {IMAGE})").alias("images_total"),
        )
        .withColumn("ok", F.expr("activity_ok AND plans_ok AND images_ok"))
    )
