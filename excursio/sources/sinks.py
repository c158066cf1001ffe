"""Writers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from excursio.functions.sql import struct
from excursio.functions.text import fallback
from excursio.operators.publish import as_json
from excursio.sources.scratch import exists, kept, names_in

#: Buckets of a new table of merged bundles.
BUCKETS = 64
_BUNDLE = "activity, plans, gallery, metadata"


def table_lines(df: DataFrame) -> DataFrame:
    """The rows as JSON texts, one column ``value``."""
    fields = {c: f"`{c}`" for c in df.columns}
    return df.select(F.expr(as_json(struct(**fields))).alias("value"))


def bundle_lines(bundle: DataFrame) -> DataFrame:
    """The latest bundle of each slug as JSON text: columns slug, value."""
    body = F.expr(as_json(f"struct({_BUNDLE})")).alias("value")
    return latest_per_slug(bundle).select("slug", body)


def write_table(df: DataFrame, location: str, fmt: str = "parquet") -> None:
    """Replace a derived table (Parquet or JSON lines)."""
    if fmt == "json":
        table_lines(df).write.mode("overwrite").text(location)
    else:
        df.write.mode("overwrite").format(fmt).save(location)


def latest_per_slug(bundle: DataFrame) -> DataFrame:
    """One bundle per slug: the last one captured, ties by page number.

    Which bundle is the last of its slug is settled on slug, time and page alone, which
    combine before the shuffle. Only the bundles that stay are moved; where they are few, the pages
    they are of go into the filter, so that no others are read or worked out. The bundles are
    read twice: rows whose ``page_id`` is drawn anew each time must be written first.
    """
    slug = F.expr(fallback("_slug", "'output'")).alias("slug")
    at = F.struct(F.col("_captured").alias("scraped_at"), "page_id").alias("_at")
    # Bare fields first: Spark then works out these two of the metadata and no others.
    keys = [F.col("metadata.slug").alias("_slug"), F.col("metadata.scraped_at").alias("_captured")]
    last = kept(bundle.select("page_id", *keys).select(slug, at).groupBy("slug").agg(F.max("_at").alias("_at")), "last-of-slug")
    listed = [r.page_id for r in last.select("_at.page_id").limit(LISTED + 1).collect()]
    if len(listed) <= LISTED:
        bundle = bundle.where(F.col("page_id").isin([p for p in listed if p is not None]) | F.col("page_id").isNull())
    named = bundle.select("*", *keys).select(slug, at, F.struct("page_id", "activity", "plans", "gallery", "metadata").alias("b"))
    # Grouped by what was joined on, so a large catalogue is not moved again.
    return (
        named.join(last, ["slug", "_at"], "left_semi")
        .groupBy("slug", "_at")
        .agg(F.max_by("b", "_at").alias("b"))
        .select("slug", "b.*")
    )


def write_bundles(bundle: DataFrame, location: str, directories: bool = False) -> None:
    """Write the latest bundle of each slug as JSON.

    All bundles go into one set of JSON-lines files. ``directories`` gives every slug
    its own directory instead and replaces only the slugs of this run: for small
    catalogues, as each slug costs a directory, a file and a partition to commit.
    """
    lines = bundle_lines(bundle)
    if directories:
        (
            lines.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("slug")
            .text(location)
        )
    else:
        lines.select("value").write.mode("overwrite").text(location)


def _buckets_at(spark: SparkSession, location: str) -> int | None:
    """Number of buckets of the table at a place; null if there is no table."""
    if not exists(spark, location):
        return None
    found = [int(n.removeprefix("buckets=")) for n in names_in(spark, location) if n.startswith("buckets=")]
    if len(found) > 1:
        raise ValueError(f"{location} holds tables of different numbers of buckets: {sorted(found)}")
    return found[0] if found else None


def merge_rows(rows: DataFrame, location: str, key: list[str], combine: Callable[[DataFrame], DataFrame], buckets: int | None = None) -> None:
    """Put rows, one for each key, into the table at a place; rows of keys that do not come up stay.

    The table is dealt into buckets by a hash of the key. Only buckets that the new rows
    touch are read, merged and replaced, so a run of few keys moves little of a large
    table. ``combine`` makes one row of those of a key: it sees old and new rows with the columns ``bucket`` and ``new``
    and returns them as the new ones came, with ``bucket``. A bucket is replaced whole: choose so many of them,
    when the table is made, that one holds a few hundred MB. Merged rows are written aside
    before anything is replaced; a run that broke off can be repeated.
    """
    spark = rows.sparkSession
    there = _buckets_at(spark, location)
    if there is not None and buckets not in (None, there):
        raise ValueError(f"{location} has {there} buckets, not {buckets}")
    n = there or buckets or BUCKETS
    place = f"{location}/buckets={n}"
    rows = kept(rows.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")), "new-rows")
    touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # n at most
    if not touched:
        return
    if there is not None:
        old = spark.read.schema(rows.schema).parquet(place).where(F.col("bucket").isin(touched))
        both = rows.withColumn("new", F.lit(True)).unionByName(old.withColumn("new", F.lit(False)))
        rows = kept(combine(both).select(*rows.columns), "merged-rows")
    (
        rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket").parquet(place)
    )


def merged_rows(spark: SparkSession, location: str, schema: str | None = None) -> DataFrame | None:
    """The table that ``merge_rows`` keeps, without its buckets; null if there is none."""
    n = _buckets_at(spark, location)
    if n is None:
        return None
    reader = spark.read.schema(f"{schema}, bucket INT") if schema else spark.read
    return reader.parquet(f"{location}/buckets={n}").drop("bucket")


def merge_bundles(bundle: DataFrame, location: str, buckets: int | None = None) -> None:
    """Put the latest bundle of each slug into the table at a place (``merge_rows``): the last capture wins, of equal ones the new one."""
    body = F.expr(as_json(f"struct({_BUNDLE})")).alias("value")
    rows = latest_per_slug(bundle).select("slug", F.col("metadata.scraped_at").alias("scraped_at"), "page_id", body)

    def combine(both: DataFrame) -> DataFrame:
        last = F.max_by(F.struct("scraped_at", "page_id", "value"), F.struct("scraped_at", "page_id", "new")).alias("b")
        return both.groupBy("bucket", "slug").agg(last).select("slug", "b.*", "bucket")

    merge_rows(rows, location, ["slug"], combine, buckets)


def merged_bundles(spark: SparkSession, location: str) -> DataFrame:
    """The table that ``merge_bundles`` keeps: slug, scraped_at, page_id and the bundle as JSON text."""
    rows = merged_rows(spark, location)
    if rows is None:
        raise ValueError(f"no merged bundles at {location}")
    return rows.select("slug", "scraped_at", "page_id", "value")


def save_bucketed(df: DataFrame, table: str, location: str, buckets: int, key: str = "page_id") -> DataFrame:
    """Write a table dealt into buckets by its key, under a name of the session, and open it.

    Tables of as many buckets join on the key without moving a row. Rows are dealt out
    once, here; a bucket should fit a task's memory several times over.
    """
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).option("path", location).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, table: str, location: str, buckets: int, key: str = "page_id") -> DataFrame:
    """Open a table that an earlier session wrote with ``save_bucketed``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(location).schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING parquet CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{location}'")
    return spark.table(table)


def write_clustered(df: DataFrame, location: str, by: str, files: int, spread: str = "page_id") -> None:
    """Write a table of about so many files, each a range of the values of a column and sorted by it.

    Parquet footers and pages then tell Spark what a look-up of few values can leave unread. Equal values are dealt out by a second
    column, so one that very many rows share fills several files and not one task.
    """
    ranged = df.repartitionByRange(files, by, spread).sortWithinPartitions(by, spread)
    ranged.write.mode("overwrite").parquet(location)


#: Values that a look-up puts into its filter; more are joined.
LISTED = 10_000


def look_up(table: DataFrame, values: DataFrame, by: str) -> DataFrame:
    """The rows of a clustered table whose column is among the values, a frame of one column.

    Few values become a filter that reaches the files; more become a join. Null is among no values.
    """
    wanted = values.toDF("_wanted").where("_wanted IS NOT NULL").distinct()
    listed = wanted.limit(LISTED + 1).collect()
    if len(listed) > LISTED:
        return table.join(wanted, F.col(by) == F.col("_wanted"), "left_semi")
    return table.where(F.col(by).isin([r[0] for r in listed]))
