"""Relations between the written tables: joins and id collisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["page_id", "activity_id"]
# A parent is large from this share of all children on; so fewer than this many
# parents are, which bounds what is broadcast below.
LARGE_SHARE = 1000
SMALL_GROUP = 100_000


def join_children(
    parents: DataFrame, children: DataFrame, key: list[str], salt: Column, how: str = "inner",
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """Parents with each of their children, by ``key`` (unique among parents).

    One parent may hold a large share of all children. Such a parent is repeated
    once per salt and its children are dealt out over the salts, so no task gets
    the whole group; all other rows move once. ``how`` is ``inner`` or ``left``
    (parents without children stay). ``salt`` is a stable expression over a child,
    so that a retried task deals the same way.

    Nothing runs here: the children are counted per key in the plan, and their total
    is a subquery of it. Fewer than LARGE_SHARE parents can hold more than that share.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    counts = children.groupBy(*key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total")).scalar()
    limit = F.greatest(F.lit(small_group), F.coalesce(F.floor(total / LARGE_SHARE), F.lit(0)))
    large = F.broadcast(
        counts.select(*key, "_n", limit.alias("_limit"))
        .filter(F.col("_n") > F.col("_limit"))
        .select(*key, F.ceil(F.col("_n") / F.col("_limit")).cast("int").alias("_salts"))
    )
    deal = F.xxhash64(salt)
    dealt = (
        children.join(large, key, "left")
        .withColumn("_salt", F.coalesce(F.pmod(deal, F.col("_salts")).cast("int"), F.lit(0)))
        .drop("_salts")
        .withColumn("_child", F.lit(True))
    )
    repeated = parents.join(large, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    joined = repeated.join(dealt, [*key, "_salt"], how)
    if how == "left":
        # A large parent has children, so a salt of it without any is no parent row.
        joined = joined.filter(F.col("_child") | F.col("_salts").isNull())
    return joined.drop("_salt", "_salts", "_child")


def _prefixed(df: DataFrame, prefix: str, key: list[str]) -> DataFrame:
    return df.select(*key, *[F.col(c).alias(prefix + c) for c in df.columns if c not in key])


def activity_plans(activity: DataFrame, plan: DataFrame) -> DataFrame:
    """Activities with their plans: one of each per page, so a plain join."""
    parents = _prefixed(activity.withColumnRenamed("id", "activity_id"), "activity_", KEY)
    return parents.join(_prefixed(plan, "plan_", KEY), KEY)


def activity_gallery(activity: DataFrame, gallery: DataFrame) -> DataFrame:
    """Activities with their images (1:n); activities without images stay."""
    parents = _prefixed(activity.withColumnRenamed("id", "activity_id"), "activity_", KEY)
    return join_children(
        parents, _prefixed(gallery, "image_", KEY), KEY, F.col("image_order"), "left"
    )


def id_collisions(records: DataFrame) -> DataFrame:
    """Ids that more than one record carries.

    Ids are 32-bit, so about n²/2·10⁹ of n pages meet; page_id stays the real key.
    """
    return records.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
