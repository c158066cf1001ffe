"""Activity and plan ids that no two records share, found by probing in rounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from excursio.functions.ids import hash32
from excursio.functions.sql import Sql
from excursio.sources.scratch import kept

FIRST, SPAN, PLAN_STEP = 1_000_000, 1_000_000_000, 100
#: Rounds that keep to a range too narrow for its records.
NARROW_ROUNDS = 6


def candidate(attempt: int, span: int = SPAN) -> Sql:
    """The id a record proposes in a round: that of its key at first, then of key, page and round."""
    key = "_key" if attempt == 0 else f"concat(_key, '#', CAST(page_id AS STRING), '#', {attempt})"
    return f"{FIRST} + {hash32(key)} % {span}"


def _claims(df: DataFrame) -> DataFrame:
    """The two ids a record takes up: its activity's and its plan's, which lies in the same range."""
    return df.select("page_id", F.explode(F.array("id", F.col("id") + PLAN_STEP)).alias("slot"))


def resolved_ids(pages: DataFrame, key: Sql = "url", span: int = SPAN, rounds: int = 64) -> DataFrame:
    """Rows (page_id, activity_id, plan_id, attempt): ids of all records, none twice.

    Rows of the same ``page_id`` are one record, with the least of their keys; rows without one get
    no ids. In a round every record without ids proposes a pair. A pair
    stands if neither id is settled from earlier rounds nor proposed by a record of smaller
    page_id; the others propose another in the next round. From the second round on the
    page takes part in the hash, so records that share a key part at once, however many
    they are. The record of the least page_id that meets no settled id always gets its pair, and
    the result depends on the rows alone: same rows, same ids. A null key counts as empty.

    A record is four numbers here, claims combine before the shuffle, and a round after the first
    reads of the settled ids only those that its few proposals meet. The range must hold
    the records with room to spare. If their ids fill more than half of ``span``, rounds would be
    without end (pairs placed at random jam a range at 1 - e^-2 of it); from round ``NARROW_ROUNDS``
    on proposals are then drawn from all ``SPAN`` ids. Records left after ``rounds`` are an error.
    """
    todo = pages.where("page_id IS NOT NULL").select("page_id", F.coalesce(F.expr(key).cast("string"), F.lit("")).alias("_key"))
    todo = todo.groupBy("page_id").agg(F.min("_key").alias("_key"))
    settled: list[DataFrame] = []
    wide = span
    for attempt in range(rounds):
        drawn = candidate(attempt, span if attempt < NARROW_ROUNDS else wide)
        todo = kept(todo.select("page_id", "_key", F.expr(drawn).alias("id")), "proposals")
        if todo.isEmpty():
            break
        if attempt == 0 and 4 * todo.count() > span:
            wide = max(span, SPAN)
        own = _claims(todo).select("slot", F.struct(F.lit(1).alias("late"), "page_id").alias("claim"))
        if settled:
            taken = reduce(DataFrame.unionByName, [_claims(s) for s in settled]).join(own.select("slot").distinct(), "slot", "left_semi")
            own = own.unionByName(taken.select("slot", F.struct(F.lit(0).alias("late"), "page_id").alias("claim")))
        owners = own.groupBy("slot").agg(F.min("claim").alias("claim")).where("claim.late = 1")
        won = owners.groupBy(F.col("claim.page_id").alias("page_id")).agg(F.count("*").alias("n")).where("n = 2").select("page_id")
        won = kept(todo.join(won, "page_id", "left_semi").select("page_id", "id", F.lit(attempt).alias("attempt")), "settled-ids")
        todo = todo.join(won, "page_id", "left_anti")
        settled.append(won)
    else:
        if not todo.isEmpty():
            raise ValueError(f"ids are too few: records are left after {rounds} rounds")
    if not settled:
        settled = [todo.select("page_id", "id", F.lit(0).alias("attempt"))]
    return reduce(DataFrame.unionByName, settled).select(
        "page_id", F.col("id").alias("activity_id"), (F.col("id") + PLAN_STEP).alias("plan_id"), "attempt")


def changed_ids(resolved: DataFrame) -> DataFrame:
    """Rows (page_id, custom_id) of the records whose id differs from the plain one; few, so the join that brings them moves no records."""
    return resolved.where("attempt > 0").select("page_id", F.col("activity_id").alias("custom_id"))
