"""Mixing sources to target weights: blocks of equal size, apportioned by highest quotients.

Targets: the mix takes `share` of all words. Sources by code point, null last, get parts by the
weights in turn; none gets more than `most` times its own words, and what is above is dealt to
the others by weight until none is above.

Blocks: each source is dealt by hash into shards of about SHARD words; a shard's documents lie
in a seeded order, and their words are cut into blocks of equal size, about BLOCK words.
Sainte-Laguë gives the blocks of the mix to the sources and those of a source to its shards:
quotients votes / 1, votes / 3, votes / 5, ... compete and the highest win. A shard with quota q
of n blocks takes every block q div n times and q mod n of them, chosen by the seed, once more.
So a source misses its target by about a block, and no document exceeds the limit.

Results are the same on every run and for every partitioning: order and choice come from hashes
of the rows. Equal rows are counted before anything moves and are numbered afterwards, so
copies of one row may be many; which of the equal rows takes which words does not matter.
Null counts as an empty text; a text without words takes nothing. Very long texts may span
any number of blocks. An empty table gives no rows. Columns of the input may have any name; one
called like the result is replaced. Columns that are kept must be of types that can be grouped.

Sources and shards are tables of one row each (a shard for a million words); they
are joined, not collected, and Spark broadcasts them only below its threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from excursio.llm.shared import stored

#: Words of a block and of a shard, and rows of a shard.
BLOCK, SHARD, SHARD_ROWS = 64, 1 << 20, 1 << 16
#: Weights of the sources in turn, words of the mix by words there are, and most repeats of a source.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Primes below 2^31, more than any shard has blocks, so that steps of them meet every block once.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497)


def n_words(text: Column) -> Column:
    """Number of words between white space."""
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     ")
    return F.size(F.array_remove(F.split(plain, " "), "")).cast("long")


def apportion(df: DataFrame, group: Sequence[str], order: Sequence[str], votes: str, seats: str, out: str) -> DataFrame:
    """Adds the seats of every row: within a group, the seats go to the highest quotients votes / (2 k + 1).

    Of equal quotients the row that comes first in the order wins. The divisor that deals s seats
    among n rows lies between total / (s + n / 2) and total / (s - n / 2), so all but about
    two quotients a row are known to win or to lose, and only those in between are ranked.
    """
    g = Window.partitionBy(*group)
    total, n = F.sum(votes).over(g), F.sum((F.col(votes) > 0).cast("long")).over(g)
    share = F.when(F.col(votes) > 0, F.col(votes) / total).otherwise(0.0)
    sure = F.greatest(F.lit(0), F.floor(share * (F.col(seats) - n / 2) - 0.5) - 1)
    rows = df.withColumns({"_sure": sure, "_most": F.ceil(share * (F.col(seats) + n / 2) + 0.5) + 1})
    rows = rows.withColumn("_open", F.col(seats) - F.sum("_sure").over(g))
    tried = F.when(F.col(votes) > 0, F.sequence("_sure", "_most"))
    rows = rows.withColumn("_k", F.explode_outer(tried)).withColumn("_quotient", F.col(votes) / (2 * F.col("_k") + 1))
    ranks = F.row_number().over(g.orderBy(F.col("_quotient").desc_nulls_last(), *order, "_k"))
    won = F.col("_k").isNotNull() & (ranks <= F.col("_open"))
    return (rows.withColumn("_won", won.cast("long")).groupBy(*df.columns)
            .agg((F.first("_sure") + F.sum("_won")).alias(out)))


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """The rows (source, words, ...) with weight, target and full: whether the limit decides.

    By rising ratio of limit to weight, the sources that their limits stop come first; the
    first that is not stopped sets how many words a unit of weight gets.
    """
    in_turn = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    every = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("weight", F.get(every, (F.row_number().over(in_turn) - 1) % len(weights)))
    rows = rows.withColumn("limit", F.col("words") * float(most))
    by_ratio = Window.partitionBy().orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("words").over(whole) * float(share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("unit", left / weight_left).withColumn("full", F.col("limit") <= F.col("weight") * F.col("unit"))
    unit = F.first(F.when(~F.col("full"), F.col("unit")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("unit", unit).withColumn("full", F.col("unit").isNull() | (F.col("limit") <= F.col("weight") * F.col("unit")))
    return rows.select(*sizes.columns, "weight", "full",
                       F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * F.col("unit")).alias("target"))


def _of_source(left: DataFrame, right: DataFrame, *more: str) -> DataFrame:
    """The rows with the columns of the row of their source (and more); null is a source of its own."""
    keys = ("source", *more)
    right = right.withColumnsRenamed({k: f"{k}_" for k in keys})
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"{k}_"))
    return left.join(right, same).drop(*[f"{k}_" for k in keys])


def mixed(docs: DataFrame, keep: Sequence[str] | None = None, text: str = "text", source: str = "source", share: float = SHARE,
          most: int = MOST, weights: Sequence[int] = WEIGHTS, block: int = BLOCK, shard: int = SHARD, seed: int = 7,
          out: str = "mix") -> DataFrame:
    """The rows, with the columns to keep (all by default) and a struct column of what the mix takes of them.

    It has size (words of the text), source_size, target (of the source), taken (words, repeats
    counted) and spans: begin, end and times of the words taken, by their number in the text.
    """
    names = [c for c in (keep if keep is not None else docs.columns) if c.lower() != out.lower()]
    row = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(0).alias("_none"))
    items = docs.select(row.alias("row"), F.col(f"`{source}`").alias("source"), n_words(F.col(f"`{text}`")).alias("size"),
                        F.xxhash64(F.col(f"`{text}`")).alias("print"))
    items = stored(items.groupBy("row", "source", "size", "print").agg(F.count("*").alias("copies"))
                   .withColumn("words", F.col("size") * F.col("copies")), "mix-items")

    sizes = items.groupBy("source").agg(F.sum("words").alias("words"), F.count("*").alias("n_items"))
    n_shards = F.greatest(F.ceil(F.col("words") / shard), F.ceil(F.col("n_items") / SHARD_ROWS), F.lit(1))
    plan = stored(targets(sizes.withColumn("n_shards", n_shards).drop("n_items"), share, most, weights), "mix-sources")
    dealt = F.xxhash64(F.lit(seed), "row", "print")
    place = F.xxhash64(F.lit(seed), F.lit("place"), "row", "print")
    items = _of_source(items, plan.select("source", "n_shards")).withColumns({"shard": F.pmod(dealt, "n_shards"), "place": place})

    # what a shard holds, and the blocks it takes
    per_shard = items.groupBy("source", "shard").agg(F.sum("words").alias("shard_words")).withColumn(
        "n_blocks", F.when(F.col("shard_words") > 0, F.greatest(F.lit(1), F.round(F.col("shard_words") / block).cast("long"))).otherwise(0))
    per_source = per_shard.groupBy("source").agg(F.sum("n_blocks").alias("blocks"))
    votes = F.when(F.col("words") > 0, F.col("target") * F.col("blocks") / F.col("words")).otherwise(0.0)
    seats = _of_source(plan, per_source).withColumn("votes", votes)
    free = seats.where("NOT full").withColumn("seats", F.round(F.sum("votes").over(Window.partitionBy())).cast("long"))
    free = apportion(free, [], [F.col("source").asc_nulls_last()], "votes", "seats", "quota")
    most_blocks = F.col("blocks") * most
    both = free.withColumn("quota", F.least("quota", most_blocks)).drop("seats").unionByName(seats.where("full").withColumn("quota", most_blocks))
    both = both.select("source", F.col("words").alias("source_size"), "target", "quota")
    quotas = apportion(_of_source(per_shard.withColumn("votes", F.col("n_blocks").cast("double")), both),
                       ["source"], ["shard"], "votes", "quota", "taken_blocks")
    quotas = stored(quotas.drop("votes", "quota"), "mix-shards")

    # where each text lies in its shard
    along = Window.partitionBy("source", "shard").orderBy("place", "print", "row").rowsBetween(Window.unboundedPreceding, -1)
    items = items.withColumn("start", F.coalesce(F.sum("words").over(along), F.lit(0)))
    items = _of_source(items, quotas, "shard")
    items = items.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    items = items.withColumn("start", F.col("start") + F.col("copy") * F.col("size")).withColumn("end", F.col("start") + F.col("size"))

    # block k holds the words from k * shard_words div n_blocks on
    step = F.get(F.array(*map(F.lit, PRIMES)), F.pmod(F.xxhash64(F.lit(seed), F.lit("step"), "source", "shard"), F.lit(len(PRIMES))).cast("int"))
    items = items.withColumns({"step": step, "first": F.pmod(F.xxhash64(F.lit(seed), F.lit("first"), "source", "shard"), F.greatest("n_blocks", F.lit(1)))})
    spans = F.expr("""
        CASE WHEN size > 0 THEN filter(transform(
            sequence(((start + 1) * n_blocks - 1) DIV shard_words, (end * n_blocks - 1) DIV shard_words),
            k -> named_struct('begin', greatest(start, k * shard_words DIV n_blocks) - start,
                'end', least(end, (k + 1) * shard_words DIV n_blocks) - start,
                'times', taken_blocks DIV n_blocks + IF((step * k + first) % n_blocks < taken_blocks % n_blocks, 1, 0))),
            s -> s.times > 0) ELSE array() END""")
    items = items.withColumn("spans", spans)
    taken = F.expr("aggregate(spans, 0L, (n, s) -> n + (s.end - s.begin) * s.times)")
    result = F.struct("size", "source_size", "target", taken.alias("taken"), "spans").alias(out)
    return items.select("row.*" if names else F.lit(0).alias("_none"), result).select(*[F.col(f"`{c}`") for c in names], F.col(f"`{out}`"))


def passages(mix: DataFrame, text: str = "text", out: str = "mix", passage: str = "passage") -> DataFrame:
    """The words that the mix takes, one row per span and repeat, joined by one space in the column passage."""
    rows = mix.withColumn(passage, F.explode(f"{out}.spans"))
    rows = rows.withColumn(passage, F.explode(F.array_repeat(passage, F.col(f"{passage}.times").cast("int"))))
    words = F.array_remove(F.split(F.translate(F.col(f"`{text}`"), "\t\n\x0b\f\r", "     "), " "), "")
    span = F.col(passage)
    return rows.withColumn(passage, F.array_join(F.slice(words, (span.begin + 1).cast("int"), (span.end - span.begin).cast("int")), " "))
