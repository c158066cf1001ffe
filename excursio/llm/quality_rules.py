"""Quality rules with thresholds learnt from the corpus: DataFrame and SQL functions only.

Every document gets a few integer measures. Per language and source, each measure is
summed up in a log-linear histogram: a quantile sketch of relative error 1/32 whose merge
is the addition of counts, so it combines before the shuffle and sources add up to languages.
Quartiles of the sketches give outlier fences, which a join brings back to the documents.

Null or empty texts have no words and fail the base rule. Null languages and sources are
groups like any other. Repeated rows are judged one by one. Other columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from excursio.llm.shared import fresh, stored

#: measure -> (least distance of the upper fence from the upper quartile, the same below or None).
#: All but mean_length count per thousand; mean_length is in hundredths of a code point.
MEASURES = {
    "symbols": (60, None),
    "capitals": (350, None),
    "exclaims": (60, None),
    "dup_lines": (300, None),
    "repeats": (150, None),
    "mean_length": (300, 300),
}
#: A fence lies at least so many interquartile ranges from its quartile.
SPREAD = 3
#: Groups of fewer documents take the fences of their language.
LEAST_DOCUMENTS = 50

WORDS = r"array_remove(split({text}, '[ \\t\\n\\x0B\\f\\r]+'), '')"
SPACES = r"' \t\n\u000B\u000C\r'"


def measured(docs: DataFrame, text: str = "text", out: str = "quality") -> DataFrame:
    """The rows with a struct column of the base values and the measures.

    Five-word windows are compared by their 64-bit hashes.
    """
    value, words, hashes, order = (fresh(docs, f"_{x}") for x in ("value", "words", "hashes", "order"))
    keep = [F.col(f"`{c}`") for c in docs.columns]
    t = f"`{value}`"
    df = docs.select(*keep, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(value))
    df = df.select(*keep, value, F.expr(WORDS.format(text=t)).alias(words))
    window = ", ".join(f"{words}[i + {k}]" for k in range(5))
    df = df.select(*keep, value, words, F.expr(
        f"CASE WHEN size({words}) < 6 THEN array() ELSE transform(sequence(0, size({words}) - 5), i -> xxhash64({window})) END"
    ).alias(hashes))
    # only texts that repeat a window are sorted
    df = df.select(*keep, value, words, F.expr(
        f"CASE WHEN size(array_distinct({hashes})) < size({hashes})"
        f" THEN array_sort(transform({hashes}, (h, i) -> struct(h, i))) END").alias(order))
    twice = (f"filter(sequence(0, size({order}) - 1), k -> (k > 0 AND {order}[k].h = {order}[greatest(k - 1, 0)].h)"
             f" OR (k + 1 < size({order}) AND {order}[k].h = {order}[least(k + 1, size({order}) - 1)].h))")
    covered = (f"CASE WHEN {order} IS NULL THEN 0L ELSE aggregate(array_sort(transform({twice}, k -> {order}[k].i)),"
               " named_struct('n', 0L, 'end', 0),"
               " (a, x) -> named_struct('n', a.n + 5 - greatest(0, a.end - x), 'end', x + 5), a -> a.n) END")
    lines = rf"filter(split({t}, '\\n'), x -> x RLIKE '[^ \\t\\n\\x0B\\f\\r]')"
    base = fresh(docs, "_base")
    df = df.select(*keep, F.expr(f"""named_struct(
        'n_words', CAST(size({words}) AS BIGINT),
        'word_chars', CAST(length(translate({t}, {SPACES}, '')) AS BIGINT),
        'n_symbols', CAST(length({t}) - length(translate({t}, '#*$%&|<>', '')) AS BIGINT),
        'capitals', CAST(length({t}) - length(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS BIGINT),
        'exclaims', CAST(length({t}) - length(replace({t}, '!', '')) AS BIGINT),
        'n_repeat_words', {covered},
        'lines', {lines})""").alias(base))
    df = df.select(*keep, F.expr(f"""named_struct(
        'n_words', {base}.n_words, 'word_chars', {base}.word_chars, 'n_symbols', {base}.n_symbols,
        'n_dup_lines', CAST(size({base}.lines) - size(array_distinct({base}.lines)) AS BIGINT),
        'n_repeat_words', {base}.n_repeat_words,
        'n_lines', CAST(size({base}.lines) AS BIGINT),
        'capitals', {base}.capitals, 'exclaims', {base}.exclaims)""").alias(base))
    b = lambda c: f"{base}.{c}"
    return df.select(*keep, F.expr(f"""named_struct(
        'n_words', {b('n_words')}, 'word_chars', {b('word_chars')}, 'n_symbols', {b('n_symbols')},
        'n_dup_lines', {b('n_dup_lines')}, 'n_repeat_words', {b('n_repeat_words')},
        'base_failed', {b('n_words')} < 10 OR 100 * {b('n_repeat_words')} > 20 * {b('n_words')},
        'symbols', 1000 * {b('n_symbols')} div greatest({b('word_chars')}, 1L),
        'capitals', 1000 * {b('capitals')} div greatest({b('word_chars')}, 1L),
        'exclaims', 1000 * {b('exclaims')} div greatest({b('word_chars')}, 1L),
        'dup_lines', 1000 * {b('n_dup_lines')} div greatest({b('n_lines')}, 1L),
        'repeats', 1000 * {b('n_repeat_words')} div greatest({b('n_words')}, 1L),
        'mean_length', 100 * {b('word_chars')} div greatest({b('n_words')}, 1L))""").alias(out))


def bucket_of(value: Column) -> Column:
    """Bucket of a non-negative integer: itself below 64, else 32 buckets to each power of two."""
    shift = F.length(F.bin(value)).cast("int") - 6
    return F.when(value < 64, value).otherwise(F.call_function("shiftright", value, shift) + 32 * shift)


def value_of(bucket: Column) -> Column:
    """Least value of a bucket."""
    shift = F.floor(bucket / 32).cast("int") - 1
    return F.when(bucket < 64, bucket).otherwise(F.call_function("shiftleft", bucket - 32 * shift, shift))


def sketch(df: DataFrame, groups: dict[str, str], quality: str = "quality") -> DataFrame:
    """Sketches as rows (group columns, measure, bucket, n); texts without words are left out."""
    parts = F.array(*[F.struct(F.lit(m).alias("measure"), bucket_of(F.col(f"{quality}.{m}")).alias("bucket"))
                      for m in MEASURES])
    keys = [F.col(f"`{c}`").alias(k) for k, c in groups.items()]
    rows = df.where(f"{quality}.n_words > 0").select(*keys, F.explode(parts).alias("x")).select(*groups, "x.*")
    return merge(rows.withColumn("n", F.lit(1)), list(groups))


def merge(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """Sketches of coarser groups, or of several tables put together: the counts add up."""
    return sketches.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """Rows (group columns, measure, documents, low, high): first and third quartile of each sketch."""
    from pyspark.sql import Window

    whole = Window.partitionBy(*groups, "measure")
    df = sketches.select("*", F.sum("n").over(whole.orderBy("bucket")).alias("upto"), F.sum("n").over(whole).alias("documents"))
    return df.groupBy(*groups, "measure", "documents").agg(
        value_of(F.min(F.when(F.expr("upto * 4 >= documents"), F.col("bucket")))).alias("low"),
        value_of(F.min(F.when(F.expr("upto * 4 >= documents * 3"), F.col("bucket")))).alias("high"))


def fences(sketches: DataFrame) -> DataFrame:
    """One row per language and source with the bounds <measure>_min and <measure>_max."""
    own = quartiles(sketches, ["lang", "source"])
    wide = quartiles(merge(sketches, ["lang"]), ["lang"]).select(
        F.col("lang").alias("lang_"), F.col("measure").alias("measure_"), F.col("low").alias("low_"), F.col("high").alias("high_"))
    both = own.join(wide, own["lang"].eqNullSafe(wide["lang_"]) & (own["measure"] == wide["measure_"]), "left")
    small = F.col("documents") < LEAST_DOCUMENTS
    both = both.select("lang", "source", "measure", F.when(small, F.col("low_")).otherwise(F.col("low")).alias("low"),
                       F.when(small, F.col("high_")).otherwise(F.col("high")).alias("high"))
    spread = SPREAD * (F.col("high") - F.col("low"))
    bounds = []
    for m, (above, below) in MEASURES.items():
        own_row = F.col("measure") == m
        bounds.append(F.max(F.when(own_row, F.col("high") + F.greatest(spread, F.lit(above)))).alias(f"{m}_max"))
        if below is not None:
            bounds.append(F.max(F.when(own_row, F.col("low") - F.greatest(spread, F.lit(below)))).alias(f"{m}_min"))
    return both.groupBy("lang", "source").agg(*bounds)


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", out: str = "quality",
          keep_text: bool = True) -> DataFrame:
    """The rows with a struct column: base values, measures, base_failed and kept; it replaces a column of that name."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == out.lower()])
    df = measured(docs, text, out)
    if not keep_text:
        docs, df = docs.drop(text), df.drop(text)
    df = stored(df, "measured")
    # written, so that the size of the fences is known when the join is planned: small ones leave the texts in place
    limits = stored(fences(sketch(df, {"lang": lang, "source": source}, out)), "fences")
    names = {c: fresh(df, f"_{c}") for c in limits.columns}
    limits = limits.select(*[F.col(c).alias(n) for c, n in names.items()])
    joined = df.join(limits, df[f"`{lang}`"].eqNullSafe(limits[names["lang"]])
                     & df[f"`{source}`"].eqNullSafe(limits[names["source"]]), "left")
    checks = [~F.col(f"{out}.base_failed")]
    for m, (_, below) in MEASURES.items():
        checks.append(F.col(f"{out}.{m}") <= F.col(names[f"{m}_max"]))
        if below is not None:
            checks.append(F.col(f"{out}.{m}") >= F.col(names[f"{m}_min"]))
    kept = F.coalesce(reduce(Column.__and__, checks), F.lit(False))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(out).withField("kept", kept).alias(out))


def keep_good(docs: DataFrame, **columns: str) -> DataFrame:
    """The rows that the rules keep, columns as they were."""
    out = fresh(docs, "quality")
    return judge(docs, out=out, **columns).where(f"{out}.kept").select(*[F.col(f"`{c}`") for c in docs.columns])
