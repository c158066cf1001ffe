"""URL rules by a sort-merge range join: reversed hosts, intervals and a stack of nested rules.

The labels of a host in reverse order, each followed by a dot, are its key. All hosts at or
below a rule's host then have keys that start with the rule's: an interval of the sorted keys,
and intervals nest or are apart. Pages and rules are dealt to ranges of (key, salt), so that
the pages of a host with very many of them fall into several ranges; a rule goes to
every range that its interval meets. Each task sorts its range and sweeps it once, keeping the
stack of the rules that hold at the key reached. A rule of a path fits below its whole host,
also at subdomains, where the paths are no interval of their own: so each host on the stack has
its rules by path, looked up by the prefixes of a page's path that some rule has.

The rule with the longest host and path wins; of equals, the longer host, then block. Null urls
and urls without :// have empty host and path, which only a rule with both empty fits. Rules
with a null host or path or without a verdict are left out. Rows and other columns stay as they are.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from excursio.llm.shared import fresh, ready

#: Keys that are looked at to place the bounds of the ranges; they decide nothing else.
SAMPLE = 20_000
SALTS = 1 << 16

_AFTER = r"(?s)^.*?://"


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next / ? # or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_replace(url, _AFTER, "")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.contains(url, F.lit("://")), lower).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; else empty."""
    rest = F.regexp_replace(url, _AFTER, "")
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)).otherwise("")


def key_of(host: Column) -> Column:
    """The labels of a host in reverse order, each with a dot behind; empty for an empty host."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


class Stack:
    """The rules that hold at the current key, by host from the shortest to the longest."""

    def __init__(self):
        self.hosts: list[tuple[str, dict[str, str], list[int]]] = []

    def move_to(self, key: str) -> None:
        while self.hosts and not key.startswith(self.hosts[-1][0]):
            self.hosts.pop()

    def add(self, key: str, path: str, verdict: str) -> None:
        self.move_to(key)
        if not self.hosts or self.hosts[-1][0] != key:
            self.hosts.append((key, {}, []))
        _, paths, sizes = self.hosts[-1]
        if paths.get(path) != "block":
            paths[path] = verdict
        if len(path) not in sizes:
            sizes.append(len(path))
            sizes.sort(reverse=True)

    def best(self, path: str) -> tuple[str, str, str] | None:
        """Key, path and verdict of the rule that wins at the current key."""
        out = None
        for key, paths, sizes in self.hosts:
            for size in sizes:
                if size <= len(path) and (verdict := paths.get(path[:size])) is not None:
                    if out is None or len(key) + size >= len(out[0]) + len(out[1]):
                        out = key, path[:size], verdict
                    break
        return out


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", out: str = "filter",
           sample: int = SAMPLE) -> DataFrame:
    """The rows with a struct column (host, path, rule, verdict); it replaces a column of that name.

    rules: columns host, path and verdict (allow or block). rule is host and path of the rule that wins, else null.
    """
    spark = pages.sparkSession
    ready(spark)
    pages = pages.drop(*[c for c in pages.columns if c.lower() == out.lower()])
    row, key, salt, task = (fresh(pages, f"_{x}") for x in ("row", "key", "salt", "task"))
    source = F.col(f"`{url}`")
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, k in pages.dtypes if k in ("string", "bigint", "int")]), F.lit(SALTS)).cast("int")
    left = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias(row),
                        F.coalesce(host_of(source), F.lit("")).alias("host"), F.coalesce(path_of(source), F.lit("")).alias("path"), spread.alias(salt))
    left = left.select(row, "host", "path", key_of(F.col("host")).alias(key), salt)
    right = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IN ('allow', 'block')")
    right = right.select(key_of(F.col("host")).alias(key), "path", "verdict").distinct()

    # more ranges than partitions, as ranges are dealt to partitions by hash
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the keys of least hash are a sample that a repeated task draws again; about so many reach the driver
    part = min(1.0, sample / max(pages.count(), 1))
    chosen = F.pmod(F.xxhash64(key, salt, F.lit(1)), F.lit(1 << 30)) < int(part * (1 << 30))
    picked = sorted((r[0], r[1]) for r in left.where(chosen).select(key, salt).collect())
    bounds = sorted({picked[len(picked) * k // ranges] for k in range(1, ranges)}) if picked else []

    def place(keys: pa.Array, salts: pa.Array) -> pa.Array:
        return pa.array([bisect_right(bounds, x) for x in zip(keys.to_pylist(), salts.to_pylist())], pa.int32())

    def met(keys: pa.Array) -> pa.Array:
        last = "\U0010ffff"
        return pa.array([list(range(bisect_right(bounds, (k, -1)), bisect_right(bounds, (k + last, SALTS)) + 1)) for k in keys.to_pylist()],
                        pa.list_(pa.int32()))

    left = left.select(arrow_udf(place, "int")(F.col(key), F.col(salt)).alias(task), key, F.lit(1).alias("is_page"), "path",
                       F.lit(None).cast("string").alias("verdict"), "host", row)
    right = right.select(F.explode(arrow_udf(met, "array<int>")(F.col(key))).alias(task), key, F.lit(0).alias("is_page"), "path", "verdict",
                         F.lit(None).cast("string").alias("host"), F.lit(None).cast(left.schema[row].dataType).alias(row))
    # rules go before the pages of their own host
    both = left.union(right).repartition(task).sortWithinPartitions(task, key, "is_page")
    shape = both.schema
    fields = ["task", "key", "is_page", "path", "verdict"]
    places = [shape.names.index(task), shape.names.index(key), 2, 3, 4]

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack, now = Stack(), None
        for batch in batches:
            cols = dict(zip(fields, (batch.column(k).to_pylist() for k in places)))
            keep, rules_out, verdicts = [], [], []
            for k, (at, own, is_page, path, verdict) in enumerate(zip(*(cols[f] for f in fields))):
                if at != now:
                    stack, now = Stack(), at
                if not is_page:
                    stack.add(own, path, verdict)
                    continue
                stack.move_to(own)
                best = stack.best(path)
                keep.append(k)
                rules_out.append(None if best is None else ".".join(reversed(best[0].split(".")[:-1])) + best[1])
                verdicts.append(default if best is None else best[2])
            took = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [took.column(shape.names.index(row)), took.column(5), took.column(3),
                 pa.array(rules_out, pa.string()), pa.array(verdicts, pa.string())], ["row", "host", "path", "rule", "verdict"])

    kind = both.schema[row].dataType.simpleString()
    swept = both.mapInArrow(sweep, f"row {kind}, host string, path string, rule string, verdict string")
    return swept.select(*[F.col(f"row.`{c}`") for c in pages.columns], F.struct("host", "path", "rule", "verdict").alias(out))
