"""Near-duplicates by SimHash: word-shingle fingerprints joined by a binary trie.

A fingerprint bit is 1 where over half of the text's shingle hashes have it. Distinct
fingerprints are joined with each other: two that differ in at most three of 64 bits agree
in at least one of four 16-bit blocks. For each block, the fingerprint rotated to start with
it is an entry of a binary trie whose first 16 levels are the group it is dealt to; below
them, pairs of trie nodes are traversed together, adding up differing bits, and a pair is
dropped once it exceeds the budget, or when all that it holds is linked already. A group
hands on a spanning forest of its links; components of all of them follow in Spark.

Groups that hold many fingerprints are dealt by a second block, and what is large still as
pairs of parts, so that none meets in one task. Null and wordless texts have fingerprint zero, which links like any other. Equal texts
and repeated rows share a fingerprint and hence a component. Other columns are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from excursio.llm.components import components
from excursio.llm.shared import SPACE_SEPARATED, fresh, in_parts, ready, stored, text_buffers, word_spans

SHINGLE = 3
SEED = 42
BITS = 3
BLOCKS, BLOCK = 4, 16
#: Distinct fingerprints that one task joins with each other at most; larger groups are dealt as pairs of parts.
GROUP = 1024
#: Pairs of fingerprints compared at once.
AT_ONCE = 1 << 20

_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(shingles: Iterator[bytes]) -> int:
    """The fingerprint of shingles given as bytes."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    return int(_majority(hashes, np.array([0, len(hashes)]))[0])


def _majority(hashes: np.ndarray, offsets: np.ndarray, part: int = 1 << 16) -> np.ndarray:
    """For each run of hashes the bits set in over half of them; zero for an empty run."""
    n = np.diff(offsets)
    ones = np.zeros((len(n), 64), np.int64)
    for lo in range(0, len(hashes), part):
        bits = np.unpackbits(hashes[lo : lo + part].astype(">u8").view(np.uint8)).reshape(-1, 64)
        first = int(np.searchsorted(offsets, lo, "right")) - 1
        last = int(np.searchsorted(offsets, lo + len(bits), "left"))
        cuts = np.clip(offsets[first:last] - lo, 0, len(bits))
        full = np.flatnonzero(np.diff(np.append(cuts, len(bits))) > 0)
        ones[first + full] += np.add.reduceat(bits, cuts[full], axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > n[:, None], axis=1)
    return packed.view(">u8").astype(np.uint64).ravel()


def _fingerprints(texts: pa.Array) -> pa.Array:
    data, offsets = text_buffers(texts)
    out = np.zeros(len(texts), np.uint64)
    hashed = xxhash.xxh64_intdigest
    for lo, hi in in_parts(offsets):
        raw = data[offsets[lo] : offsets[hi]]
        at = offsets[lo : hi + 1] - offsets[lo]
        starts, ends, first = word_spans(raw, at, SPACE_SEPARATED)
        n_words = np.diff(first)
        # words of a text, joined by single spaces, in one byte string
        raw = raw.tobytes().translate(_UPPER)
        size = ends - starts
        joined = b" ".join([raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())])
        begin = np.zeros(len(size), np.int64)
        np.cumsum(size[:-1] + 1, out=begin[1:])
        stop = begin + size
        n = np.where(n_words == 0, 0, np.maximum(n_words - SHINGLE + 1, 1))
        run = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=run[1:])
        own = np.arange(run[-1]) - np.repeat(run[:-1], n) + np.repeat(first[:-1], n)
        end = np.minimum(own + SHINGLE, np.repeat(first[1:], n)) - 1
        pairs = zip(begin[own].tolist(), stop[end].tolist())
        hashes = np.fromiter((hashed(joined[s:e], SEED) for s, e in pairs), np.uint64, int(run[-1]))
        out[lo:hi] = _majority(hashes, run)
    return pa.array(out.view(np.int64))


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """The rows with their fingerprint as a signed 64-bit column."""
    ready(docs.sparkSession)
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns], arrow_udf(_fingerprints, "bigint")(F.col(f"`{text}`")).alias(out))


class _Forest:
    """Links among n entries, as the least entry that each is linked to."""

    def __init__(self, n: int):
        self.least = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        least = self.least
        while len(a):
            ra, rb = least[a], least[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                break
            np.minimum.at(least, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = least[least]
                if (up == least).all():
                    break
                least[:] = up


def _near(keys: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(keys[a] ^ keys[b]) <= most


def trie_links(keys: np.ndarray, group: np.ndarray, side: np.ndarray, most: int = BITS) -> np.ndarray:
    """Least linked entry of each entry: keys sorted within consecutive groups, distinct in each.

    Entries of a group are compared with each other, but none of side 1 with side 1 nor of
    side 2 with side 2; side 0 stands for both. Node pairs are index ranges with the bits
    they differ in so far.
    """
    n = len(keys)
    forest = _Forest(n)
    if n < 2:
        return forest.least
    one = np.arange(n - 1)
    same = (group[:-1] == group[1:]) & _near(keys, one, one + 1, most)
    forest.link(one[same], one[same] + 1)
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    end = np.append(begin[1:], n)
    stack = [(BLOCK, np.stack([begin, end, begin, end, np.zeros(len(begin), np.int64)], 1))]
    while stack:
        depth, nodes = stack.pop()
        if len(nodes) > 4096:  # a part of the pairs at a time, so that the stack stays small
            stack += [(depth, nodes[4096:]), (depth, nodes[:4096])]
            continue
        alo, ahi, blo, bhi, _ = nodes.T
        work = (ahi - alo) * (bhi - blo)
        leaf = (work <= 1024) | (depth == 64)
        done = np.array([_one(forest.least, *x[:4]) if w > 1024 else False for x, w in zip(nodes, work)], bool)
        _compare(forest, keys, group, side, nodes[leaf & ~done], most)
        rest = nodes[~leaf & ~done]
        if len(rest):
            stack.append((depth + 1, _children(keys, rest, depth, most)))
    return forest.least


def _one(least: np.ndarray, alo: int, ahi: int, blo: int, bhi: int) -> bool:
    """Whether all entries of two nodes are linked already."""
    root = least[alo]
    return bool((least[alo:ahi] == root).all() and (least[blo:bhi] == root).all())


def _children(keys: np.ndarray, nodes: np.ndarray, depth: int, most: int) -> np.ndarray:
    """Pairs of children of node pairs within the budget; an own pair splits into three."""
    bit = np.uint64(1 << (63 - depth))

    def split(lo, hi):
        return np.array([a + int(np.count_nonzero((keys[a:b] & bit) == 0)) for a, b in zip(lo, hi)], np.int64)

    alo, ahi, blo, bhi, err = nodes.T
    amid, bmid = split(alo, ahi), split(blo, bhi)
    own = alo == blo
    quads = [
        np.stack([alo, amid, blo, bmid, err], 1),
        np.stack([amid, ahi, bmid, bhi, err], 1),
        np.stack([alo, amid, bmid, bhi, err + 1], 1),
        np.stack([amid, ahi, blo, bmid, err + 1], 1)[~own],
    ]
    out = np.concatenate(quads)
    return out[(out[:, 0] < out[:, 1]) & (out[:, 2] < out[:, 3]) & (out[:, 4] <= most)]


def _compare(forest: _Forest, keys, group, side, nodes: np.ndarray, most: int) -> None:
    """Compare the entries of small node pairs bit by bit, and link those within the budget."""
    size = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
    for lo in range(0, len(nodes), 1024):
        part, n = nodes[lo : lo + 1024], size[lo : lo + 1024]
        run = np.zeros(len(n), np.int64)
        np.cumsum(n[:-1], out=run[1:])
        k = np.arange(int(n.sum())) - np.repeat(run, n)
        wide = np.repeat(part[:, 3] - part[:, 2], n)
        a = np.repeat(part[:, 0], n) + k // wide
        b = np.repeat(part[:, 2], n) + k % wide
        keep = (a < b) & ((side[a] == 0) | (side[a] != side[b]))
        a, b = a[keep], b[keep]
        near = _near(keys, a, b, most)
        forest.link(a[near], b[near])


def _join_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted entries (group, key, turn, side) to links between fingerprints; whole groups at a time."""
    names = ["group", "key", "turn", "side"]
    held: list[list[np.ndarray]] = []
    rows = 0

    def links(cols: list[np.ndarray]) -> pa.RecordBatch:
        group, key, turn, side = cols
        key = key.view(np.uint64)
        order = np.lexsort((key, group))
        group, key, turn, side = group[order], key[order], turn[order], side[order]
        least = trie_links(key, group, side)
        moved = np.flatnonzero(least != np.arange(len(least)))
        back = (turn * BLOCK).astype(np.uint64)
        own = np.where(back == 0, key, (key >> back) | (key << ((np.uint64(64) - back) % np.uint64(64))))
        return pa.RecordBatch.from_arrays([pa.array(own[moved].view(np.int64)), pa.array(own[least[moved]].view(np.int64))], ["a", "b"])

    for batch in batches:
        held.append([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names])
        rows += len(held[-1][0])
        if rows >= 20_000:
            cols = [np.concatenate(x) for x in zip(*held)]
            cut = int(np.searchsorted(cols[0], cols[0][-1], "left"))  # the last group may go on
            if cut:
                yield links([c[:cut] for c in cols])
            held, rows = [[c[cut:] for c in cols]], len(cols[0]) - cut
    if rows:
        yield links([np.concatenate(x) for x in zip(*held)])


def _with_sizes(entries: DataFrame, group: list[str], size: int) -> DataFrame:
    """The entries with the number n of those in their group, where it exceeds the size; else null.

    Large groups are few: at most one to so many entries.
    """
    counts = entries.groupBy(*[F.col(c).alias(f"{c}_") for c in group]).agg(F.count("*").alias("n")).where(F.col("n") > size)
    same = reduce(Column.__and__, [F.col(c) == F.col(f"{c}_") for c in group])
    return entries.join(counts, same, "left").drop(*[f"{c}_" for c in group])


def linked_fingerprints(distinct: DataFrame, size: int = GROUP) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all those within three bits.

    distinct: one column fingerprint without repeats.
    """
    ready(distinct.sparkSession)
    f = "fingerprint"
    turns = F.explode(F.array(*[F.struct(F.lit(t).alias("turn"), F.expr(
        f if t == 0 else f"shiftleft({f}, {t * BLOCK}) | shiftrightunsigned({f}, {64 - t * BLOCK})").alias("key"))
        for t in range(BLOCKS)]))
    entries = distinct.select(turns.alias("x")).select("x.*").withColumn("block", F.expr(f"shiftrightunsigned(key, {64 - BLOCK})"))
    # of a large group, entries within three bits also agree in one of four parts of the 48 bits below its block
    inner = (64 - BLOCK) // BLOCKS
    marked = _with_sizes(entries.select("turn", "key", "block"), ["turn", "block"], size)
    below = F.expr(f"CASE WHEN n IS NULL THEN array(named_struct('j', -1, 'sub', 0L)) ELSE transform(sequence(0, {BLOCKS - 1}), j ->"
                   f" named_struct('j', j, 'sub', shiftrightunsigned(key, {inner} * ({BLOCKS - 1} - j)) & {(1 << inner) - 1})) END")
    finer = marked.select("turn", "key", "block", F.explode(below).alias("x")).select("turn", "key", "block", "x.*")
    joined = _with_sizes(finer, ["turn", "block", "j", "sub"], size)
    parts = F.coalesce(F.ceil(2 * F.col("n") / size), F.lit(1)).cast("int")
    dealt = joined.select("turn", "key", "block", "j", "sub", parts.alias("parts"), F.pmod(F.xxhash64("key"), parts).cast("int").alias("part"))
    # part p meets every part q in the task (least, greatest); side tells which of the two an entry is of
    meets = F.expr("transform(sequence(0, parts - 1), q -> named_struct('low', least(part, q), 'high', greatest(part, q),"
                   " 'side', CASE WHEN q = part THEN 0 WHEN part < q THEN 1 ELSE 2 END))")
    spread = dealt.select("turn", "key", "block", "j", "sub", F.explode(meets).alias("m")).select(
        F.xxhash64("turn", "block", "j", "sub", "m.low", "m.high").alias("group"), "key", "turn", F.col("m.side").alias("side"))
    return spread.repartition("group").sortWithinPartitions("group").mapInArrow(_join_groups, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (doc_id, fingerprint, component_id) per document.

    fingerprint: 16 lowercase hex digits; component_id: least doc_id reachable by links.
    Null ids are kept as null and are the least of a component only if it has no other.
    """
    some = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = stored(fingerprints(some).select("doc_id", "fingerprint"), "fingerprints")
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    root = components(linked_fingerprints(distinct.select("fingerprint")))
    tied = distinct.join(root, F.col("fingerprint") == F.col("a"), "left").select(
        "fingerprint", "least", F.coalesce("b", "fingerprint").alias("root"))
    ids = tied.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = tied.join(ids, "root").select(F.col("fingerprint").alias("f"), "component_id")
    return prints.join(ids, F.col("fingerprint") == F.col("f")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, columns as they were: one of the least id, null last; ties by text hash, then place."""
    mark, place, kept = fresh(docs, "_print"), fresh(docs, "_place"), fresh(docs, "_kept")
    # numbered as it is written: a repeated task reads the same numbers again
    marked = stored(fingerprints(docs, text, mark).withColumn(place, F.monotonically_increasing_id()), "marked")
    rank = F.struct(F.col(f"`{doc_id}`").isNull().alias("none"), F.col(f"`{doc_id}`").alias("id"), F.xxhash64(f"`{text}`").alias("text"),
                    F.col(place).alias("place"))
    best = marked.groupBy(F.col(mark).alias("fingerprint")).agg(F.min(rank).alias("rank"))
    best = stored(best, "best")
    root = components(linked_fingerprints(best.select("fingerprint")))
    tied = best.join(root, F.col("fingerprint") == F.col("a"), "left").select(F.coalesce("b", "fingerprint").alias("root"), "rank")
    first = tied.groupBy("root").agg(F.min("rank").alias("rank")).select(F.col("rank.place").alias(kept))
    return marked.join(first, F.col(place) == F.col(kept), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
