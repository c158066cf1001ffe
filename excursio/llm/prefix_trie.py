"""Trie of conversation prefixes, with sums over subtrees by centroid decomposition.

Turns of a conversation are ordered by turn, null first, and turns of equal number by the hash
of role and text. Every conversation is rebuilt on the first turns of another (`rebuilt`); each
distinct sequence of first turns is a node. A node's id is a 128-bit hash of its depth and of sums
over hashes of (role, text, position): sums can be worked out in parts, so no task needs a
conversation whole. Rows of a conversation are numbered in ranges of a sorted table, with the
rows before each range added, so a conversation may hold any share of all rows.

`rolled` adds up values over the subtrees of a parent-edge forest. The forest is dealt into
fragments of a bounded number of nodes, along an order that keeps subtrees together. In a
fragment, components are split at their centroids again and again: removing one leaves
components of at most half the nodes. From the last split back to the first, a centroid gets its
value and the totals of the components below it, and adds that to the nodes on the path up to the
top of its component; every node is on such paths of at most log2(n) components. Nodes whose
children lie in other fragments form a forest of their own, each weighing what hangs on it
outside; it is smaller, as it has none of the leaves, and is rolled up the same way before the
fragments are. Stars and chains of any length are no special cases.

Null role or text counts as empty. Rows without conversation id are left out. Repeated rows are
turns of their own. Texts are hashed where they are read, so their length does not matter. An
empty table has no nodes, not even a root. Columns are given by name; others are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from excursio.llm.shared import ready, stored
from excursio.operators.linkage import join_children

#: Nodes of a fragment, about.
FRAGMENT = 1 << 14
#: A conversation's first turns come from the conversation with the next lower multiple of this id.
FAMILY = 5
#: The number of those turns is below this.
HEAD = 9
#: Steps of a conversation that one window adds up; steps that the sort key of a node holds.
CHUNK, BAND = 1024, 8
_EMPTY = hashlib.sha256(b"").hexdigest()


# ---- subtree sums of a forest ----------------------------------------------------------------


def centroids(parent: Sequence[int]) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """Children of every node, and the (centroid, top) of all components in the order of splitting.

    parent: number of each node's parent, -1 for a root; the tops of components are the nodes
    nearest to the root.
    """
    children: list[list[int]] = [[] for _ in parent]
    order = []
    for v, p in enumerate(parent):
        if p < 0:
            order.append(v)
        else:
            children[p].append(v)
    open_tops = order[:]
    for v in order:  # grows while it is read: parents before children
        order.extend(children[v])
    if len(order) < len(parent):
        raise ValueError("parents must not lead in a circle")
    size = [1] * len(parent)
    for v in reversed(order):
        if parent[v] >= 0:
            size[parent[v]] += size[v]
    there, splits = [True] * len(parent), []
    while open_tops:
        top = open_tops.pop()
        c, half = top, size[top] / 2
        while (heavy := next((x for x in children[c] if there[x] and size[x] > half), None)) is not None:
            c = heavy
        there[c] = False
        splits.append((c, top))
        open_tops += [x for x in children[c] if there[x]]
        if c != top:
            p, gone = c, size[c]
            while p != top:
                p = parent[p]
                size[p] -= gone
            open_tops.append(top)
    return children, splits


def subtree_sums(parent: Sequence[int], values: list[list[int]]) -> None:
    """Turns every list of values into sums over subtrees."""
    children, splits = centroids(parent)
    turn = [0] * len(parent)
    for k, (c, _) in enumerate(splits):
        turn[c] = k
    for k in range(len(splits) - 1, -1, -1):
        c, top = splits[k]
        below = [x for x in children[c] if turn[x] > k]
        path, p = [], c
        while p != top:
            p = parent[p]
            path.append(p)
        for v in values:
            v[c] = total = v[c] + sum([v[x] for x in below])
            for p in path:
                v[p] += total


def _local(rows: pd.DataFrame) -> list[int]:
    """Number of each row's parent within a fragment, -1 if it is elsewhere."""
    at = {bytes(v): k for k, v in enumerate(rows["node"])}
    return [at.get(bytes(p), -1) if p is not None else -1 for p in rows["parent"]]


def _tops(parent: Sequence[int]) -> list[int]:
    """The root of each node's tree within the fragment."""
    top = [-1] * len(parent)
    for v in range(len(parent)):
        path = []
        while top[v] < 0 and parent[v] >= 0:
            path.append(v)
            v = parent[v]
        found = top[v] if top[v] >= 0 else v
        top[v] = found
        for x in path:
            top[x] = found
    return top


def rolled(forest: DataFrame, values: Sequence[str], order: Sequence[str], fragment: int = FRAGMENT) -> DataFrame:
    """Rows (node, *values): every node's values summed over its subtree.

    forest: unique node (binary), parent (binary; null, or one that is no node, for a root), the
    values (long) and the columns of an order, best that of a first visit. Any order gives the
    right sums, but one that scatters subtrees leaves more edges between fragments and so takes
    more rounds.
    """
    forest = stored(forest.select("node", "parent", *values, *order), "forest")
    n_parts = max(1, -(-forest.count() // fragment))
    sums = ", ".join(f"{v} long" for v in values)
    if n_parts > 1:
        forest = forest.repartitionByRange(n_parts, *order, "node")
    dealt = stored(forest.withColumn("part", F.spark_partition_id() if n_parts > 1 else F.lit(0)), "fragments")

    def finish(rows: pd.DataFrame, more: pd.DataFrame) -> pd.DataFrame:
        """Sums of a fragment's nodes; more: what hangs on its nodes in other fragments."""
        own = [rows[v].tolist() for v in values]
        at = {bytes(v): k for k, v in enumerate(rows["node"])}
        for column, name in zip(own, values):
            for node, add in zip(more["node"], more[name]):
                column[at[bytes(node)]] += int(add)
        subtree_sums(_local(rows), own)
        return pd.DataFrame({"node": rows["node"], **dict(zip(values, own))})

    if n_parts == 1:
        empty = dealt.select("node", *values, "part").limit(0)
        return dealt.groupBy("part").cogroup(empty.groupBy("part")).applyInPandas(finish, f"node binary, {sums}")

    def outwards(rows: pd.DataFrame) -> pd.DataFrame:
        """Totals of a fragment's trees whose roots have a parent."""
        own, parent = [rows[v].tolist() for v in values], _local(rows)
        subtree_sums(parent, own)
        roots = [k for k, p in enumerate(parent) if p < 0 and rows["parent"].iat[k] is not None]
        return pd.DataFrame({"node": rows["parent"].iloc[roots], **{v: [x[k] for k in roots] for v, x in zip(values, own)}})

    def upwards(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        """The node outside that each of the nodes held reaches first."""
        top, at = _tops(_local(rows)), {bytes(v): k for k, v in enumerate(rows["node"])}
        return pd.DataFrame({"node": held["node"], "parent": [rows["parent"].iat[top[at[bytes(v)]]] for v in held["node"]]})

    # the nodes with children elsewhere, what hangs on them there, and the next such node above them
    outer = dealt.groupBy("part").applyInPandas(outwards, f"node binary, {sums}").groupBy("node").agg(*[F.sum(v).alias(v) for v in values])
    held = stored(outer.join(dealt.select("node", "part", *order), "node"), "held")
    above = dealt.groupBy("part").cogroup(held.select("node", "part").groupBy("part")).applyInPandas(upwards, "node binary, parent binary")
    more = rolled(held.drop("part").join(above, "node"), values, order, fragment)
    more = stored(more.join(held.select("node", "part"), "node"), "hanging")
    return dealt.groupBy("part").cogroup(more.groupBy("part")).applyInPandas(finish, f"node binary, {sums}")


# ---- conversations ----------------------------------------------------------------------------


def numbered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns as rows (conv, part, pos, x, y, bytes), and per conversation and part the rows before it and in all.

    x and y hash role and text; parts are ranges of the sorted table.
    """
    words = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    rows = turns.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.xxhash64(*words).alias("x"),
        F.xxhash64(F.lit(1), *reversed(words)).alias("y"), F.octet_length(words[1]).cast("long").alias("bytes"))
    # rows that are equal in all are dealt out by their place in the input; any order of them is the same
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    keys = [F.col("turn").asc_nulls_first(), F.col("x"), F.col("y"), F.col("tie")]
    rows = stored(rows.repartitionByRange(F.col("conv"), *keys).withColumn("part", F.spark_partition_id()), "turns")
    counts = rows.groupBy("conv", "part").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("conv")
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = stored(counts.select("conv", "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(whole).alias("length")), "spans")
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("conv", "part").orderBy(*keys)))
    return rows, spans


def rebuilt(turns: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Steps (conv, d, x, y, bytes, last) of the rebuilt conversations, and those (conv, length) themselves.

    The first h turns come from the conversation with the next lower multiple of FAMILY, the rest
    are those of the conversation's own after its first h; h depends on the id alone.
    """
    convs = spans.where("before = 0").select("conv", "length", (F.col("conv") - F.col("conv") % FAMILY).alias("base"),
                                             (F.crc32(F.col("conv").cast("string")) % HEAD).alias("h"))
    bases = convs.where("conv = base").select(F.col("conv").alias("base"), F.col("length").alias("there"))
    head = F.least(F.col("h"), F.coalesce("there", F.lit(0)))
    convs = convs.join(bases, "base", "left").select("conv", "base", "h", head.alias("head"),
                                                     (head + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("length"))
    convs = stored(convs, "conversations")
    where = spans.select("conv", "part", "before").join(convs.select("conv", "h", "head", "length"), "conv")
    own = turns.join(where, ["conv", "part"]).withColumn("pos", F.col("before") + F.col("rank"))
    first = own.where((F.col("pos") < HEAD) & (F.col("conv") % FAMILY == 0)).select(F.col("conv").alias("base"), F.col("pos").alias("d"), "x", "y", "bytes")
    heads = convs.where("head > 0").join(first, "base").where("d <= head").select("conv", "d", "x", "y", "bytes", "length")
    rest = own.where("pos > h").select("conv", (F.col("head") + F.col("pos") - F.col("h")).alias("d"), "x", "y", "bytes", "length")
    steps = heads.unionByName(rest).withColumn("last", F.col("d") == F.col("length")).drop("length")
    return steps, convs.select("conv", "length")


_SUMS = ("s0", "s1", "s2", "s3")
_KEYS = ("k0", "k1", "k2", "k3")


def _node_id(depth, sums: Sequence):
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums]).cast("binary")))


def _root():
    return _node_id(F.lit(0), [F.lit(0)] * 4)


def prefixes(steps: DataFrame) -> DataFrame:
    """The steps with node, parent and a sort key of the node: the node at the last multiple of BAND and the steps since."""
    low = F.lit(0xFFFFFFFF).cast("long")
    mixed = [F.xxhash64("x", "y", "d"), F.xxhash64(F.lit(2), "y", "x", "d")]
    halves = [f for m in mixed for f in (F.shiftrightunsigned(m, 32), m.bitwiseAND(low))]
    slot = (F.col("d") - 1) % BAND
    sign = F.shiftrightunsigned(F.xxhash64("x", "y"), 33)
    rows = steps.withColumns({**dict(zip(_SUMS, halves)), "chunk": F.floor((F.col("d") - 1) / CHUNK), "band": F.floor((F.col("d") - 1) / BAND)})
    rows = rows.withColumns({k: F.when(slot == 2 * j, F.shiftleft(sign, 32)).when(slot == 2 * j + 1, sign).otherwise(F.lit(0).cast("long"))
                             for j, k in enumerate(_KEYS)})
    # sums of the chunks before: none for conversations of a single chunk
    chunks = rows.groupBy("conv", "chunk").agg(*[F.sum(s).alias(s) for s in _SUMS])
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("conv", "chunk", *[F.sum(s).over(earlier).alias(f"{s}_") for s in _SUMS]).where("chunk > 0")
    along = Window.partitionBy("conv", "chunk").orderBy("band", "d").rowsBetween(Window.unboundedPreceding, 0)
    in_band = Window.partitionBy("conv", "chunk", "band").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"{s}_all": F.sum(s).over(along) for s in _SUMS} | {f"{k}_all": F.sum(k).over(in_band) for k in _KEYS})
    rows = rows.join(chunks, ["conv", "chunk"], "left")
    upto = [F.col(f"{s}_all") + F.coalesce(f"{s}_", F.lit(0)) for s in _SUMS]
    above = _node_id(F.col("d") - 1, [u - F.col(s) for u, s in zip(upto, _SUMS)])
    rows = rows.withColumns({"node": _node_id(F.col("d"), upto), "parent": above})
    rows = rows.withColumn("top", F.first("parent").over(in_band))
    return rows.select("conv", "d", "bytes", "last", "node", "parent", "top", *[F.col(f"{k}_all").alias(k) for k in _KEYS])


def digests(members: DataFrame) -> DataFrame:
    """Rows (node, ends_sha256) of (node, conv): the digest of the ids in numeric order, joined by commas.

    Ids stream through a task in sorted order, so a node may have any number of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for batch in batches:
            nodes, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            k = 0
            while k < len(nodes):
                end = k + 1
                while end < len(nodes) and nodes[end] == nodes[k]:
                    end += 1
                text = ",".join(map(str, ids[k:end])).encode()
                if nodes[k] == now:
                    state.update(b"," + text)
                else:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state = nodes[k], hashlib.sha256(text)
                k = end
            if len(done) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["node", "ends_sha256"])
                done = []
        if now is not None:
            done.append((now, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["node", "ends_sha256"])

    return members.repartition("node").sortWithinPartitions("node", "conv").mapInArrow(run, "node binary, ends_sha256 string")


def trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
         fragment: int = FRAGMENT) -> DataFrame:
    """One row per node: node and parent (ids; null above the root), conv_id and parent_conv_id (smallest members), depth,
    n_convs, n_children, n_leaves, saved_tokens (bytes that repeat: over the subtree, the bytes of the last text for each
    member but one) and ends_sha256 (of the conversations that end there)."""
    ready(conversations.sparkSession)
    steps, convs = rebuilt(*numbered(conversations, conv, turn, role, text))
    steps = stored(prefixes(steps), "steps")
    same = ["node", "parent", "d", "bytes", "top", *_KEYS]
    nodes = steps.groupBy(*same).agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        _root().alias("node"), F.lit(None).cast("binary").alias("parent"), zero.alias("d"), zero.alias("bytes"), F.lit(b"").alias("top"),
        *[zero.alias(k) for k in _KEYS], "conv", "n_convs")
    nodes = nodes.unionByName(root)
    kids = nodes.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids.withColumnRenamed("parent", "node"), "node", "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = stored(nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")}), "nodes")

    sums = rolled(nodes, ["n_leaves", "saved_tokens"], ["top", *_KEYS], fragment)
    parents = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    below = nodes.where("parent IS NOT NULL").select("node", "parent")
    above = join_children(parents, below, ["parent"], F.col("node")).select("node", "parent_conv_id")
    ends = digests(steps.where("last").select("node", "conv").unionByName(convs.where("length = 0").select(_root().alias("node"), "conv")))
    return (nodes.drop("n_leaves", "saved_tokens").join(sums, "node").join(above, "node", "left").join(ends, "node", "left")
            .select("node", "parent", F.col("conv").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children",
                    "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256")))
