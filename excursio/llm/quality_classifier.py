"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

A text is a sequence of tokens: runs of letters and digits, and runs of other signs. Its
features are the hashes of single tokens and of pairs of neighbours in a fixed number of
dimensions; a token equal to the one before adds a feature of its own. A score is the sparse
dot product of the mean feature vector with the weights, put through the logistic function.

Weights are learnt from a bounded sample of labelled rows: those of the least hashes of their ids.
The sample is dealt to shards; each shard makes one FTRL-Proximal pass over its rows from the
common state, and the states are averaged, for some rounds. A state has a fixed size.

Null texts are empty; an empty text has no features and scores the bias. Documents labelled
both ways or with null are not learnt from; without any labels all scores are one half.
Repeated rows are scored one by one. Other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from excursio.llm.shared import checkpointed, hash_words, in_parts, ready, splitmix, text_buffers

DIMENSIONS = 1 << 18
#: Labelled rows that are learnt from at most.
SAMPLE = 20_000
SHARDS = 4
ROUNDS = 8
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.001, 0.1
#: Factor on the mean feature vector.
SCALE = 60.0

#: Kinds of bytes: 0 white space, 1 letters, digits and all beyond ASCII, 2 other signs.
_KIND = np.full(256, 2, np.uint8)
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KIND[0x30:0x3A] = _KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:] = 1
_SAME = np.uint64(0x5A4D45)
_BIAS = DIMENSIONS


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every token, and the index of each text's first."""
    kind = _KIND[data]
    edge = np.ones(len(kind) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = kind[starts] != 0
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(starts, offsets)


def features(texts: pa.Array):
    """For parts of the texts (first text, last text, feature indexes, n + 1 offsets into them)."""
    data, offsets = text_buffers(texts)
    for lo, hi in in_parts(offsets):
        part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        starts, ends, first = _tokens(part, at)
        one = hash_words(part, starts, ends)
        two = splitmix(one[:-1] * np.uint64(3) + one[1:]) if len(one) else one
        same = one[:-1] == one[1:]
        two[same] = _SAME
        n = len(one)
        out = np.empty(2 * n, np.int64)
        mask = np.uint64(DIMENSIONS - 1)
        out[::2] = one & mask
        out[1:-1:2] = two & mask
        # the pair that ends a text would reach into the next one: the text's last token counts twice instead
        last = first[1:][np.diff(first) > 0] - 1
        out[2 * last + 1] = out[2 * last]
        yield lo, hi, out, 2 * first


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """FTRL-Proximal weights of a state whose last entry is the bias, which has no L1 term."""
    l1 = np.full(len(z), L1)
    l1[-1] = 0
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def trained(z: np.ndarray, n: np.ndarray, rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The state after one pass over rows of feature indexes and labels."""
    z, n = z.copy(), n.copy()
    for own, label in rows:
        index, count = np.unique(own, return_counts=True)
        index = np.append(index, _BIAS)
        x = np.append(count * (SCALE / max(len(own), 1)), 1.0)
        zi, ni = z[index], n[index]
        w = weights(zi, ni)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        n[index] = ni + g * g
        z[index] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
    return z, n


def fitted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
           may_learn: Column | None = None, sample: int = SAMPLE, rounds: int = ROUNDS) -> np.ndarray:
    """Weights learnt from the labelled rows; may_learn, over the labels' columns, holds some of them back."""
    spark = docs.sparkSession
    ready(spark)
    known = labels.where(may_learn) if may_learn is not None else labels
    known = known.groupBy(F.col(f"`{doc_id}`").alias("id")).agg(
        F.min(f"`{label}`").alias("label"), F.max(f"`{label}`").alias("other"), F.max(F.col(f"`{label}`").isNull()).alias("none"))
    known = known.where("id IS NOT NULL AND label = other AND NOT none").select("id", F.col("label").cast("int").alias("label"))
    # a bounded number of ids and labels: small enough for a broadcast
    part = min(1.0, 1.2 * sample / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) <= int(part * (1 << 30)))
    chosen = chosen.orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 30)), "id").limit(sample)
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(chosen), "id")

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for lo, hi, index, at in features(texts):
            out += [index[at[k] : at[k + 1]].astype(np.int32) for k in range(hi - lo)]
        return pa.array(out, pa.list_(pa.int32()))

    rows = rows.select("id", "label", arrow_udf(run, "array<int>")("text").alias("features"),
                       F.pmod(F.xxhash64("id"), F.lit(SHARDS)).cast("int").alias("shard"), F.xxhash64("text").alias("mark"))
    # dealt to shards once: every round finds a shard whole in one partition
    rows = checkpointed(rows.repartition(SHARDS, "shard"))
    used = rows.select("shard").distinct().count()
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    for _ in range(rounds):
        state = spark.sparkContext.broadcast((z, n))
        passed = rows.mapInArrow(_shard_pass(state), "index int, z double, n double")
        mixed = passed.groupBy("index").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow()
        if not len(mixed):
            break
        index = mixed["index"].to_numpy()
        # what a shard did not touch stays at the common state
        z, n = z.copy(), n.copy()
        z[index] += mixed["z"].to_numpy() / used
        n[index] += mixed["n"].to_numpy() / used
        state.unpersist()
    return weights(z, n)


def _shard_pass(state):
    """One pass over each shard of a partition, in an order that a repeated task finds again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = state.value
        held = list(batches)  # a shard is a bounded number of rows
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by([("shard", "ascending"), ("id", "ascending"), ("mark", "ascending")])
        shard, ids = table["shard"].to_numpy(), table["id"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.lexsort((splitmix(ids), shard))
        lists, labels = table["features"].combine_chunks(), table["label"].to_numpy()
        flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
        for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            new_z, new_n = trained(z, n, [(flat[at[k] : at[k + 1]], int(labels[k])) for k in own])
            moved = np.flatnonzero((new_z != z) | (new_n != n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(moved, pa.int32()), pa.array(new_z[moved] - z[moved]), pa.array(new_n[moved] - n[moved])], ["index", "z", "n"])

    return run


def scored(docs: DataFrame, learnt: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """The rows with their score from 0 to 1; it replaces a column of that name."""
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(learnt)

    def run(texts: pa.Array) -> pa.Array:
        w = shared.value
        total = np.full(len(texts), w[_BIAS])
        for lo, hi, index, at in features(texts):
            n = np.diff(at)
            some = np.flatnonzero(n)
            if len(some):
                total[lo + some] += np.add.reduceat(w[index], at[:-1][some]) * (SCALE / n[some])
        return pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))

    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()]
    return docs.select(*keep, arrow_udf(run, "double")(F.col(f"`{text}`")).alias(out))


def held_out(doc_id: Column) -> Column:
    """Whether a document is of the fold that is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
