"""Cross-entropy difference: how much likelier a text's words are under a target than under the whole corpus.

Two bigram models over one shared vocabulary of words, by their 64-bit hashes: the target model counts the
target's documents, the background model counts all documents. Both interpolate bigrams with
add-one unigrams, whose masses sum to one over the same words, with the same weights, so that the loss of each word
can be compared. A document's score is the mean over its words of target loss minus
background loss; low scores are like the target.

Counts are exact and cover every word of every document: those of words first, then those of pairs of words. A
task adds up its own; their numbers, sorted, go as packed arrays to the slice of numbers they fall into, and each
slice's counts are kept as one row. Pairs of frequent words have short numbers without collisions, all others the
hash of both words. To score, texts are dealt into groups by their hash, a group asks each slice for the counts of
the words and pairs it has, and the answers meet its texts again. Slices and groups hold so many bytes of text, so
there are more of them in larger corpora, and a frequent word or pair is one number in each array.

Null and wordless texts have no words, zero losses and score zero. Without any target all
documents get the losses of the empty model. Repeated rows count and are scored each. Other columns
stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from excursio.llm.shared import SPACE_SEPARATED, fresh, hash_words, in_parts, ready, splitmix, stored, text_buffers, word_spans

#: Bytes of the corpus's text whose counts make a slice, and bytes of text that are scored together.
SLICE, GROUP = 16 << 20, 8 << 20
#: Words that a task holds before it sends their counts.
HELD = 3 << 18
#: Words that are more than this part of all are frequent.
FREQUENT = 500_000
#: Keys of texts that a task remembers, so as to send copies once.
SEEN = 1 << 18
#: Ids of target documents that are broadcast at most.
TARGETS = 1_000_000
#: Share of the bigram estimate.
MIX = 0.6

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def buckets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For parts of the texts (first text, last text, word hashes, hashes of the pairs that end in each word, offsets)."""
    data, offsets = text_buffers(texts)
    for lo, hi in in_parts(offsets):
        raw = np.frombuffer(data[offsets[lo] : offsets[hi]].tobytes().translate(_LOWER), np.uint8)
        starts, ends, first = word_spans(raw, offsets[lo : hi + 1] - offsets[lo], SPACE_SEPARATED)
        words = hash_words(raw, starts, ends)
        before = np.zeros(len(words), np.uint64)
        before[1:] = words[:-1]
        before[first[:-1][np.diff(first) > 0]] = 0  # a text's first word follows its start
        pairs = splitmix(before * np.uint64(3) + words)
        yield lo, hi, words, pairs, first


_ZSTD = pa.Codec("zstd", compression_level=1)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, their first bytes together, which are mostly zero."""
    return len(values).to_bytes(8, "little") + _ZSTD.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(_ZSTD.decompress(packed[8:], 8 * size), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(packed), dtype=np.uint64)


def _all(column: pa.ChunkedArray, unpacked) -> np.ndarray:
    """The numbers of all rows."""
    return np.concatenate([np.zeros(0, np.uint64), *(unpacked(x.as_py()) for x in column)])


def _sliced(keys: np.ndarray, slices: int) -> Iterator[tuple[int, slice]]:
    """The slices that sorted keys fall into, and their places."""
    own = (keys >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)
    at = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
    for lo, hi in zip(at, np.append(at[1:], len(own))):
        yield int(own[lo]), slice(lo, hi)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(f"`{text}`"))).first()[0] or 0


def pair_keys(words: np.ndarray, pairs: np.ndarray, first: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the pair that ends in each word, and whether it is one of frequent words (or of a text's start and one)."""
    size = len(frequent)
    at = np.minimum(np.searchsorted(frequent, words), max(size - 1, 0))
    own = np.where(frequent[at] == words, at, size + 1) if size else np.full(len(words), 1)
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[first[:-1][np.diff(first) > 0]] = size
    bits = int(size).bit_length()
    short = (before <= size) & (own < size)
    # times an odd number, numbers of so many bits are spread over all of them one to one
    code = (before.astype(np.uint64) << np.uint64(bits) | own.astype(np.uint64)) * np.uint64(_ODD)
    return np.where(short, code << np.uint64(64 - 2 * bits) if bits else code, pairs), short


_ODD = 0x9E3779B97F4A7C15
_COUNTS = "slice int, keys binary, target binary, total binary"
#: Kinds of slices, in this order: words, pairs of frequent words, all other pairs.
_WORDS, _SHORT, _LONG = range(3)


def counts(docs: DataFrame, is_target: Column, slices: int, text: str = "text", frequent: np.ndarray | None = None) -> DataFrame:
    """Rows (slice, keys, target, total, n, n0, n1): sorted keys, their counts, how many keys, and sums of the counts.

    Words are counted, in the first slices, and texts in slice -1; with an array of the frequent words, sorted,
    pairs are counted instead.
    """
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def sent(kind: int, held: list) -> Iterator[pa.RecordBatch]:
        keys, own = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        held.clear()
        found, total = np.unique(keys, return_counts=True)
        some, n = np.unique(keys[own], return_counts=True)
        target = np.zeros(len(found), np.int64)
        target[np.searchsorted(found, some)] = n
        yield from batch([(kind * slices + k, _packed_keys(found[at]), _packed(target[at]), _packed(total[at])) for k, at in _sliced(found, slices)])

    def batch(rows: list) -> Iterator[pa.RecordBatch]:
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 3))], ["slice", "keys", "target", "total"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        held, size, texts = ([], [], []), 0, np.zeros((2, 1), np.int64)
        for rows in batches:
            chosen = rows.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi, words, pairs, first in buckets(rows.column(0)):
                own = np.repeat(chosen[lo:hi], np.diff(first))
                texts += [[chosen[lo:hi].sum()], [hi - lo]]
                if frequent is None:
                    held[_WORDS].append((words, own))
                else:
                    keys, short = pair_keys(words, pairs, first, frequent)
                    held[_SHORT].append((keys[short], own[short]))
                    held[_LONG].append((keys[~short], own[~short]))
                size += len(words)
                if size >= HELD:
                    for kind, some in enumerate(held):
                        if some:
                            yield from sent(kind, some)
                    size = 0
        for kind, some in enumerate(held):
            if some:
                yield from sent(kind, some)
        if frequent is None:
            yield from batch([(-1, _packed(np.zeros(1)), *map(_packed, texts))])

    def added(parts: pa.Table) -> pa.Table:
        keys, target, total = (_all(parts[c], f) for c, f in (("keys", _unpacked_keys), ("target", _unpacked), ("total", _unpacked)))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        target, total = np.add.reduceat(target[order], first), np.add.reduceat(total[order], first)
        return pa.table({
            "slice": parts["slice"][:1], "keys": [_packed_keys(keys[first])], "target": [_packed(target)], "total": [_packed(total)],
            "n": [len(first)], "n0": [int(target.sum())], "n1": [int(total.sum())]})

    rows = docs.select(F.col(f"`{text}`").alias("text"), F.coalesce(is_target, F.lit(False)).alias("chosen"))
    return rows.mapInArrow(run, _COUNTS).groupBy("slice").applyInArrow(added, _COUNTS + ", n bigint, n0 bigint, n1 bigint")


def marked(docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = TARGETS) -> DataFrame:
    """Rows (text, target): whether a document's id is among the targets.

    targets: one column id. Up to so many ids are broadcast, which leaves the texts where they are;
    more are joined by a shuffle.
    """
    ids = targets.where("id IS NOT NULL").select("id").distinct().withColumn("target", F.lit(True))
    if ids.count() <= most:
        ids = F.broadcast(ids)
    own = docs.select(F.col(f"`{doc_id}`").alias("own"), F.col(f"`{text}`").alias("text"))
    joined = own.join(ids, F.col("own") == F.col("id"), "left")
    return joined.select("text", F.coalesce("target", F.lit(False)).alias("target"))


class Models:
    """Both models: counts of words and of pairs of words."""

    def __init__(self, docs: DataFrame, is_target: Column, text: str):
        #: Slices of each kind.
        self.slices = text_bytes(docs, text) // SLICE + 1
        words = stored(counts(docs, is_target, self.slices, text), "words", compression="zstd")
        sums = [F.coalesce(F.sum(F.when(some, F.col(c))), F.lit(0)) for some, names in (
            (F.col("slice") >= 0, ("n0", "n1", "n")), (F.col("slice") < 0, ("n0", "n1"))) for c in names]
        *self.sums, distinct, n0, n1 = words.agg(*sums).first()
        #: Texts of each model.
        self.starts = [n0, n1]
        #: The vocabulary that both share: all words of the corpus, and one for those it lacks.
        self.vocabulary = distinct + 1
        #: Rows (word, n0, n1): how often each model has a word.
        self.words = self._each(words.where("slice >= 0"), "word")
        top = self.words.where(F.col("n1") > self.sums[1] // FREQUENT).select("word").toArrow()
        self.frequent = np.sort(top["word"].to_numpy().view(np.uint64))
        pairs = stored(counts(docs, is_target, self.slices, text, self.frequent), "pairs", compression="zstd")
        #: Rows (pair, n0, n1): how often each model has a pair, from which its losses are worked out.
        self.losses = self._each(pairs, "pair")
        self.counted = words.where("slice >= 0").unionByName(pairs)

    @staticmethod
    def _each(rows: DataFrame, name: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for keys, target, total in zip(*batch.columns):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (
                        _unpacked_keys(keys.as_py()), _unpacked(target.as_py()), _unpacked(total.as_py()))], [name, "n0", "n1"])

        return rows.select("keys", "target", "total").mapInArrow(run, f"{name} bigint, n0 bigint, n1 bigint")


def fitted(docs: DataFrame, is_target: Column, text: str = "text") -> Models:
    """The models of a corpus."""
    return Models(docs, is_target, text)


def scored(docs: DataFrame, models: Models, text: str = "text", out: str = "lm") -> DataFrame:
    """The rows with a struct column (n_words, target_loss, background_loss, score), losses as means over the words."""
    ready(docs.sparkSession)
    slices, starts = models.slices, models.starts
    totals = [x + models.vocabulary for x in models.sums]
    shared = docs.sparkSession.sparkContext.broadcast(models.frequent)
    size = text_bytes(docs, text)
    groups, deals = size // GROUP + 1, size // (slices * SLICE) + 1

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            new = []
            for k, key in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                if key not in seen:
                    seen.add(key)
                    new.append(k)
            if len(seen) > SEEN:
                seen.clear()
            yield batch.take(pa.array(new, pa.int64()))

    def parts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, list[np.ndarray], np.ndarray]]:
        """For parts of the texts (first text, last text, where words follow frequent ones, keys of each kind, offsets)."""
        for lo, hi, words, pairs, first in buckets(texts):
            keys, short = pair_keys(words, pairs, first, shared.value)
            yield lo, hi, short, [words, keys[short], keys[~short]], first

    def wanted(texts: pa.Array) -> list[np.ndarray]:
        """Keys of each kind, sorted."""
        found = [[np.zeros(0, np.uint64)] for _ in range(3)]
        for *_, keys, _ in parts(texts):
            for some, k in zip(found, keys):
                some.append(np.unique(k))
        return [np.unique(np.concatenate(some)) for some in found]

    def asked(rows: pa.Table) -> pa.Table:
        group = rows["part"][0].as_py()
        asks = [(kind * slices + k, group % deals, group, _packed_keys(keys[at]))
                for kind, keys in enumerate(wanted(rows["text"].combine_chunks())) for k, at in _sliced(keys, slices)]
        types = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
        return pa.table([pa.array([a[c] for a in asks], t) for c, t in enumerate(types)], ["slice", "deal", "part", "keys"])

    def answered(asks: pa.Table, have: pa.Table) -> pa.Table:
        keys, *counted = (_all(have[c], f) for c, f in (("keys", _unpacked_keys), ("target", _unpacked), ("total", _unpacked)))
        found = [[], []]
        for ask in asks["keys"]:
            want = _unpacked_keys(ask.as_py())
            at = np.minimum(np.searchsorted(keys, want), max(len(keys) - 1, 0))
            hit = keys[at] == want if len(keys) else np.zeros(len(want), bool)
            for answers, n in zip(found, counted):
                answers.append(_packed(np.where(hit, n[at], 0) if len(keys) else np.zeros(len(want))))
        return pa.table([asks["part"], asks["slice"], *(pa.array(x, pa.binary()) for x in found)], ["part", "slice", "target", "total"])

    def summed(rows: pa.Table, answers: pa.Table) -> pa.Table:
        keys = list(zip(rows["k0"].to_pylist(), rows["k1"].to_pylist()))
        rows = rows.take(pa.array(sorted({key: k for k, key in enumerate(keys)}.values()), pa.int64()))
        texts = rows["text"].combine_chunks()
        known = wanted(texts)
        at = np.cumsum([0, *map(len, known)])
        answers = answers.sort_by("slice")  # kind by kind
        counted = [_all(answers[c], _unpacked).astype(np.float64) for c in ("target", "total")]
        n, sums = np.zeros(len(rows), np.int64), [np.zeros(len(rows)) for _ in counted]
        for lo, hi, short, keys, first in parts(texts):
            word, *two = (at[kind] + np.searchsorted(known[kind], k) for kind, k in enumerate(keys))
            pair = np.empty_like(word)
            pair[short], pair[~short] = two
            n[lo:hi] = np.diff(first)
            own, begins = np.repeat(np.arange(hi - lo), n[lo:hi]), first[:-1][n[lo:hi] > 0]
            for m, each in enumerate(counted):
                before = np.append(0.0, each[word[:-1]])[: len(word)]
                before[begins] = starts[m]
                share = np.divide(each[pair], before, out=np.zeros(len(pair)), where=before > 0)
                loss = -np.log(MIX * share + (1 - MIX) * (each[word] + 1) / totals[m])
                sums[m][lo:hi] = np.bincount(own, loss, hi - lo)
        return pa.table([rows["k0"], rows["k1"], pa.array(n), *map(pa.array, sums)], ["k0", "k1", "n", "l0", "l1"])

    some = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = (F.xxhash64(some), F.xxhash64(F.lit("again"), some))
    rows = docs.select(F.pmod(key[0], F.lit(groups)).alias("part"), key[0].alias("k0"), key[1].alias("k1"), some.alias("text"))
    rows = rows.mapInArrow(once, "part bigint, k0 bigint, k1 bigint, text string").repartition("part")
    asks = rows.groupBy("part").applyInArrow(asked, "slice int, deal bigint, part bigint, keys binary")
    # texts many times the corpus are answered by copies of its slices
    have = models.counted.select("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))).alias("deal"), "keys", "target", "total")
    answers = asks.groupBy("slice", "deal").cogroup(have.groupBy("slice", "deal")).applyInArrow(
        answered, "part bigint, slice int, target binary, total binary")
    means = rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        summed, "k0 bigint, k1 bigint, n bigint, l0 double, l1 double").select("k0", "k1", F.struct(
            F.col("n").alias("n_words"),
            *[F.when(F.col("n") > 0, F.col(c) / F.col("n")).otherwise(0.0).alias(name) for c, name in (("l0", "target_loss"), ("l1", "background_loss"))],
            F.when(F.col("n") > 0, (F.col("l0") / F.col("n") - F.col("l1") / F.col("n"))).otherwise(0.0).alias("score")).alias("_lm"))
    keep = [c for c in docs.columns if c.lower() != out.lower()]
    names = fresh(docs, "_k0"), fresh(docs, "_k1")
    left = docs.select(*[F.col(f"`{c}`") for c in keep], key[0].alias(names[0]), key[1].alias(names[1]))
    done = left.join(means.select(F.col("k0").alias(names[0]), F.col("k1").alias(names[1]), F.col("_lm").alias(out)), list(names), "left")
    return done.select(*[F.col(f"`{c}`") for c in keep], F.col(out))
