"""Benchmark decontamination: documents against a broadcast hash set of benchmark word windows.

A window is 13 consecutive item words; an item of fewer words is one window. Documents are
scanned with rolling hashes of their own windows; every hash that is in the set is verified
word for word. The set goes to the executors as a broadcast of a checked size: a benchmark
beyond the bound is dealt into blocks by hash, and the documents are scanned once for each,
adding to what the blocks before found.

Null, empty or wordless texts have no words and no hits; null, empty or wordless items have no windows. Items of null id
hit like others and are in no list of items; repeated items count once by id. Texts of any length are scanned whole. An empty
table of documents gives no rows, an empty benchmark no hits. Rows and other columns stay as they are.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from excursio.llm.shared import fresh, hash_shingles, hash_words, in_parts, ready, text_buffers, word_spans

WINDOW = 13
#: Bytes of benchmark text whose windows are broadcast together; they take about ten times as much.
BLOCK_BYTES = 8 << 20

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Bytes of words after lower-casing: digits, letters and all beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


class Sized:
    """The distinct windows of one size: sorted hashes, a place in the text of each, and the items that hold it."""

    def __init__(self, hashes: np.ndarray, places: np.ndarray, of_place: np.ndarray, items: np.ndarray, bits: np.ndarray):
        self.hashes, self.places, self.of_place, self.items, self.bits = hashes, places, of_place, items, bits


class Windows:
    """The windows of a block of benchmark items: their text once, and arrays of some 40 bytes a window."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        data, offsets = text_buffers(pa.array([t for _, t in items], pa.string()))
        data = _lower(data)
        starts, ends, first = word_spans(data, offsets, _WORD)
        words = hash_words(data, starts, ends)
        at = np.int32 if len(data) < 1 << 31 else np.int64
        self.data, self.starts, self.ends = data.tobytes(), starts.astype(at), ends.astype(at)
        self.names = sorted({name for name, _ in items if name is not None})
        number = {name: k for k, name in enumerate(self.names)}
        own = np.array([number.get(name, -1) for name, _ in items], np.int64)
        n_words = np.diff(first)
        size_of = np.minimum(n_words, window)
        self.by_size = {}
        for size in sorted(set(size_of.tolist()) - {0}):
            # places of windows in the texts of items of that size
            some = np.flatnonzero(size_of == size)
            count = n_words[some] - size + 1
            item = np.repeat(some, count)
            place = np.repeat(first[some] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            self.by_size[size] = self._sized(hash_shingles(words, size)[place], place, own[item], size)

    def text(self, place: int, size: int) -> bytes:
        """The words of a window, a space between them."""
        return b" ".join([self.data[s:e] for s, e in zip(self.starts[place : place + size].tolist(), self.ends[place : place + size].tolist())])

    def _sized(self, hashes: np.ndarray, place: np.ndarray, item: np.ndarray, size: int) -> Sized:
        order = np.argsort(hashes, kind="stable")
        hashes, place, item = hashes[order], place[order], item[order]
        new = np.append(True, hashes[1:] != hashes[:-1])
        # windows of one hash are parted by their words, so that equal ones lie together
        for lo, hi in _runs(new):
            by_text = sorted(range(lo, hi), key=lambda k: self.text(place[k], size))
            place[lo:hi], item[lo:hi] = place[by_text], item[by_text]
            new[lo + 1 : hi] = [self.text(a, size) != self.text(b, size) for a, b in zip(place[lo : hi - 1], place[lo + 1 : hi])]
        group = np.cumsum(new) - 1
        named = item >= 0
        pairs = np.unique(group[named] * max(len(self.names), 1) + item[named])
        owner = pairs // max(len(self.names), 1)
        n = int(group[-1]) + 1
        width = 1 << max(20, (8 * n - 1).bit_length())
        bits = np.zeros(width, bool)
        bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = True
        return Sized(hashes[new], place[new].astype(self.starts.dtype), np.searchsorted(owner, np.arange(n + 1)).astype(np.int32),
                     (pairs % max(len(self.names), 1)).astype(np.int32), bits)

    def scan(self, texts: pa.Array) -> list[tuple[int, np.ndarray, set[str]]]:
        """For each text the number of words, the indexes of those hit, and the items found."""
        data, offsets = text_buffers(texts)
        out = []
        for lo, hi in in_parts(offsets):
            part = _lower(data[offsets[lo] : offsets[hi]])
            starts, ends, first = word_spans(part, offsets[lo : hi + 1] - offsets[lo], _WORD)
            words = hash_words(part, starts, ends)
            hit = np.zeros(len(starts), bool)
            items: dict[int, set[int]] = defaultdict(set)
            raw = None
            for size, by in self.by_size.items():
                hashes = hash_shingles(words, size)
                near = np.flatnonzero(by.bits[(hashes & np.uint64(len(by.bits) - 1)).astype(np.int64)])
                found = np.searchsorted(by.hashes, hashes[near])
                owner = np.searchsorted(first, near, "right") - 1
                same = (by.hashes[np.minimum(found, len(by.hashes) - 1)] == hashes[near]) & (near + size <= first[owner + 1])
                for i, k, at in zip(near[same].tolist(), owner[same].tolist(), found[same].tolist()):
                    if raw is None:
                        raw = part.tobytes()
                    text = b" ".join([raw[s:e] for s, e in zip(starts[i : i + size].tolist(), ends[i : i + size].tolist())])
                    while at < len(by.hashes) and by.hashes[at] == hashes[i]:
                        if self.text(by.places[at], size) == text:
                            hit[i : i + size] = True
                            items[k].update(by.items[by.of_place[at] : by.of_place[at + 1]].tolist())
                            break
                        at += 1
            for k in range(hi - lo):
                own = np.flatnonzero(hit[first[k] : first[k + 1]]) if k in items else _NONE
                out.append((int(first[k + 1] - first[k]), own, {self.names[x] for x in items.get(k, ())}))
        return out


def _runs(new: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of two and more entries between marks of new ones."""
    heads = np.append(np.flatnonzero(new), len(new))
    many = np.flatnonzero(np.diff(heads) > 1)
    return list(zip(heads[many].tolist(), heads[many + 1].tolist()))


_NONE = np.zeros(0, np.int64)


def _lower(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(_LOWER), np.uint8)


def _scanner(shared):
    """The scan of one block, which adds to what the blocks before found."""
    def run(texts: pa.Array, before: pa.Array) -> pa.Array:
        n_words, words, items = [], [], []
        for (n, own, ids), old in zip(shared.value.scan(texts), before.to_pylist()):
            if old is not None:
                own = np.union1d(own, np.array(old["words"], np.int64))
                ids = ids | set(old["items"])
            n_words.append(n)
            words.append(own.tolist())
            items.append(sorted(ids))
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(words, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
            ["n_words", "words", "items"])

    return run


def scanned(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
            out: str = "hits", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows with a struct column (n_words, words, items): hit word indexes and found item ids as text, both sorted."""
    spark = docs.sparkSession
    ready(spark)
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{item_text}`").alias("text"))
    items = items.where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    temp = fresh(docs, "_hits")
    df = docs.withColumn(temp, F.lit(None).cast("struct<n_words bigint, words array<int>, items array<string>>"))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text", "id"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast(Windows([(r.id, r.text) for r in rows], window))

        udf = arrow_udf(_scanner(shared), "n_words bigint, words array<int>, items array<string>")
        df = df.withColumn(temp, udf(F.col(f"`{text}`"), F.col(temp)))
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()]
    return df.select(*keep, F.col(temp).alias(out))


def is_contaminated(hits: str = "hits"):
    """Whether at least one word and at least one in twenty are hit."""
    return F.expr(f"size({hits}.words) > 0 AND 20L * size({hits}.words) >= {hits}.n_words")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", spans: bool = False, **options) -> DataFrame:
    """The rows that are not contaminated; with spans, all rows and the hit words cut out of their texts instead."""
    out = fresh(docs, "hits")
    df = scanned(docs, benchmark, text=text, out=out, **options)
    if not spans:
        return df.where(~is_contaminated(out)).select(*[F.col(f"`{c}`") for c in docs.columns])

    def cut(texts: pa.Array, words: pa.Array) -> pa.Array:
        rows = []
        for value, hit in zip(texts.to_pylist(), words.to_pylist()):
            if hit:
                every = set(hit)
                data = np.frombuffer(value.encode(), np.uint8)
                starts, ends, _ = word_spans(_lower(data), np.array([0, len(data)]), _WORD)
                gone = np.zeros(len(data) + 1, np.int32)
                for k in hit:
                    # up to the next word where that is hit too, so that what parts them goes along
                    upto = starts[k + 1] if k + 1 < len(starts) and k + 1 in every else ends[k]
                    gone[starts[k]] += 1
                    gone[upto] -= 1
                value = data[np.cumsum(gone[:-1]) == 0].tobytes().decode()
            rows.append(value)
        return pa.array(rows, pa.string())

    new = arrow_udf(cut, "string")(F.col(f"`{text}`"), F.col(f"{out}.words")).alias(text)
    return df.select(*[new if c == text else F.col(f"`{c}`") for c in docs.columns])
