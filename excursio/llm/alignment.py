"""Alignment of two tokenizers' tokens, with corpus-wide counts of the id pairs that end together.

A text is read with a space before it, by a byte-level BPE (A) and a sentencepiece BPE (B). Byte
offsets where tokens of both end cut the tokens into groups; the two tokens that end there
are a link. A pair's count is the number of links of all texts that hold it.

First pass: texts are aligned once; their groups and links are written to the shared folder, with
the rows. A task's links are added up by pair. The distinct pairs are
dealt by hash to shards; each shard gets a minimal perfect hash (levels of bits: a key lives
in the first level where no other key meets it, and its number is the rank of its bit). Counts
are dense vectors indexed by that hash, made from slices of the first pass and summed as a
tree. The key at each index is kept, so that a look-up is verified. Second pass: every link of the
written rows looks up its count. The vectors are broadcast up to HELD pairs
(16 bytes each); beyond, rows are dealt into parts, and each part gets the counts of its own
pairs by a join. Both ways give the same result.

No token of either tokenizer crosses a single space between two characters that are no white
space, so texts are cut there, and every distinct piece is encoded and aligned once as long as
a worker remembers it (bounded). The loader refuses models for which this does not hold.

Null, empty texts and those whose tokens do not spell them (B writes U+2581 for a space, so a
text that holds that sign) have no tokens: zeros and an empty text of groups. Texts may be of
any length: a piece without spaces is encoded whole. Rows, repeats and other columns stay as
they are; a column of the result's name is replaced. An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from tokenizers import Tokenizer

from excursio.llm.shared import fresh, ready, splitmix, stored

#: Pairs that are broadcast at most; of one shard, about; rows of a dense vector's slice in shards' sizes; vectors summed at a time.
HELD, SHARD, SLICE, FAN = 4 << 20, 1 << 17, 4, 8
#: Pieces that a worker remembers in each of two generations, and their longest; pairs that a task adds up before it writes them.
REMEMBERED, KEPT, PAIRS = 300_000, 64, 1 << 20
#: Links in a part, where counts are not broadcast, about; links that are looked up at a time.
PART, LOOKED_UP = 16 << 20, 1 << 20

#: Rows of the first pass are several times as long as their texts: a task holds few of them while it writes.
WRITTEN = {"compression": "zstd", "parquet.block.size": str(8 << 20)}

RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
#: What the first pass finds in a text; links are the keys of 8 bytes in order.
FOUND = "n_a long, n_b long, links binary, groups string"
LINKS = "key long, hash long, n long"
INDEX = "shard long, sizes binary, words binary, keys binary"

SPACE = "▁"
#: A single space between characters that nobody takes for white space.
_DARK = r"[^\s\x00-\x20\x7f-\xa0\xad\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u2581\u3000\ufeff]"
#: The space comes first, which the search finds fast.
_CUT = re.compile(f" (?<={_DARK} )(?={_DARK})")
_ONE_DARK = re.compile(_DARK)


class _Dark(dict):
    """Whether a character is such a one, remembered."""

    def __missing__(self, char: str) -> bool:
        self[char] = bool(_ONE_DARK.match(char))
        return self[char]


_dark = _Dark()


def byte_of_char() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes each byte: itself if it prints, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Aligned(NamedTuple):
    """Pieces, the tokens and links of each, and the linked pairs of all in order."""

    pieces: list[str]
    n_a: np.ndarray
    n_b: np.ndarray
    n_links: np.ndarray
    links: np.ndarray
    groups: list[str]


class Aligner:
    """A worker's two tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core already
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        code, split = byte_of_char(), spec["pre_tokenizer"] or {}
        if spec.get("normalizer") or split.get("type") != "ByteLevel" or not split.get("use_regex", True) or any(c not in spec["model"]["vocab"] for c in code):
            raise ValueError("tokenizer A must be a byte-level BPE that splits before spaces")
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(SPACE in x.lstrip(SPACE) for x in pieces):
            raise ValueError("a piece of tokenizer B spans words")
        names = [self.a.id_to_token(k) for k in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(map(code.__getitem__, t)) if all(c in code for c in t) else t.encode() for t in names]
        self.bytes_b = [bytes([int(x[3:-1], 16)]) if self.b.is_byte(k) else x.replace(SPACE, " ").encode() for k, x in enumerate(pieces)]
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.inner_a, self.last_a = (np.array([f"{k}{c}" for k in range(len(names))], object) for c in ",|")
        self.inner_b, self.last_b, self.end_b = (np.array([f"{k}{c}" for k in range(len(pieces))], object) for c in ",;\n")

    def aligned(self, pieces: list[str], groups: bool = True) -> Aligned:
        """Alignment of those of the pieces that their tokens spell, each with a space before it."""
        found = self.b.encode(pieces, num_threads=1)
        wanted = [b" " + p.encode() for p in pieces]
        size = np.fromiter(map(len, wanted), np.int64, len(pieces))
        of_b = np.fromiter(chain.from_iterable(found), np.int64)
        n_b = np.fromiter(map(len, found), np.int64, len(pieces))
        got = np.append(0, np.cumsum(self.size_b[of_b]))[np.append(0, np.cumsum(n_b))]
        good = np.diff(got) == size
        # most often all are spelt, which is seen at once
        if not good.all() or b"".join(map(self.bytes_b.__getitem__, of_b.tolist())) != b"".join(wanted):
            good = np.array([g and b"".join([self.bytes_b[k] for k in ids]) == w for g, ids, w in zip(good, found, wanted)], bool)
        # A sees many pieces at a time; those that could meet their neighbours otherwise than in a text alone come last, one by one
        plain = np.fromiter((p != "" and _dark[p[0]] and _dark[p[-1]] for p in pieces), bool, len(pieces))
        first, odd = np.flatnonzero(good & plain), np.flatnonzero(good & ~plain)
        if not len(first) + len(odd):
            return Aligned([], *[np.zeros(0, np.int64)] * 4, [])
        if len(first) < len(pieces):
            order = np.append(first, odd).tolist()
            pieces, found = [pieces[k] for k in order], [found[k] for k in order]
            size, n_b = size[order], n_b[order]
            of_b = np.fromiter(chain.from_iterable(found), np.int64)
        n_plain = len(first)
        given = [" " + " ".join(pieces[k : min(k + 1000, n_plain)]) for k in range(0, n_plain, 1000)] + [" " + p for p in pieces[n_plain:]]
        of_a = np.fromiter(chain.from_iterable(e.ids for e in self.a.encode_batch_fast(given, add_special_tokens=False)), np.int64)
        last = np.cumsum(size)
        end_a, end_b = np.cumsum(self.size_a[of_a]), np.cumsum(self.size_b[of_b])
        at = np.searchsorted(end_b, end_a)
        link = end_b[np.minimum(at, len(end_b) - 1)] == end_a
        link_a, link_b = np.flatnonzero(link), at[link]
        n_a = np.bincount(np.searchsorted(last, end_a), minlength=len(last))
        n_links = np.bincount(np.searchsorted(last, end_a[link]), minlength=len(last))
        texts = self.written(of_a, of_b, link_a, link_b, np.cumsum(n_links) - 1) if groups else []
        return Aligned(list(pieces), n_a, n_b, n_links, of_a[link_a] << 32 | of_b[link_b], texts)

    def written(self, of_a: np.ndarray, of_b: np.ndarray, link_a: np.ndarray, link_b: np.ndarray, ends: np.ndarray) -> list[str]:
        """The groups of each piece as text. ends: the last link of each piece."""
        k_a, k_b = np.arange(len(of_a)), np.arange(len(of_b))
        group_a, group_b = np.searchsorted(link_a, k_a), np.searchsorted(link_b, k_b)
        out = np.empty(len(of_a) + len(of_b), object)
        place_a = k_a + np.append(0, link_b + 1)[group_a]
        out[place_a] = self.inner_a[of_a]
        out[place_a[link_a]] = self.last_a[of_a[link_a]]
        place_b = k_b + (link_a + 1)[group_b]
        out[place_b] = self.inner_b[of_b]
        out[place_b[link_b]] = self.last_b[of_b[link_b]]
        out[place_b[link_b[ends]]] = self.end_b[of_b[link_b[ends]]]
        return "".join(out.tolist()).split("\n")[:-1]


class Remembered:
    """What is known of pieces, in two generations of bounded size; pieces without tokens are None."""

    def __init__(self, find: Callable[[list[str]], dict]):
        self.find = find
        self.young: dict = {}
        self.old: dict = {}

    def texts(self, texts: list[str], step: int = 2000) -> Iterator[tuple[list[list[str]], dict]]:
        """The pieces of some texts at a time, and a table that holds all of these pieces."""
        for lo in range(0, len(texts), step):
            some = [_CUT.split(t) if t else [] for t in texts[lo : lo + step]]
            if len(self.young) > REMEMBERED:
                self.old, self.young = self.young, {}
            met = set().union(*some)
            new = []
            for p in met.difference(self.young):
                if p in self.old:
                    self.young[p] = self.old[p]
                else:
                    new.append(p)
            for k in range(0, len(new), 20_000):
                part = new[k : k + 20_000]
                self.young.update(dict.fromkeys(part))
                self.young.update(self.find(part))
            yield some, self.young
            for p in new:
                if len(p) > KEPT:
                    del self.young[p]


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this worker for two tokenizer files."""
    return Aligner(path_a, path_b)


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their sums."""
    keys, at = np.unique(keys, return_inverse=True)
    out = np.zeros(len(keys), np.int64)
    np.add.at(out, at, n)
    return keys, out


def remembered_links(own: Aligner) -> Remembered:
    """Links of pieces, as bytes."""

    def find(pieces: list[str]) -> dict[str, bytes]:
        x = own.aligned(pieces, groups=False)
        ends = np.cumsum(x.n_links).tolist()
        return {p: x.links[lo:hi].tobytes() for p, lo, hi in zip(x.pieces, [0, *ends], ends)}

    return Remembered(find)


def links_of(texts: Iterator[list[str]], known: Remembered) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs and how often they occur, added up for as many texts as fit the bound."""

    def parts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in texts:
            for some, table in known.texts(batch):
                times = Counter(chain.from_iterable(some))
                links = [table[p] for p in times]
                if None in links:
                    bad = {p for p, x in zip(times, links) if x is None}
                    times = Counter(chain.from_iterable(pieces for pieces in some if bad.isdisjoint(pieces)))
                    links = [table[p] for p in times]
                if times:
                    sizes = np.fromiter(map(len, links), np.int64, len(links)) // 8
                    yield np.frombuffer(b"".join(links), np.int64), np.repeat(np.fromiter(times.values(), np.int64, len(times)), sizes)

    return added_up(parts())


def added_up(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys and the sums of their numbers, of as many parts as fit the bound."""
    keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for more, times in parts:
        keys, n = _added(np.concatenate([keys, more]), np.concatenate([n, times]))
        if len(keys) >= PAIRS:
            yield keys, n
            keys, n = keys[:0], n[:0]
    if len(keys):
        yield keys, n


def binaries(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all rows of a column of links, and how many each row has."""
    rows = column.cast(pa.large_binary())
    _, offsets, data = rows.buffers()
    offsets = np.frombuffer(offsets, np.int64)[rows.offset : rows.offset + len(rows) + 1] if len(rows) else np.zeros(1, np.int64)
    keys = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(np.int64) if offsets[-1] > offsets[0] else np.zeros(0, np.int64)
    return keys, np.diff(offsets) // 8


class PerfectHash:
    """Numbers 0 .. n - 1 for n distinct keys: levels of bits, and the rank of a key's bit among all."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.first = np.cumsum(sizes) - sizes

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, levels = keys.astype(np.uint64), [], []
        while len(left):
            size = -(-max(2 * len(left), 64) // 64) * 64
            at = cls.place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, np.uint64))

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (splitmix(splitmix(keys) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; of a key that was not given, any number or -1."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        keys = keys.astype(np.uint64)
        for level, (first, size) in enumerate(zip(self.first, self.sizes)):
            if not len(left):
                break
            at = first + self.place(keys[left], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)).astype(bool)
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(below[hit])
            left = left[~hit]
        return out


def shard_hash(keys: np.ndarray) -> np.ndarray:
    """Non-negative numbers of 31 bits by which keys are dealt to shards."""
    return (splitmix(keys.astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(33)).astype(np.int64)


class Counts:
    """Verified counts of keys: a perfect hash, keys and counts for each shard."""

    def __init__(self, rows: list[tuple[int, bytes, bytes, bytes, bytes]], n_shards: int, best: np.ndarray):
        self.n_shards, self.best = n_shards, best
        self.shards = {s: (PerfectHash(np.frombuffer(sizes, np.int64), np.frombuffer(words, np.uint64)), np.frombuffer(keys, np.int64), np.frombuffer(n, np.int64))
                       for s, sizes, words, keys, n in rows}

    def of(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        shard = shard_hash(keys) % self.n_shards
        for s in np.unique(shard):
            mine = np.flatnonzero(shard == s)
            hashes, known, n = self.shards[s]
            at = hashes.index(keys[mine])
            same = (at >= 0) & (known[at] == keys[mine])
            out[mine[same]] = n[at[same]]
        return out


class SomeCounts:
    """Counts of the pairs of one part of the texts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, best: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts, self.best = keys[order], counts[order], best

    def of(self, keys: np.ndarray) -> np.ndarray:
        return self.counts[np.searchsorted(self.keys, keys)] if len(keys) else np.zeros(0, np.int64)


_COUNTS: dict[str, Counts] = {}


def counts_known(name: str, sent: Broadcast) -> Counts:
    """The counts of a run of that name; those of other runs are forgotten."""
    if name not in _COUNTS:
        _COUNTS.clear()
        _COUNTS[name] = Counts(*sent.value)
    return _COUNTS[name]


def remembered_pieces(own: Aligner) -> Remembered:
    """What the first pass finds in pieces."""

    def find(pieces: list[str]) -> dict[str, tuple]:
        x = own.aligned(pieces)
        ends = np.cumsum(x.n_links).tolist()
        links = [x.links[lo:hi].tobytes() for lo, hi in zip([0, *ends], ends)]
        return dict(zip(x.pieces, zip(x.n_a.tolist(), x.n_b.tolist(), links, x.groups, strict=True), strict=True))

    return Remembered(find)


@cache
def pieces_known(path_a: str, path_b: str) -> Remembered:
    """The pieces that this worker knows."""
    return remembered_pieces(aligner(path_a, path_b))


def found_in(texts: list[str], known: Remembered) -> pa.StructArray:
    """What the first pass finds in texts."""
    rows = []
    for some, table in known.texts(texts):
        for pieces in some:
            try:
                n_a, n_b, links, groups = zip(*map(table.__getitem__, pieces))
            except (TypeError, ValueError):  # a piece that its tokens do not spell (None), or no piece
                rows.append((0, 0, b"", ""))
                continue
            rows.append((sum(n_a), sum(n_b), b"".join(links), ";".join(groups)))
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.string()))], _names(FOUND))


def _names(kinds: str) -> list[str]:
    return [x.split()[0] for x in kinds.split(", ")]


def results(found: pa.StructArray, counts: Counts | SomeCounts) -> pa.StructArray:
    """The result of each text, of what the first pass found in it."""
    keys, n_links = binaries(found.field("links"))
    sums, best = np.zeros(len(keys) + 1, np.int64), np.zeros(len(keys) + 1, np.int64)
    for lo in range(0, len(keys), LOOKED_UP):
        asked, at = np.unique(keys[lo : lo + LOOKED_UP], return_inverse=True)
        n = counts.of(asked)
        sums[lo + 1 : lo + 1 + len(at)] = n[at]
        best[lo + 1 : lo + 1 + len(at)] = (n == counts.best[asked & 0xFFFFFFFF])[at]
    ends = np.append(0, np.cumsum(n_links))
    n_best, count_sum = (np.diff(np.cumsum(x)[ends]) for x in (best, sums))
    columns = [found.field("n_a"), found.field("n_b"), *map(pa.array, (n_links, n_links, n_best, count_sum)), found.field("groups")]
    return pa.StructArray.from_arrays(columns, _names(RESULT))


def _first_pass(docs: DataFrame, text: str, paths: tuple[str, str], found: str, part: str) -> DataFrame:
    """The rows, written, with what is found in their texts and a number by which rows can be dealt."""

    def run(texts: pa.Array) -> pa.Array:
        return found_in(texts.fill_null("").to_pylist(), pieces_known(*paths))

    rows = docs.withColumns({found: arrow_udf(run, FOUND)(F.col(f"`{text}`")), part: F.xxhash64(F.monotonically_increasing_id())})
    return stored(rows, "alignment-rows", **WRITTEN)


def _pairs(rows: DataFrame, found: str) -> DataFrame:
    """Linked pairs of tasks with their numbers, and the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (np.unique(binaries(batch.column(0))[0], return_counts=True) for batch in batches)
        for keys, n in added_up(parts):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(shard_hash(keys)), pa.array(n)], ["key", "hash", "n"])

    return rows.select(F.col(f"`{found}`.links")).mapInArrow(run, LINKS).withColumn("task", F.spark_partition_id())


def _index(keys: DataFrame) -> DataFrame:
    """A perfect hash of the keys of each shard, which come in any order, and the keys in that of their numbers."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        keys = rows["key"].to_numpy(np.int64)
        hashes = PerfectHash.of(keys)
        ordered = np.empty_like(keys)
        ordered[hashes.index(keys)] = keys
        return pd.DataFrame({"shard": rows["shard"].iloc[:1].to_list(), "sizes": [hashes.sizes.tobytes()], "words": [hashes.words.tobytes()],
                             "keys": [ordered.tobytes()]})

    return keys.groupBy("shard").applyInPandas(build, INDEX)


def _summed(links: DataFrame, index: DataFrame, n_slices: int) -> DataFrame:
    """Dense vectors of each shard's slices, summed as a tree: shard, counts."""

    def dense(key: tuple, rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(rows):
            return pd.DataFrame({"shard": [], "slice": [], "counts": []})
        x = own.iloc[0]
        hashes = PerfectHash(np.frombuffer(x["sizes"], np.int64), np.frombuffer(x["words"], np.uint64))
        keys, out = rows["key"].to_numpy(np.int64), np.zeros(len(x["keys"]) // 8, np.int64)
        at = hashes.index(keys)
        if (np.frombuffer(x["keys"], np.int64)[at] != keys).any():
            raise ValueError("a pair is missing in the index")
        np.add.at(out, at, rows["n"].to_numpy(np.int64))
        return pd.DataFrame({"shard": [key[0]], "slice": [key[1]], "counts": [out.tobytes()]})

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = np.sum([np.frombuffer(x, np.int64) for x in rows["counts"]], axis=0, dtype=np.int64)
        return pd.DataFrame({"shard": [key[0]], "slice": [key[1]], "counts": [out.tobytes()]})

    kind = "shard long, slice long, counts binary"
    copies = index.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1)).cast("array<long>")))
    now = links.groupBy("shard", "slice").cogroup(copies.groupBy("shard", "slice")).applyInPandas(dense, kind)
    while n_slices > 1:
        n_slices = -(-n_slices // FAN)
        now = now.groupBy("shard", F.floor(F.col("slice") / FAN).alias("slice")).applyInPandas(add, kind)
    return now.select("shard", "counts")


def _best(index: DataFrame) -> DataFrame:
    """The highest count of each id of B: at most as many rows as B has ids."""

    def highest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for keys, counts in zip(frame["keys"], frame["counts"]):
                ids, at = np.unique(np.frombuffer(keys, np.int64) & 0xFFFFFFFF, return_inverse=True)
                most = np.zeros(len(ids), np.int64)
                np.maximum.at(most, at, np.frombuffer(counts, np.int64))
                yield pd.DataFrame({"id": ids, "most": most})

    return index.select("keys", "counts").mapInPandas(highest, "id long, most long").groupBy("id").agg(F.max("most").alias("most"))


def _by_parts(rows: DataFrame, found: str, part: str, index: DataFrame, best: np.ndarray, out: str) -> DataFrame:
    """The second pass where the counts are too many to broadcast: each part of the rows gets the counts of its pairs."""
    links = F.col(f"`{found}`.links")
    n_parts = max(1, -(-(rows.agg(F.sum(F.octet_length(links))).first()[0] or 0) // (8 * PART)))
    # copies of one text are dealt out as well
    dealt = rows.withColumn(part, F.pmod(F.col(f"`{part}`"), F.lit(n_parts)))

    def wanted(key: tuple, own: pa.Table) -> pa.Table:
        keys = np.unique(np.concatenate([np.zeros(0, np.int64), *[binaries(c)[0] for c in own.column("links").chunks]]))
        return pa.table({"part": pa.array([key[0].as_py()] * len(keys), pa.int64()), "key": pa.array(keys)})

    asked = dealt.select(links.alias("links"), F.col(f"`{part}`").alias("part")).groupBy("part").applyInArrow(wanted, "part long, key long")

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for keys, counts in zip(frame["keys"], frame["counts"]):
                yield pd.DataFrame({"key": np.frombuffer(keys, np.int64), "count": np.frombuffer(counts, np.int64)})

    counts = index.select("keys", "counts").mapInPandas(pairs, "key long, count long")
    answers = stored(asked.join(counts, "key"), "alignment-counts")

    fields = [f for f in rows.schema.fields if f.name not in (found, part)]
    columns = [f.name for f in fields]

    def finish(own: pa.Table, answer: pa.Table) -> pa.Table:
        known = SomeCounts(answer.column("key").to_numpy(), answer.column("count").to_numpy(), best)
        done = pa.chunked_array([results(c, known) for c in own.column(found).chunks])
        return pa.table([*[own.column(c) for c in columns], done], names=[*columns, out])

    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{out}` struct<{RESULT.replace(' ', ': ').replace(',:', ',')}>"])
    return dealt.groupBy(F.col(f"`{part}`")).cogroup(answers.groupBy(F.col("part").alias(part))).applyInArrow(finish, kinds)


def aligned(docs: DataFrame, text: str = "text", path_a: str | None = None, path_b: str | None = None, out: str = "alignment",
            held: int = HELD, shard: int = SHARD) -> DataFrame:
    """The rows with a struct column: n_a, n_b, n_groups, n_links, n_best, count_sum and the groups as `a1,a2|b1;a3|b2`.

    n_best counts the links whose pair's count is the highest of its id of B; count_sum adds the
    counts of all links.
    """
    spark = docs.sparkSession
    ready(spark)
    paths = (path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model"))
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()])
    found, part = fresh(docs, "found"), fresh(docs, "part")
    rows = _first_pass(docs, text, paths, found, part)
    links = stored(_pairs(rows, found), "alignment-links")
    keys = stored(links.groupBy("key", "hash").agg(F.count("*").alias("rows")), "alignment-keys")
    n_keys, n_rows = keys.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    n_shards = max(1, -(-n_keys // shard))
    n_slices = max(1, -(-n_rows // (SLICE * max(n_keys, 1))))
    index = stored(_index(keys.select("key", (F.col("hash") % n_shards).alias("shard"))), "alignment-index")
    slices = links.select("key", "n", (F.col("hash") % n_shards).alias("shard"), (F.col("task") % n_slices).cast("long").alias("slice"))
    counted = stored(index.join(_summed(slices, index, n_slices), "shard"), "alignment-counts")
    highest = _best(counted).collect()
    best = np.zeros(1 + max((r.id for r in highest), default=0), np.int64)
    for r in highest:
        best[r.id] = r.most
    if n_keys > held:
        return _by_parts(rows, found, part, counted, best, out)
    whole = counted.select("shard", "sizes", "words", "keys", "counts").toArrow().to_pylist()
    sent = spark.sparkContext.broadcast(([tuple(bytes(v) if isinstance(v, (bytes, bytearray)) else v for v in r.values()) for r in whole], n_shards, best))
    name = uuid.uuid4().hex

    def run(found: pa.Array) -> pa.Array:
        return results(found, counts_known(name, sent))

    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], arrow_udf(run, RESULT)(F.col(f"`{found}`")).alias(out))
