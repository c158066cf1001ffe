"""BPE encoding and decoding of whole texts, exactly as the tokenizers library does.

White space parts a text into chunks that no token crosses. Short chunks are encoded by the
library, each distinct one once per batch, and kept in a bounded table. A chunk of any length
that white space does not split is normalised and pre-split as the library's own parts do it,
and every long piece is encoded as a tree: both halves on their own, then a growing window of
tokens around the join is encoded anew until its first and last token are those that the halves
have there; a window that grows wide, as in a line of dashes, is merged with a heap. A sequence of BPE tokens is the encoding of its text exactly if each adjacent
pair is the encoding of its own text, so agreement at both ends makes the whole right.

Null counts as empty: no tokens, empty decoded text. Rows, order of repeats and other columns
stay as they are. Texts may be of any length; the memory of a task is a batch of texts, the
table of chunks and the tokens of the batch.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from tokenizers import Tokenizer

from excursio.llm.shared import ready

#: Chunks of more code points are split into pieces and encoded as trees.
CHUNK = 64
#: Symbols of a leaf of the tree.
LEAF = 32
#: Chunks that a worker remembers in each of two generations.
REMEMBERED = 200_000

#: Characters that str.split takes for white space, but the tokenizer does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def chunks(text: str) -> list[str]:
    """Parts of a text between white space, as the tokenizer understands white space."""
    if _NOT_SPACE.search(text):
        return [x for x in _SPACE.split(text) if x]
    return text.split()


class Merges:
    """The merge rules of a BPE model with word ends: encodes runs of symbols."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        self.ids = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        pairs = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in model["merges"]]
        self.rank = {p: k for k, p in enumerate(pairs)}

    def symbols(self, piece: str) -> list[str]:
        """Symbols of a pre-split piece: its characters, the last one with the word end."""
        return [*piece[:-1], piece[-1] + self.end]

    def parts(self, token: str) -> list[str]:
        """Symbols of a token."""
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            return self.symbols(token[: -len(self.end)])
        return list(token)

    def merged(self, symbols: Sequence[str]) -> list[str]:
        """Plain BPE: the best-ranked pair is merged, the leftmost first, until none is left."""
        out, rank = list(symbols), self.rank
        while len(out) > 1:
            best, at = min((rank.get(p, len(rank)), k) for k, p in enumerate(zip(out, out[1:])))
            if best == len(rank):
                break
            out[at : at + 2] = [out[at] + out[at + 1]]
        return out

    def queued(self, symbols: Sequence[str]) -> list[str]:
        """The same as merged for runs of any length: pairs wait in a heap, n log n in all."""
        rank, n = self.rank, len(symbols)
        out: list[str | None] = list(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(rank[p], k, *p) for k, p in enumerate(zip(out, out[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            j = after[k] if out[k] == a else n
            if j >= n or out[j] != b:
                continue  # one of the two has been merged meanwhile
            out[k], out[j] = a + b, None
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
            for i, j in ((before[k], k), (k, after[k])):
                if i >= 0 and j < n and (out[i], out[j]) in rank:
                    heapq.heappush(heap, (rank[out[i], out[j]], i, out[i], out[j]))
        return [s for s in out if s is not None]

    def joined(self, left: list[str], right: list[str]) -> list[str]:
        """Encoding of the text of two encodings together."""
        width = 2
        while True:
            a, b = min(width, len(left)), min(width, len(right))
            window = [s for t in left[len(left) - a :] + right[:b] for s in self.parts(t)]
            new = self.merged(window) if len(window) <= 4 * LEAF else self.queued(window)
            if (a == len(left) or new[0] == left[-a]) and (b == len(right) or new[-1] == right[b - 1]):
                return left[: len(left) - a] + new + right[b:]
            width *= 4

    def tree(self, symbols: Sequence[str]) -> list[str]:
        """Encoding of a long run of symbols, by halves that join level by level."""
        level = [self.merged(symbols[k : k + LEAF]) for k in range(0, len(symbols), LEAF)]
        while len(level) > 1:
            pairs = zip(level[::2], level[1::2])
            level = [self.joined(a, b) for a, b in pairs] + level[len(level) & ~1 :]
        return level[0] if level else []


class Encoder:
    """A worker's tokenizer: whole chunks to ids, with a bounded table of those met."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core already
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.merges: Merges | None = None
        self.path = path
        special = {k: v.content for k, v in self.library.get_added_tokens_decoder().items()}
        self.special = {v: k for k, v in special.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special))) + ")") if self.special else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def long_chunk(self, chunk: str) -> list[int]:
        """Ids of a chunk of any length."""
        if self.merges is None:
            self.merges = Merges(self.path)
        out: list[int] = []
        for k, part in enumerate(self.split.split(chunk) if self.split else [chunk]):
            if k % 2:
                out.append(self.special[part])
            elif part:
                normal = self.library.normalizer.normalize_str(part) if self.library.normalizer else part
                for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal):
                    out += map(self.merges.ids.__getitem__, self.merges.tree(self.merges.symbols(piece)))
        return out

    def learn(self, texts_chunks: list[list[str]]) -> list[str]:
        """Make all chunks of the texts known; the long ones, which are given back, only for the time being."""
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        wanted = set().union(*texts_chunks).difference(self.young)
        known = {c: self.old[c] for c in wanted if c in self.old}
        self.young.update(known)
        short = [c for c in wanted if c not in known and len(c) <= CHUNK]
        encoded = self.library.encode_batch_fast(short, add_special_tokens=False)
        for c, e in zip(short, encoded):
            self.young[c] = np.array(e.ids, np.int32).tobytes()
        long = [c for c in wanted if len(c) > CHUNK]
        for c in long:
            self.young[c] = np.array(self.long_chunk(c), np.int32).tobytes()
        return long

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of 32-bit integers."""
        split = [chunks(t) for t in texts]
        long = self.learn(split)
        known = self.young
        out = [b"".join([known[c] for c in s]) for s in split]
        for c in long:
            del known[c]
        return out


_ENCODERS: dict[str, Encoder] = {}
_TOKENS: dict[str, np.ndarray] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def decoded(path: str, ids: Sequence[int]) -> str:
    """The text that the library's decode gives for ids, special tokens kept."""
    if path not in _TOKENS:
        library = encoder(path).library
        if library.decoder is not None:
            raise ValueError("tokenizers with a decoder of their own are not covered")
        _TOKENS[path] = [library.id_to_token(k) for k in range(library.get_vocab_size())]
    tokens = _TOKENS[path]
    return " ".join([tokens[k] for k in ids])



def encode_decode(text: Column, path: str) -> Column:
    """Struct column (ids, decoded): the ids of a text, and the text decoded from those ids."""

    def run(texts: pa.Array) -> pa.Array:
        own, ids, back, lengths = encoder(path), [], [], [0]
        rows = texts.fill_null("").to_pylist()
        for lo in range(0, len(rows), 32):
            for raw in own.encode(rows[lo : lo + 32]):
                values = np.frombuffer(raw, np.int32)
                ids.append(values)
                back.append(decoded(path, values.tolist()))
                lengths.append(lengths[-1] + len(values))
        flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
        lists = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), flat)
        return pa.StructArray.from_arrays([lists, pa.array(back, pa.string())], ["ids", "decoded"])

    return arrow_udf(run, "ids array<int>, decoded string")(text)


def encoded(docs: DataFrame, text: str = "text", path: str | None = None, out: str = "encoding") -> DataFrame:
    """The rows with a struct column (ids, decoded); it replaces a column of that name."""
    ready(docs.sparkSession)
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()]
    path = path or public_tokenizers.path("word_bpe_49k.json")
    return docs.select(*keep, encode_decode(F.col(f"`{text}`"), path).alias(out))
