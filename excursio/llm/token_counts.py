"""Token counts from a tokenizer compiled to a deterministic finite-state transducer.

The transducer reads a normalised text by characters. Its state holds the last token of the
encoding so far and every prefix of a longer token that may still end in one, with the tokens
since; each transition is annotated with the change of the number of tokens, so a count is the
sum along a path. A token may end the encoding only where the pair with the token before it is
its own encoding: that makes the path the tokenizer's own answer, with no merging of the text.
Transitions are compiled when first met and kept in a bounded table.

A text is read in chunks. A chunk's map sends the state before it to the state after it and the
tokens between: what stands before its first word boundary is read from the state that comes
in; the rest does not depend on it and is counted once, each distinct word once per table.
Maps of neighbouring chunks compose to a map, associatively, so a scan joins them pairwise.

Null counts as empty: no tokens, no bytes. Rows and other columns stay as they are. Memory is
a batch of texts and the bounded tables; a word of any length is read in one pass.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from sentencepiece import sentencepiece_model_pb2

from excursio.llm.shared import ready

#: Code points of a chunk.
CHUNK = 1 << 16
#: Texts of more tokens are over the limit.
LIMIT = 4096
#: Words of up to so many code points are remembered.
KEPT = 64
#: Words, states and token pairs that a worker remembers.
WORDS, STATES, PAIRS = 800_000, 400_000, 800_000

SPACE = "▁"
_NEVER = float("-inf")
#: Words with the spaces before them, and line breaks, which are bytes of their own.
_UNITS = re.compile(f"^[^{SPACE}\n]+|\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")


@dataclass(frozen=True)
class ChunkMap:
    """head is read from the state before; then, if the chunk has a boundary, total tokens lead to exit."""

    head: str
    total: int | None
    exit: dict | None


class Transducer:
    """The compiled model. A state is a row: character -> (row after, tokens added)."""

    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto())
        spec = model.normalizer_spec
        if (model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or spec.precompiled_charsmap
                or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or not spec.escape_whitespaces):
            raise ValueError("only BPE models with byte fallback and plain white space are compiled")
        pieces = [p for p in model.pieces if p.type == 1]
        if any(SPACE in p.piece.lstrip(SPACE) for p in pieces) or any(p.type in (4, 5) for p in model.pieces):
            raise ValueError("a piece spans words or is not a plain one")
        self.score = {p.piece: p.score for p in pieces}
        self.tokens: list[str] = []
        self.children: list[dict[str, int]] = [{}]
        self.token_at: list[int] = [-1]
        for piece in self.score:
            if self.merged(list(piece)) == [piece]:
                node = 0
                for c in piece:
                    if c not in self.children[node]:
                        self.children[node][c] = len(self.children)
                        self.children.append({})
                        self.token_at.append(-1)
                    node = self.children[node][c]
                self.token_at[node] = len(self.tokens)
                self.tokens.append(piece)
        self.pairs: dict[int, bool] = {}
        self.histories: dict[int, tuple[list[float], list[str], list[str]]] = {}
        self.words = _Words(self)
        self.reset()

    def reset(self) -> None:
        """Forget all compiled states. A state that is being left knows its key, so reading goes on from it."""
        #: key of a state: (last token or -1, prefixes (node, token before, tokens since), only spaces so far)
        self.start = {None: (-1, (), True)}
        self.rows = {self.start[None]: self.start}

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain BPE: the best-scored pair is merged, the leftmost first, until none is left."""
        score = self.score
        while len(symbols) > 1:
            scores = [score.get(a + b, _NEVER) for a, b in zip(symbols, symbols[1:])]
            best = max(scores)
            if best == _NEVER:
                break
            at = scores.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def follows(self, before: int, token: int) -> bool:
        """Whether the pair of tokens is the encoding of its text."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        known = self.pairs[before << 20 | token] = before < 0 or not self.meets(before, token)
        return known

    def history(self, token: int) -> tuple[list[float], list[str], list[str]]:
        """The scores of a token's merges in turn, and its first and last symbol before each and at the end."""
        if token not in self.histories:
            symbols, scores = list(self.tokens[token]), []
            firsts, lasts = [symbols[0]], [symbols[-1]]
            while len(symbols) > 1:
                own = [self.score.get(a + b, _NEVER) for a, b in zip(symbols, symbols[1:])]
                at = own.index(max(own))
                scores.append(own[at])
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
                firsts.append(symbols[0])
                lasts.append(symbols[-1])
            self.histories[token] = ([*scores, _NEVER], firsts, lasts)
        return self.histories[token]

    def meets(self, a: int, b: int) -> bool:
        """Whether a merge across the border of two tokens comes before their own merges are done.

        Up to then either token merges as it does alone, the better score first and of equals the
        leftmost: left token, border, right token.
        """
        left, _, ends = self.history(a)
        right, begins, _ = self.history(b)
        i = j = 0
        score = self.score
        while True:
            across = score.get(ends[i] + begins[j], _NEVER)
            if across > left[i] and across >= right[j] and across > _NEVER:
                return True
            if left[i] == right[j] == _NEVER:
                return False
            if left[i] >= right[j]:
                i += 1
            else:
                j += 1

    def compiled(self, row: dict, c: str) -> tuple[dict, int]:
        """The transition of a state on a character, now part of the table."""
        if len(self.rows) > STATES:
            self.reset()
        last, prefixes, spaces = row[None]
        if c == SPACE and not spaces:
            out = self.start.get(c) or self.compiled(self.start, c)  # a word ends: the rest starts anew
        elif c not in self.children[0]:  # bytes, which nothing merges with
            out = self.row((-1, (), False)), len(c.encode("utf-8", "surrogatepass"))
        else:
            children, token_at, pairs = self.children, self.token_at, self.pairs
            alive = []
            for node, before, since in ((0, last, 0), *prefixes):
                after = children[node].get(c)
                if after is None:
                    continue
                if (ends := token_at[after]) >= 0:
                    good = pairs.get(before << 20 | ends)
                    if self.follows(before, ends) if good is None else good:
                        token, added = ends, 1 - since
                if children[after]:
                    alive.append((after, before, since))
            alive = tuple([(node, before, since + added) for node, before, since in alive])
            out = self.row((token, alive, spaces and c == SPACE)), added
        row[c] = out
        return out

    def row(self, key: tuple) -> dict:
        if key not in self.rows:
            self.rows[key] = {None: key}
        return self.rows[key]

    def read(self, row: dict, text: str) -> tuple[dict, int]:
        """State after a normalised text and tokens added on the way."""
        n = 0
        for c in text:
            row, added = row.get(c) or self.compiled(row, c)
            n += added
        return row, n

    def chunk_map(self, chunk: str) -> ChunkMap:
        """The map of a chunk of normalised text."""
        units = _UNITS.findall(chunk)
        if len(units) < 2:
            return ChunkMap(chunk, None, None)
        row, n = self.read(self.start, units[-1])
        return ChunkMap(units[0], n + sum(map(self.words.__getitem__, units[1:-1])), row)

    def composed(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """The map of two neighbouring chunks together."""
        if a.total is None:
            return ChunkMap(a.head + b.head, b.total, b.exit)
        row, n = self.read(a.exit, b.head)
        return ChunkMap(a.head, a.total + n + (b.total or 0), row if b.total is None else b.exit)

    def scanned(self, maps: list[ChunkMap]) -> ChunkMap:
        """All maps composed, pairwise and level by level."""
        while len(maps) > 1:
            maps = [self.composed(*maps[k : k + 2]) if k + 1 < len(maps) else maps[k] for k in range(0, len(maps), 2)]
        return maps[0]

    def count(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a text."""
        if not text:
            return 0
        if len(self.words) > WORDS:
            self.words.clear()
        text = SPACE + text.replace(" ", SPACE)
        whole = self.scanned([self.chunk_map(text[k : k + chunk]) for k in range(0, len(text), chunk)])
        return self.read(self.start, whole.head)[1] + (whole.total or 0)


class _Words(dict):
    """Tokens of whole words, read when first asked for."""

    def __init__(self, transducer: Transducer):
        self.transducer = transducer

    def __missing__(self, word: str) -> int:
        n = self.transducer.read(self.transducer.start, word)[1]
        if len(word) <= KEPT:
            self[word] = n
        return n


_TRANSDUCERS: dict[str, Transducer] = {}


def counted(docs: DataFrame, text: str = "text", path: str | None = None, limit: int = LIMIT, out: str = "tokens") -> DataFrame:
    """The rows with a struct column (n_bytes, n_tokens, over_limit); it replaces a column of that name."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    ready(docs.sparkSession)

    def run(texts: pa.Array) -> pa.Array:
        if path not in _TRANSDUCERS:
            _TRANSDUCERS[path] = Transducer(path)
        count = _TRANSDUCERS[path].count
        return pa.array([count(t.as_py() or "") for t in texts], pa.int64())

    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()]
    source = F.col(f"`{text}`")
    df = docs.select(*keep, F.struct(F.coalesce(F.octet_length(source), F.lit(0)).cast("long").alias("n_bytes"),
                                     arrow_udf(run, "bigint")(source).alias("n_tokens")).alias(out))
    return df.withColumn(out, F.col(out).withField("over_limit", F.col(f"{out}.n_tokens") > limit))
