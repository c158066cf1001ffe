"""Personal data: fixed patterns, and contextual extraction bootstrapped from what they find.

Base spans (e-mail, IP address, card, telephone number) seed the extraction. Each seed and each
other identifier-like string is an instance; the two words before it, and the words around it,
are lexical patterns. Spark keeps the graph of distinct pattern-instance edges and scores it
in rounds: a pattern is trusted for a kind when enough distinct instances of that kind, and few
others, occur in it; instances that trusted patterns extract count for the next round. In the
end, the trusted patterns mark the unseen identifiers in the texts, never changing base spans.

Trusted patterns go to the executors in blocks of a fixed size, one scan column after another.
Words and identifiers of any length are compared whole, long ones by a hash of 128 bits, and texts of any length are
read whole in about linear time. Null counts as empty: no spans; an empty table gives no rows. Repeated rows are scanned one by one, but an instance counts
once for a pattern, however many copies it has. Rows and other columns stay as they are.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from excursio.llm.shared import fresh, ready, stored

KINDS = ("email", "ip", "card", "phone")
#: A pattern of n distinct instances, p of them of a kind, is trusted for it from p >= SUPPORT and p / (n + 2) >= TRUST.
SUPPORT = 5
TRUST = 0.7
#: Trusted patterns that one broadcast holds.
PATTERNS = 200_000
#: Code points of a word in a pattern, and of an instance, that are written out; longer ones end in a hash of the whole.
WORD, INSTANCE = 40, 200

Span = tuple[int, int, int]

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is tried from its start only: no later start in it can do better
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_SIGN = re.compile("[0-9@]")
_SPACES = " \t\n\x0b\x0c\r"
_SPACE = re.compile(f"[{_SPACES}]")
_EDGES = "\"'`.,;:!?()[]{}<>#*$%&|="
_MORE = re.compile(r" [0-9().-]*[0-9][0-9().-]*")
_DOUBLE = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = sum(map(int, digits[-1::-2])) + sum(_DOUBLE[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) of the fixed patterns, by kind and start, in code points."""
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            done = m.end()
            out.append((0, begin, done))
        at = text.find("@", max(at + 1, done))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m.group().split("."))):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def other_identifiers(text: str, taken: list[Span]) -> Iterator[tuple[int, int]]:
    """Identifier-like strings outside the spans taken: four digits or an @ between white space, edge signs cut off.

    Groups of digits that follow belong to one that ends in a digit.
    """
    taken = sorted((s, e) for _, s, e in taken)
    k, done = 0, 0
    m = _SIGN.search(text)
    while m:
        begin = m.start()
        while begin > done and text[begin - 1] not in _SPACES:
            begin -= 1
        end = m.end()
        while end < len(text) and text[end] not in _SPACES:
            end += 1
        done = end
        while text[done - 1].isdigit() and (more := _MORE.match(text, done)):
            done = more.end()
        lo, hi = begin, done
        while lo < hi and text[lo] in _EDGES:
            lo += 1
        while lo < hi and text[hi - 1] in _EDGES:
            hi -= 1
        while k < len(taken) and taken[k][1] <= lo:
            k += 1
        if (k == len(taken) or taken[k][0] >= hi) and ("@" in text[lo:hi] or len(_DIGIT.findall(text, lo, hi)) >= 4):
            yield lo, hi
        m = _SIGN.search(text, done)


def may_be(kind: int, value: str) -> bool:
    """Whether a string has the kind's make: letters only in e-mail names, seven digits elsewhere."""
    letters = any(c.isalpha() for c in value)
    if kind == 0:
        return "@" in value or letters
    return not letters and len(_DIGIT.findall(value)) >= 7


def _short(value: str, most: int) -> str:
    """A text by which another is the same only if it is the same: itself, or its start and a hash of 128 bits."""
    return value if len(value) <= most else f"{value[:most]}..{blake2b(value.encode(), digest_size=16).hexdigest()}"


def _word(value: str) -> str:
    return _short(value.strip(_EDGES).lower(), WORD)


def _before(text: str, end: int, borders: list[int]) -> tuple[str, int]:
    """The word before a place, and where it starts; empty at the start of the text."""
    while end > 0 and text[end - 1] in _SPACES:
        end -= 1
    k = bisect_left(borders, end)
    begin, least = end, borders[k - 1] if k else 0
    while begin > least and text[begin - 1] not in _SPACES:
        begin -= 1
    return text[begin:end], begin


def borders_of(found: Iterable[tuple[int, int]]) -> list[int]:
    """Where identifiers begin and end: words of a pattern end there as well, however long the run without white space is."""
    return sorted({x for pair in found for x in pair})


def patterns(text: str, start: int, end: int, borders: list[int]) -> tuple[str, ...]:
    """The lexical patterns that an identifier stands in."""
    near, at = _before(text, start, borders)
    if not near or not (w1 := _word(near)):
        return ()
    far, _ = _before(text, at, borders)
    begin = end
    while begin < len(text) and text[begin] in _SPACES + _EDGES:
        begin += 1
    k = bisect_right(borders, begin)
    stop = borders[k] if k < len(borders) else len(text)
    m = _SPACE.search(text, begin, stop)
    out = [f"{_word(far)} {w1} _"] if far else []
    return (*out, f"{w1} _ {_word(text[begin : m.start() if m else stop])}")


def edges(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct rows (pattern, instance, kind): kind is null for identifiers that no fixed pattern finds."""
    ready(docs.sparkSession)

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts.to_pylist():
            rows = []
            if value and _SIGN.search(value):
                seeds = base_spans(value)
                found = [(s, e, KINDS[k]) for k, s, e in seeds] + [(s, e, None) for s, e in other_identifiers(value, seeds)]
                borders = borders_of((s, e) for s, e, _ in found)
                for s, e, kind in found:
                    instance = _short(value[s:e].lower(), INSTANCE)
                    rows += [{"pattern": p, "instance": instance, "kind": kind} for p in patterns(value, s, e, borders)]
            out.append(rows)
        kind = pa.struct([("pattern", pa.string()), ("instance", pa.string()), ("kind", pa.string())])
        return pa.array(out, pa.list_(kind))

    udf = arrow_udf(run, "array<struct<pattern string, instance string, kind string>>")
    rows = docs.select(F.explode(udf(F.col(f"`{text}`"))).alias("x")).select("x.*")
    return rows.groupBy("pattern", "instance").agg(F.min("kind").alias("kind"))


def trusted_patterns(graph: DataFrame, rounds: int | None = None) -> DataFrame:
    """Rows (pattern, kind, score) of the patterns trusted in the end; score is RlogF.

    Rounds go on until one labels no instance, as every other one labels some for good; rounds stops them before.
    """
    labels = graph.select("pattern", "instance", "kind")
    for n in count(1):
        counts = labels.groupBy("pattern").agg(
            F.count("*").alias("n"), *[F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in KINDS])
        best = F.greatest(*KINDS)
        kind = F.coalesce(*[F.when(F.col(k) == best, F.lit(k)) for k in KINDS])
        trusted = counts.where((best >= SUPPORT) & (best >= TRUST * (F.col("n") + 2))).select(
            "pattern", kind.alias("kind"), (best / F.col("n") * F.log2(best + 1)).alias("score"))
        trusted = stored(trusted, "patterns")
        # an unlabelled instance takes the kind of the best trusted pattern it occurs in
        votes = labels.where("kind IS NULL").join(trusted.select("pattern", F.col("kind").alias("vote"), "score"), "pattern")
        given = votes.groupBy("instance").agg(F.max(F.struct("score", "vote")).alias("v")).select("instance", F.col("v.vote").alias("vote"))
        given = stored(given, "given")
        if n == rounds or given.isEmpty():
            return trusted
        labels = stored(labels.join(given, "instance", "left").select(
            "pattern", "instance", F.coalesce("kind", "vote").alias("kind")), "labels")


_SHAPE = "array<struct<kind int, begin int, end int>>"


def _marker(shared, mask: bool):
    """The scan with one block of trusted patterns, which adds to what the blocks before found, and masks the text if asked to."""

    def run(texts: pa.Array, before: pa.Array) -> pa.Array:
        trust, base, spans, masked = shared.value, [], [], []
        for value, old in zip(texts.to_pylist(), before.to_pylist()):
            own, added = [], set()
            if value and _SIGN.search(value):
                own = base_spans(value)
                if old is not None:
                    added = {tuple(x.values()) for x in old["spans"]} - set(own)
                if trust:
                    others = list(other_identifiers(value, own))
                    borders = borders_of([*others, *((s, e) for _, s, e in own)])
                    for s, e in others:
                        kinds = {trust[p] for p in patterns(value, s, e, borders) if p in trust}
                        added.update((kind, s, e) for kind in kinds if may_be(kind, value[s:e]))
            every = sorted({*own, *added})
            base.append([dict(zip(("kind", "begin", "end"), x)) for x in own])
            spans.append([dict(zip(("kind", "begin", "end"), x)) for x in every])
            masked.append(mask_spans(value, every) if mask and every else value if mask else None)
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())]))
        return pa.StructArray.from_arrays(
            [pa.array(base, kind), pa.array(spans, kind), pa.array(masked, pa.string())], ["base", "spans", "masked"])

    return run


def mask_spans(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one, of the first kind."""
    parts, at = [], 0
    for s, e, kind in sorted((s, e, kind) for kind, s, e in spans):
        if s >= at:
            parts += [text[at:s], f"<{KINDS[kind]}>"]
        at = max(at, e)
    return "".join([*parts, text[at:]])


def _scanned(docs: DataFrame, text: str, out: str, rounds: int | None, block: int, mask: bool) -> DataFrame:
    """The rows with a struct column (base, spans, masked), all from one Python step per block."""
    spark = docs.sparkSession
    trusted = trusted_patterns(stored(edges(docs, text), "edges"), rounds)
    blocks = max(1, -(-trusted.count() // block))
    shape = f"base {_SHAPE}, spans {_SHAPE}, masked string"
    df = docs.withColumn(out, F.lit(None).cast(f"struct<{shape}>"))
    for k in range(blocks):
        rows = trusted.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == k).select("pattern", "kind").collect()
        shared = spark.sparkContext.broadcast({r.pattern: KINDS.index(r.kind) for r in rows})
        marker = arrow_udf(_marker(shared, mask and k == blocks - 1), shape)
        df = df.withColumn(out, marker(F.col(f"`{text}`"), F.col(out)))
    return df


def found(docs: DataFrame, text: str = "text", out: str = "pii", rounds: int | None = None, block: int = PATTERNS) -> DataFrame:
    """The rows with a struct column (base, spans), each an array of (kind, begin, end) by kind and start.

    kind is an index into KINDS; begin and end count code points, end exclusive.
    """
    temp = fresh(docs, "_pii")
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()]
    return _scanned(docs, text, temp, rounds, block, False).select(*keep, F.col(temp).dropFields("masked").alias(out))


def masked(docs: DataFrame, text: str = "text", rounds: int | None = None, block: int = PATTERNS) -> DataFrame:
    """The rows with the personal data in their texts masked."""
    temp = fresh(docs, "_pii")
    df = _scanned(docs, text, temp, rounds, block, True)
    return df.select(*[F.col(f"{temp}.masked").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
