"""Alignment of two tokenizers against the libraries and plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from excursio.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(A)
LIBRARY.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)
_BYTES = {chr(b): b for b in [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]}
_BYTES |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if chr(b) not in _BYTES)}

POOL = ["the", "tion", " ", "  ", "\n", "\t", " \n", "\n ", "'s", " 's", "'ll", "é", "中文", "😀", "—", " ", "​", " ", "\x00", "\x1c", "\x85", "1", "2024",
        "...", "!?", "x", "<|endoftext|>", "<s>", "<0x41>", "᠎", "́", "Ab", "ZZ", "_", "  a", "　", "①", "﻿", "▁", "(", ") ", " ́"]


def mixed(seed: int) -> str:
    rng = random.Random(seed)
    return "".join(rng.choice(POOL) for _ in range(rng.randint(1, 60)))


ODD = ["", " ", "\n", "   ", " a", "a ", "▁", "a▁ b", "word " * 3000, "x" * 5000, "中" * 3000, "<unk> </s> <|endoftext|>", "it's we'll  don't", "a\r\n b"]


def brute(text):
    """Ids of both, their groups and the ids that end together; None without tokens."""
    if not text:
        return None
    a, b = LIBRARY.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)
    bytes_a = [bytes(_BYTES[c] for c in LIBRARY.id_to_token(k)) for k in a]
    bytes_b = [bytes([int(PIECES.id_to_piece(k)[3:5], 16)]) if PIECES.is_byte(k) else PIECES.id_to_piece(k).replace("▁", " ").encode() for k in b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    ends_a, ends_b = (np.cumsum(list(map(len, x))).tolist() for x in (bytes_a, bytes_b))
    at = dict(zip(ends_b, b))
    links = [(x, at[e]) for x, e in zip(a, ends_a) if e in at]
    cuts = sorted(set(ends_a) & set(ends_b))
    per = [defaultdict(list), defaultdict(list)]
    for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
        for k, e in zip(ids, ends):
            per[side][int(np.searchsorted(cuts, e))].append(str(k))
    groups = [",".join(per[0][g]) + "|" + ",".join(per[1][g]) for g in range(len(cuts))]
    return a, b, groups, links


def expected(texts):
    found = [brute(t) for t in texts]
    counts = Counter(x for f in found if f for x in f[3])
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, groups, links = f
            out.append((len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), ";".join(groups)))
    return out


TEXTS = ODD + [mixed(k) for k in range(150)]


def frame(spark):
    rows = [(k, t, "x", "e") for k, t in enumerate(TEXTS)] + [(-1, None, None, None), (0, "", "x", "e"), (None, "a b", "x", "y"), (None, "a b", "x", "y")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_a string, Alignment string").repartition(5)


def test_odd_rows_both_ways(spark):
    docs = frame(spark)
    rows = docs.collect()
    want = Counter(zip([r.doc_id for r in rows], [r.n_a for r in rows], expected([r.text for r in rows])))
    assert sum(w[0] > 0 for _, _, w in want) > 60
    for held, shard in ((1 << 22, 1 << 17), (1 << 22, 50), (0, 50)):
        got = alignment.aligned(docs, held=held, shard=shard)
        assert got.columns == ["doc_id", "text", "n_a", "alignment"]
        assert Counter((r.doc_id, r.n_a, tuple(r.alignment)) for r in got.collect()) == want
        assert alignment.aligned(docs.limit(0), held=held).count() == 0
    assert alignment.aligned(docs.where("text IS NULL OR text = ''")).where("alignment.n_links = 0").count() == 3


def test_query_is_brute_force(spark, sf_dir, llm_queries):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in llm_queries["op13_token_alignment"](spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    for d, want in zip(texts, expected(list(texts.values()))):
        sha = hashlib.sha256(want[6].encode()).hexdigest() if want[0] else ""
        assert tuple(got[d])[1:] == (*want[:6], sha)


def test_slices_are_summed_as_a_tree(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").repartition(20)
    want = Counter((r.doc_id, tuple(r.alignment)) for r in alignment.aligned(docs).collect())
    monkeypatch.setattr(alignment, "SLICE", 1)
    monkeypatch.setattr(alignment, "FAN", 2)
    assert Counter((r.doc_id, tuple(r.alignment)) for r in alignment.aligned(docs, shard=1000).collect()) == want


@given(st.lists(st.integers(0, 1 << 62), max_size=400, unique=True))
@settings(max_examples=60, deadline=None)
def test_hash_is_perfect_and_minimal(keys):
    keys = np.array(keys, np.int64)
    hashes = alignment.PerfectHash.of(keys)
    assert sorted(hashes.index(keys).tolist()) == list(range(len(keys)))
    again = alignment.PerfectHash(hashes.sizes, hashes.words)
    assert (again.index(keys) == hashes.index(keys)).all()
    assert len(hashes.words) * 64 <= max(4096, 8 * len(keys))


def test_unknown_keys_count_nothing():
    keys = np.arange(0, 5000, 5, dtype=np.int64)
    hashes = alignment.PerfectHash.of(keys)
    ordered = np.empty_like(keys)
    ordered[hashes.index(keys)] = keys
    row = (0, hashes.sizes.tobytes(), hashes.words.tobytes(), ordered.tobytes(), (ordered + 1).tobytes())
    asked = np.arange(5000, dtype=np.int64)
    assert (alignment.Counts([row], 1, np.zeros(1)).of(asked) == np.where(asked % 5, 0, asked + 1)).all()


def test_pieces_are_those_of_the_whole_text():
    own = alignment.aligner(A, B)
    for k in range(3000):
        text = mixed(10_000 + k)
        want = brute(text)
        pieces = alignment._CUT.split(text)
        found = [own.aligned([p]) for p in pieces]
        if want is None:
            assert any(not x.pieces for x in found)
        else:
            assert ";".join(x.groups[0] for x in found) == ";".join(want[2])


def test_bounded_memory_of_pieces(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    known = alignment.remembered_links(alignment.aligner(A, B))
    texts = [" ".join(f"w{k}q{j}" for j in range(30)) + " " + "z" * 200 for k in range(40)]
    got = list(alignment.links_of(iter([texts]), known))
    assert all(len(p) <= alignment.KEPT for p in known.young)
    want = Counter(x for t in texts for x in brute(t)[3])
    assert {(int(k) >> 32, int(k) & 0xFFFFFFFF): int(n) for k, n in zip(*got[0])} == want


def test_texts_are_aligned_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for held in (1 << 22, 0):
        read = alignment.aligned(docs, held=held).inputFiles()
        assert any("/alignment-rows-" in f for f in read) and not any("documents.parquet" in f for f in read)


def test_links_of_sliced_rows(monkeypatch):
    monkeypatch.setattr(alignment, "LOOKED_UP", 3)
    texts = ["a b", None, "", "c d e f", "▁", "a b"]
    found = alignment.found_in([t or "" for t in texts], alignment.remembered_pieces(alignment.aligner(A, B)))
    want = expected([t or "" for t in texts])
    keys, n = alignment.binaries(found.field("links"))
    assert n.tolist() == [w[3] for w in want]
    keys, n = np.unique(keys, return_counts=True)
    best = np.zeros(1 << 16, np.int64)
    np.maximum.at(best, keys & 0xFFFFFFFF, n)
    counts = alignment.SomeCounts(keys, n, best)
    for lo, hi in ((0, 6), (1, 3), (2, 5), (3, 3)):
        got = alignment.results(found.slice(lo, hi - lo), counts).to_pylist()
        assert [tuple(r.values()) for r in got] == want[lo:hi]
