"""BPE encoding and token counts against the libraries themselves."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from excursio.llm import bpe, token_counts

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(WORD)
PIECES = sentencepiece.SentencePieceProcessor(model_file=PIECE)

ODD = [
    "", " ", "  a  b   ", "a" * 3000, "aaabbb" * 400, "the" * 2000 + " end", "x<|startoftext|>y <|endoftext|> <|start",
    "É̀ ΑΣ İi ŉ", "l'été don't we'll THEY'VE 's's" * 20, "１２３" * 60, "!!!???" * 50,
    "日本語のテキスト" * 60, "a\x1cb \x85c　d e", "́a ́", "\U0001f600\U0001f469‍\U0001f467" * 30,
    "abc\x00def", "▁▁ a▁b", "\n\n x\ty\r\n", "<s> </s> <unk> <0x41>", "=" * 40 + "-" * 33, "a line of dashes " + "—" * 70,
]


def mixed(seed: int) -> str:
    rng = random.Random(seed)
    return "".join(rng.choice(["the", "tion", "ing", "un", "▁", " ", "  ", "x", "Zz", "'s", "9", "%%", "é", "日", " represent"]) for _ in range(300))


TEXTS = ODD + [mixed(k) for k in range(15)] + ["".join(random.Random(n).choice("abehtionrs") for _ in range(n)) for n in (63, 64, 65, 129, 5000)]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_bpe_is_the_library(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    got = np.frombuffer(bpe.encoder(WORD).encode([text])[0], np.int32).tolist()
    assert got == want
    assert bpe.decoded(WORD, got) == LIBRARY.decode(want, skip_special_tokens=False)


@given(st.text(alphabet="abehtinorsw", min_size=1, max_size=400))
@settings(max_examples=60, deadline=None)
def test_tree_is_plain_bpe(text):
    merges = bpe.encoder(WORD).merges or bpe.Merges(WORD)
    bpe.encoder(WORD).merges = merges
    symbols = merges.symbols(text)
    assert merges.tree(symbols) == merges.merged(symbols)


def repeats():
    """Runs of one to four symbols that a line may be drawn with, and letters that merge far."""
    rng = random.Random(3)
    signs = [chr(c) for c in (*range(33, 127), *range(0xA1, 0xC0), 0x2014, 0x2022, 0x2764, 0x2500, 0x4E2D, 0x1F600, *range(0x430, 0x450), *range(0x3B1, 0x3C0))]
    runs = [*signs, *("".join(rng.choice(signs) for _ in range(n)) for n in (2, 3, 4) for _ in range(20)), "na", "ah", "aha", "ab", "the"]
    return [(run * n)[:n] for run in runs for n in (65, 66, 80, 131, 400)] + ["ab" + run * 150 for run in ("na", "ah", "—")] + ["—" * 5000, "na" * 2500]


def test_repeats_are_the_library():
    texts = repeats()
    found = bpe.encoder(WORD).encode(texts)
    for text, raw in zip(texts, found):
        assert np.frombuffer(raw, np.int32).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, text[:10]


@given(st.text(alphabet="abehtinorsw—", max_size=300))
@settings(max_examples=80, deadline=None)
def test_heap_is_plain_bpe(text):
    merges = bpe.encoder(WORD).merges or bpe.Merges(WORD)
    bpe.encoder(WORD).merges = merges
    symbols = merges.symbols(text) if text else []
    assert merges.queued(symbols) == merges.merged(symbols)


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_counts_are_the_library(text, chunk):
    assert transducer().count(text, chunk) == len(PIECES.encode(text))


def transducer() -> token_counts.Transducer:
    if PIECE not in token_counts._TRANSDUCERS:
        token_counts._TRANSDUCERS[PIECE] = token_counts.Transducer(PIECE)
    return token_counts._TRANSDUCERS[PIECE]


@given(st.lists(st.text(alphabet="ab the▁\n", max_size=12), min_size=3, max_size=3))
@settings(max_examples=80, deadline=None)
def test_chunk_maps_compose_associatively(parts):
    t = transducer()
    a, b, c = (t.chunk_map(p.replace(" ", "▁")) for p in parts)

    def total(m):
        return t.read(t.start, "▁" + m.head)[1] + (m.total or 0)

    assert total(t.composed(t.composed(a, b), c)) == total(t.composed(a, t.composed(b, c)))


def test_queries_on_odd_rows(spark):
    rows = [(k, text, "x", "y") for k, text in enumerate(TEXTS)] + [(-1, None, None, None), (0, "", "x", "y"), (None, "a b", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, encoding string, tokens string")
    got = bpe.encoded(docs)
    assert got.columns == ["doc_id", "text", "tokens", "encoding"]
    for r in got.collect():
        want = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.encoding.ids) == want and r.encoding.decoded == LIBRARY.decode(want, skip_special_tokens=False)
    for r in token_counts.counted(docs).collect():
        assert r.tokens.n_tokens == len(PIECES.encode(r.text or "")) and r.tokens.n_bytes == len((r.text or "").encode())
        assert r.tokens.over_limit == (r.tokens.n_tokens > 4096)
    assert bpe.encoded(docs.limit(0)).count() == token_counts.counted(docs.limit(0)).count() == 0


def test_op10_and_op4_over_the_whole_table(spark, llm_queries, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = llm_queries["op10_bpe_encoding"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == sha(LIBRARY.decode(ids, skip_special_tokens=False))
    got = llm_queries["op4_token_counts"](spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {k: len(PIECES.encode(t)) for k, t in texts.items()}


def test_tables_stay_small_on_long_words(monkeypatch):
    monkeypatch.setattr(token_counts, "STATES", 40)
    monkeypatch.setattr(token_counts, "WORDS", 10)
    t = token_counts.Transducer(PIECE)
    for k, text in enumerate(["".join(random.Random(1).choice("abehtionrs") for _ in range(4000)), *TEXTS[-8:]]):
        assert t.count(text, 64) == len(PIECES.encode(text)) and len(t.rows) <= 42, k
    assert all(len(w) <= token_counts.KEPT for w in t.words)
    own = bpe.Encoder(WORD)
    own.encode(["x" * 500 + " ab " + "y" * 70])
    assert all(len(c) <= bpe.CHUNK for c in own.young)
