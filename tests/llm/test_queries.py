"""Whole queries that SQL does not express, against brute force over the small table."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from excursio.llm import lm_scoring
from test_documents import brute_fingerprint, brute_roots, brute_spans


def documents(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def test_op2_folds_and_decisions(spark, sf_dir, llm_queries):
    rows = llm_queries["op2_quality_classifier"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(documents(spark, sf_dir))
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op3_counts_and_losses(spark, sf_dir, llm_queries):
    texts = documents(spark, sf_dir)
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.quality == 1 and r.toxic == 0}
    found = {}
    for d, text in texts.items():
        parts = list(lm_scoring.buckets(pa.array([text], pa.string())))
        found[d] = [(w, p) for _, _, words, pairs, _ in parts for w, p in zip(words.tolist(), pairs.tolist())]
    losses = []
    for chosen in (good, set(texts)):
        words, pairs, starts = Counter(), Counter(), 0
        for d in chosen & set(texts):
            words.update(w for w, _ in found[d])
            pairs.update(p for _, p in found[d])
            starts += 1
        total, out = sum(words.values()), {}
        for d, own in found.items():
            each, before = [], starts
            for w, p in own:
                share = min(pairs[p], before) / before if before else 0
                each.append(-np.log(lm_scoring.MIX * share + (1 - lm_scoring.MIX) * (words[w] + 1) / (total + lm_scoring.WORDS)))
                before = words[w]
            out[d] = np.mean(each) if each else 0
        losses.append(out)
    for r in llm_queries["op3_lm_scoring"](spark, sf_dir).collect():
        assert r.n_words == len(found[r.doc_id])
        assert abs(r.target_loss - losses[0][r.doc_id]) < 1e-5 and abs(r.background_loss - losses[1][r.doc_id]) < 1e-5
        assert abs(r.score - (r.target_loss - r.background_loss)) < 1e-9


def test_op5_counts_and_digests(spark, sf_dir, llm_queries):
    texts, kinds = documents(spark, sf_dir), ("email", "ip", "card", "phone")
    rows = llm_queries["op5_bootstrapped_pii"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute_spans(texts[r.doc_id])
        counts = Counter(k for k, _, _ in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [counts[k] for k in range(4)]
        joined = [f"{kinds[k]}:{s}:{e}" for k, s, e in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(r.spans.split(",")) | {""}


def test_op9_components(spark, sf_dir, llm_queries):
    texts = documents(spark, sf_dir)
    ids = sorted(texts)
    prints = [brute_fingerprint(texts[d]) for d in ids]
    least = defaultdict(lambda: None)
    for d, root in zip(ids, brute_roots(prints)):
        least[root] = d if least[root] is None else min(least[root], d)
    want = {(d, f"{p:016x}", least[k]) for d, p, k in zip(ids, prints, brute_roots(prints))}
    assert {tuple(r) for r in llm_queries["op9_simhash_near_duplicates"](spark, sf_dir).collect()} == want
