"""The pipeline against plain Python, stage by stage."""

import re
from collections import Counter

from tokenizers import Tokenizer
import public_tokenizers

import corpus_pipeline
from test_documents import brute_fingerprint, brute_hits, brute_roots, brute_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def bag(rows):
    return Counter(tuple(r) for r in rows)


def test_stages_one_by_one(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    outs = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        outs.append((before.collect(), docs.collect()))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    given, kept = outs[0]
    assert not bag(kept) - bag(given)
    gone = {r.doc_id for r in given} - {r.doc_id for r in kept}
    assert {d for d, q in labels.items() if q == 0} <= gone
    given, kept = outs[1]
    roots = brute_roots([brute_fingerprint(r.text) for r in given])
    least = {}
    for r, k in zip(given, roots):
        least[k] = min(least.get(k, r), r, key=lambda x: x.doc_id)
    assert bag(kept) == bag(least.values())
    given, kept = outs[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = [r for r, (n, hit, _) in zip(given, brute_hits([r.text for r in given], items)) if not (hit and 20 * len(hit) >= n)]
    assert bag(kept) == bag(clean)
    given, masked = outs[3]
    texts = {r.doc_id: r.text for r in masked}
    assert len(given) == len(masked)
    for r in given:
        spans = brute_spans(r.text)
        if spans:
            assert not brute_spans(texts[r.doc_id]) and re.search("<(email|ip|card|phone)>", texts[r.doc_id])
        else:
            assert texts[r.doc_id] == r.text
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    given, coded = outs[4]
    texts = {r.doc_id: r.text for r in given}
    assert len(coded) == len(texts)
    assert all(list(r.token_ids) == library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in coded)
    assert bag(corpus_pipeline.run(spark, sf_dir).drop("token_ids").collect()) == bag(docs.drop("token_ids").collect())


def test_stages_take_odd_rows(spark, sf_dir):
    rows = [(1, None, None, None, None, "e"), (1, None, None, None, None, "e"), (None, "", "en", "s", 0, None), (2, "word " * 5000, "en", "s", 1, "x"),
            (3, " ".join(f"w{k}" for k in range(3000)), "en", "s", 1, "x"), (3, " ".join(f"w{k}" for k in range(3000)), "en", "s", 1, "x"),
            (4, " ".join(f"v{k}" for k in range(300)) + "\n" + "—" * 400 + "\n" + "ab" + "na" * 150, "en", "s", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, n_tokens string")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert {"doc_id", "text", "lang", "source", "n_chars"} <= set(out.columns) and out.count() <= docs.count()
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    out = docs
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, sf_dir)
    assert {r.doc_id for r in out.collect()} == {3, 4}
