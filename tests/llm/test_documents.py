"""Operators on documents against brute force, and on rows that are odd in every way."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from excursio.llm import components, decontamination, lm_scoring, pii, quality_classifier, quality_rules, simhash, substring_dedup
from excursio.llm.shared import hash_shingles, hash_words, text_buffers, word_spans, SPACE_SEPARATED

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CLASHES = "fingerprint quality hits pii tokens encoding score lm n_words kept component_id _value id".split()


def odd_texts():
    rng = random.Random(3)
    words = ["the", "Of", "tion", "é", "ßer", "a", "on", "12", "x@y.zz", "!!", "###"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    return [None, "", " \n\t", "one", "one", "one two", long, long, long + " more", "a " * 4000, "x" * 20_000, "1" * 20_000,
            "line one here\nline one here\nother", "a b c d e f g a b c d e", "\x00 \x1f", "日本 語", "+1 (017) 555-7713 and a.b@c.dd",
            *[" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(25)]]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, long, tied and repeated rows, null ids, and columns that clash with the operators' own."""
    rows = [(k % 30, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else "s", *["v"] * len(CLASHES)) for k, t in enumerate(odd_texts())]
    rows += [rows[8], rows[8], (None, "null id", None, None, *[None] * len(CLASHES)), (None, None, None, None, *[None] * len(CLASHES))]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHES)).repartition(3)


def bag(rows):
    return Counter(map(repr, rows))


# --- shared helpers ---

@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t ", max_size=30)), max_size=12))
@settings(max_examples=60, deadline=None)
def test_words_and_hashes_of_a_batch(texts):
    import pyarrow as pa
    array = pa.array([None, *texts], pa.string()).slice(1)
    data, offsets = text_buffers(array)
    starts, ends, first = word_spans(data, offsets, SPACE_SEPARATED)
    raw = data.tobytes()
    got = [[raw[s:e].decode() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first, first[1:])]
    assert got == [SPACED.findall(t or "") for t in texts]
    hashes = hash_words(data, starts, ends, part=3).tolist()
    flat = [w for t in got for w in t]
    assert all((a == b) == (x == y) for a, x in zip(flat, hashes) for b, y in zip(flat, hashes))


def test_long_words_hash_alike_wherever_they_stand():
    data = np.frombuffer(b"x" * 1000 + b" y " + b"x" * 1000, np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), SPACE_SEPARATED)
    h = hash_words(data, starts, ends)
    assert h[0] == h[2] != h[1] and len(hash_shingles(h, 5)) == 0


# --- 1: quality rules ---

def base(text):
    words = SPACED.findall(text or "")
    windows = defaultdict(list)
    for k in range(len(words) - 4):
        windows[tuple(words[k : k + 5])].append(k)
    repeated = {p for at in windows.values() if len(at) > 1 for k in at for p in range(k, k + 5)}
    lines = [x for x in (text or "").split("\n") if SPACED.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated)


def test_base_values(odd):
    for r in quality_rules.measured(odd, out="base").collect():
        q = r.base
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == base(r.text)
        assert q.base_failed == (q.n_words < 10 or 100 * q.n_repeat_words > 20 * q.n_words)


def test_rules_keep_rows_columns_and_clean_texts(spark, odd):
    got = quality_rules.keep_good(odd)
    assert got.columns == odd.columns
    assert not bag(got.collect()) - bag(odd.collect())
    assert quality_rules.judge(odd.limit(0)).count() == 0 and quality_rules.judge(odd).count() == odd.count()
    rng = random.Random(1)
    clean = [(k, " ".join(rng.choice("alpha beta gamma delta of the on and in to".split()) + str(rng.randint(0, 99)) for _ in range(rng.randint(12, 400))), "en", f"s{k % 3}") for k in range(300)]
    junk = [(1000 + k, re.sub(" ", "### ", t[1]), "en", "s0") for k, t in enumerate(clean[:20])] + [(2000 + k, t[1].upper().replace(" ", "!! "), "en", "s1") for k, t in enumerate(clean[:20])]
    df = spark.createDataFrame(clean + junk, "doc_id bigint, text string, lang string, source string")
    assert {r.doc_id for r in quality_rules.keep_good(df).collect()} == set(range(300))


def test_sketches_merge_and_bound_their_error(spark):
    from pyspark.sql import functions as F
    df = spark.range(0, 200_000, 37).select(F.col("id").alias("v"))
    got = df.select("v", quality_rules.value_of(quality_rules.bucket_of(F.col("v"))).alias("w")).collect()
    assert all(r.w <= r.v <= r.w * (1 + 1 / 32) for r in got)


def test_rules_are_native(spark, sf_dir, llm_queries):
    plan = llm_queries["op1_quality_rules"](spark, sf_dir)._jdf.queryExecution().toString()
    measured = quality_rules.measured(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan + measured)


# --- 2: classifier ---

def test_held_out_accuracy(spark, llm_queries):
    sf_dir = "/root/testdata/sf0.01"
    df = llm_queries["op2_quality_classifier"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    rows = [r for r in df.collect() if r.held_out]
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_classifier_on_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (4, 0)], "doc_id bigint, quality int")
    w = quality_classifier.fitted(odd, labels)
    got = quality_classifier.scored(odd, w)
    assert got.count() == odd.count() and all(0 <= r.score <= 1 for r in got.collect())
    none = quality_classifier.fitted(odd, labels.limit(0))
    assert {r.score for r in quality_classifier.scored(odd, none).collect()} == {0.5}
    assert quality_classifier.scored(odd.limit(0), w).count() == 0


def test_classifier_features_do_not_cross_texts():
    import pyarrow as pa
    texts = ["a b", None, "c", "", "b b b !! x9"]
    together = [i[at[k] : at[k + 1]].tolist() for lo, hi, i, at in quality_classifier.features(pa.array(texts)) for k in range(hi - lo)]
    alone = [i[at[0] : at[1]].tolist() for t in texts for _, _, i, at in quality_classifier.features(pa.array([t], pa.string()))]
    assert together == alone and together[1] == [] and len(together[4]) == 10


# --- 3: LM scoring ---

def test_lm_losses_by_hand(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(1, "a b a b", True), (2, "c d", False), (3, None, None), (4, " ", True)], "doc_id bigint, text string, good boolean")
    models = lm_scoring.fitted(docs, F.col("good"))
    got = {r.doc_id: r.lm for r in lm_scoring.scored(docs, models).collect()}
    v, mix = models.vocabulary, lm_scoring.MIX
    loss = lambda pair, before, one, total: -np.log(mix * (pair / before if before else 0) + (1 - mix) * (one + 1) / (total + v))
    target = (loss(1, 2, 2, 4) + loss(2, 2, 2, 4) + loss(1, 2, 2, 4) + loss(2, 2, 2, 4)) / 4
    background = (loss(1, 4, 2, 6) + loss(2, 2, 2, 6) + loss(1, 2, 2, 6) + loss(2, 2, 2, 6)) / 4
    assert got[1].n_words == 4 and abs(got[1].target_loss - target) < 1e-6 and abs(got[1].background_loss - background) < 1e-6
    assert got[1].score < 0 < got[2].score and got[3].score == got[4].score == 0 and got[3].n_words == 0


def test_lm_on_odd_rows(odd):
    from pyspark.sql import functions as F
    models = lm_scoring.fitted(odd, F.lit(None).cast("boolean"))
    assert lm_scoring.scored(odd, models).count() == odd.count()
    assert lm_scoring.scored(odd.limit(0), lm_scoring.fitted(odd.limit(0), F.lit(True))).count() == 0


# --- 5: personal data ---

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 13 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0:
            out.append((2, m.start(), m.end()))
    return out + [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(re.findall("[0-9]", m.group())) <= 15]


@given(st.lists(st.sampled_from(["1", "22", ".", ".3", "@", "a", "b.c", "+", "-", " ", "(", "4", "5555", "é", "@x.y", "256", "0.", "4111 1111 1111 1111"]), max_size=30))
@settings(max_examples=300, deadline=None)
def test_base_spans(parts):
    assert pii.base_spans("".join(parts)) == brute_spans("".join(parts))


def test_base_spans_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for r in pii.found(docs).collect():
        assert [tuple(x) for x in r.pii.base] == brute_spans(r.text)


def test_patterns_find_unseen_identifiers(spark):
    rng = random.Random(2)
    rows = [(k, f"words here, reach me at user{k}@mail{k % 3}.example.com today") for k in range(20)]
    rows += [(100 + k, f"please call me on +1 (2{k:02d}) 555-01{k:02d} or not") for k in range(20)]
    rows += [(200, "so reach me at jdoe_4411 today"), (201, "please call me on 555 0199 222 or not"), (202, "chapter 20241 of reach 99887766")]
    rows += [(300 + k, " ".join(rng.choice("alpha beta gamma 20245 the".split()) for _ in range(50))) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for block in (pii.PATTERNS, 3):
        got = {r.doc_id: (r.text, [tuple(x) for x in r.pii.spans]) for r in pii.found(df, block=block).collect()}
        marked = {k: [(pii.KINDS[kind], t[s:e]) for kind, s, e in spans] for k, (t, spans) in got.items()}
        assert marked[200] == [("email", "jdoe_4411")] and marked[201] == [("phone", "555 0199 222")] and marked[202] == []
        assert all(not marked[300 + k] for k in range(30)) and all(len(marked[k]) == 1 for k in range(20))
    masked = {r.doc_id: r.text for r in pii.masked(df).collect()}
    assert masked[200] == "so reach me at <email> today" and masked[0].endswith("reach me at <email> today")


def test_pii_on_odd_rows(odd):
    got = pii.found(odd)
    assert got.count() == odd.count()
    for r in got.collect():
        assert [tuple(x) for x in r.pii.base] == brute_spans(r.text or "")
    assert pii.masked(odd).columns == odd.columns and pii.found(odd.limit(0)).count() == 0


def test_long_words_and_identifiers_are_compared_whole():
    a, b = ("w" * 50 + c + "w" * 50 for c in "xy")
    seen = lambda t: pii.patterns(t, t.index("9"), t.index("9") + 4, [t.index("9"), t.index("9") + 4])
    for text in ("far {} 9999 end", "{} by 9999 end", "far by 9999 {}"):
        assert set(seen(text.format(a))) & set(seen(text.format(b))) == (set(seen("far by 9999 .")[:1]) if text.endswith("{}") else set(
            seen("x by 9999 end")[1:]) if text.startswith("{}") else set())
    assert pii._short("1" * 100 + "2" + "1" * 100, 200) != pii._short("1" * 100 + "3" + "1" * 100, 200)


def test_many_identifiers_without_white_space(spark):
    """A run of 20,000 addresses is read in about linear time."""
    text = "mail: " + ",".join(f"a{k}@b.cc" for k in range(20_000))
    row = pii.found(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert len(row.pii.base) == 20_000


def test_unigram_masses_sum_to_one(spark):
    texts = [("a b a c", True), ("a d", False), ("e e e", False)]
    models = lm_scoring.fitted(spark.createDataFrame(texts, "text string, good boolean"), F.col("good"))
    words = models.words.collect()
    for m, column in ((0, "n0"), (1, "n1")):
        total = models.sums[m] + models.vocabulary
        assert sum((r[column] + 1) / total for r in words) + 1 / total == pytest.approx(1)
    assert models.vocabulary == 6


# --- 6: decontamination ---

def brute_hits(docs, items):
    windows = defaultdict(set)
    for i, text in items:
        words = PLAIN.findall((text or "").translate(LOWER))
        n = min(13, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k : k + n])].add(i)
    sizes = {len(w) for w in windows}
    out = []
    for text in docs:
        words, hit, found = PLAIN.findall((text or "").translate(LOWER)), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if ids := windows.get(tuple(words[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= {str(i) for i in ids if i is not None}
        out.append((len(words), sorted(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block_bytes", [decontamination.BLOCK_BYTES, 200])
def test_hits(spark, odd, block_bytes):
    items = [(1, "One two!"), (2, "a B c d e"), (2, "the of"), (3, None), (4, "..."), (None, "one"), (10, " ".join(odd_texts()[20].split()[:20])), (11, "é")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontamination.scanned(odd, bench, block_bytes=block_bytes).select("text", "hits").collect()
    want = brute_hits([r.text for r in rows], items)
    assert [(r.hits.n_words, r.hits.words, r.hits["items"]) for r in rows] == want
    left = decontamination.without_benchmark(odd, bench, block_bytes=block_bytes)
    clean = [r.text for r, (n, hit, _) in zip(rows, want) if not (hit and 20 * len(hit) >= n)]
    assert left.columns == odd.columns and bag(r.text for r in left.collect()) == bag(clean)
    assert decontamination.without_benchmark(odd, bench.limit(0)).count() == odd.count()
    assert decontamination.scanned(odd.limit(0), bench).count() == 0


def test_windows_take_little_memory():
    import tracemalloc

    rng = np.random.default_rng(5)
    items = [(str(k), " ".join(f"w{x}" for x in rng.integers(0, 60_000, 200))) for k in range(900)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    held = decontamination.Windows(items)
    kept, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(held.by_size[13].hashes) == 900 * 188
    assert kept < 12 * size and most < 40 * size


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    """All windows meet under one hash; the words decide."""
    monkeypatch.setattr(decontamination, "hash_shingles", lambda words, size: np.zeros(max(len(words) - size + 1, 0), np.uint64))
    items = [("a", "x y z"), ("b", "p q r"), (None, "k l m"), ("c", "x y z"), ("a", "x y z")]
    got = decontamination.Windows(items).scan(pa.array(["o p q r x y z", "k l m n", "y z x", None, ""]))
    assert [(n, w.tolist(), sorted(i)) for n, w, i in got] == [
        (7, [1, 2, 3, 4, 5, 6], ["a", "b", "c"]), (4, [0, 1, 2], []), (3, [], []), (0, [], []), (0, [], [])]


def test_spans_are_cut(spark):
    docs = spark.createDataFrame([(1, "keep this. One, two three! And that"), (2, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    got = decontamination.without_benchmark(docs, bench, spans=True).collect()
    assert {r.doc_id: r.text for r in got} == {1: "keep this. ! And that", 2: None}


# --- 8: passages ---

@given(st.lists(st.integers(0, 9), min_size=1, max_size=30), st.integers(1, 6))
@settings(max_examples=150, deadline=None)
def test_windows_hold_every_passage_once(values, least):
    v = np.array(values, np.uint64)
    cover = Counter()
    for c, lo, hi in zip(*substring_dedup.compact_windows(v, np.array([0]), np.array([len(v)]), least)):
        for i in range(lo, c + 1):
            for j in range(max(c, i + least - 1), hi + 1):
                cover[i, j] += 1
                assert v[i : j + 1].min() == v[c]
    assert cover == Counter((i, j) for i in range(len(v)) for j in range(i + least - 1, len(v)))


def test_every_shared_passage_is_found(spark, llm_queries):
    sf_dir = "/root/testdata/sf0.01"
    where = defaultdict(set)
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words = SPACED.findall(r.text.translate(LOWER))
        for k in range(len(words) - 49):
            where[tuple(words[k : k + 50])].add(r.doc_id)
    rows = llm_queries["op8_substring_dedup"](spark, sf_dir).collect()
    found = {r.doc_id for r in rows}
    assert found == {r.other_id for r in rows} and Counter((r.doc_id, r.other_id) for r in rows) == Counter((r.other_id, r.doc_id) for r in rows)
    assert {d for ids in where.values() if len(ids) > 1 for d in ids} <= found
    assert all(r.similarity >= 0.8 and r.end - r.begin >= 50 and r.doc_id != r.other_id for r in rows)
    parent = {d: d for d in found}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in rows:
        a, b = root(r.doc_id), root(r.other_id)
        parent[max(a, b)] = min(a, b)
    assert all(len({root(d) for d in ids}) == 1 for ids in where.values() if len(ids) > 1)


def test_near_passages_and_clean_texts(spark, odd):
    rng = random.Random(5)
    text = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    passage = text(120)
    near = passage[:60] + ["other"] + passage[61:]
    rows = [(k, " ".join(text(80) + passage + text(40))) for k in range(30)] + [(100, " ".join(text(30) + near + text(200)))]
    rows += [(200 + k, " ".join(text(300))) for k in range(20)] + [(300, " ".join(text(50) + passage[:30] + text(50)))]
    got = substring_dedup.passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert {r.doc_id for r in got} == {*range(30), 100}
    assert substring_dedup.passages(odd.limit(0)).count() == 0
    assert all(r.similarity >= 0.8 for r in substring_dedup.passages(odd).collect())


# --- 9: SimHash ---

def brute_fingerprint(text):
    words = SPACED.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_roots(prints, most=3):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i + 1, len(prints)):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_fingerprints_and_components(odd):
    rows = odd.select("doc_id", "text").collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    roots = brute_roots(prints)
    ids = defaultdict(list)
    for r, k in zip(rows, roots):
        ids[k].append(r.doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    want = Counter((r.doc_id, f"{p:016x}", least[k]) for r, p, k in zip(rows, prints, roots))
    assert Counter(tuple(r) for r in simhash.near_duplicates(odd).collect()) == want
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == len(least)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least.values())
    assert simhash.near_duplicates(odd.limit(0)).count() == simhash.keep_one(odd.limit(0)).count() == 0


@pytest.mark.parametrize("size", [4, simhash.GROUP])
def test_trie_links_dense_and_sparse_prints(spark, size):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(60)]
    prints = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 5))) & (1 << 64) - 1 for c in centres for _ in range(12)}
    prints |= {0xABCD << 48 | rng.getrandbits(9) for _ in range(200)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.linked_fingerprints(spark.createDataFrame([(p,) for p in signed], "fingerprint bigint").repartition(3), size)
    got = {r.a: r.b for r in components.components(edges).collect()}
    classes = defaultdict(set)
    for k, root in enumerate(brute_roots(prints)):
        classes[root].add(signed[k])
    want = {x: min(c) for c in classes.values() for x in c if x != min(c)}
    assert got == want


def test_components_of_a_long_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(60)]
    star = [(1000, 1000 + k) for k in range(1, 200)]
    edges = spark.createDataFrame([(b, a) for a, b in path] + star + [(5, 5), (None, 3), (7, 6)], "a bigint, b bigint")
    got = {r.a: r.b for r in components.components(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, **{1000 + k: 1000 for k in range(1, 200)}}
    assert components.components(edges.limit(0)).count() == 0


def test_targets_by_broadcast_or_shuffle(spark, odd):
    from pyspark.sql import functions as F
    ids = spark.createDataFrame([(1,), (1,), (None,), (9,)], "id bigint")
    docs = odd
    a = lm_scoring.marked(docs, ids).collect()
    assert bag(a) == bag(lm_scoring.marked(docs, ids, most=0).collect())
    assert len(a) == odd.count() and sum(r.target for r in a) == docs.where(F.col("doc_id").isin(1, 9)).count()


def test_passages_unlike_the_first_of_their_group(spark):
    rng = random.Random(7)
    text = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    rows, pairs = [], []
    for k in range(0, 3000, 100):  # passages of 50 words around a phrase of 42 that other texts have as well
        phrase = text(42)
        for j in (k + 50, k + 60, k + 70):
            passage = text(4) + phrase + text(4)
            rows += [(j + i, " ".join(text(40) + passage + text(40))) for i in (0, 1)]
            pairs.append({j, j + 1})
        rows += [(k + i, " ".join(text(40) + phrase + text(40))) for i in range(20)]
    base = text(60)  # a leader with the outer words of both changed: alike are only the two others
    variant = base[:20] + text(14) + base[34:]
    rows += [(5000, " ".join(base)), (5001, " ".join(variant)), (5002, " ".join(variant[:-1] + ["end"]))]
    got = substring_dedup.passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    met = {frozenset((r.doc_id, r.other_id)) for r in got}
    assert met == {*map(frozenset, pairs), frozenset((5001, 5002))}


def test_passages_with_a_run_of_words_inserted(spark):
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    rows = []
    for k in range(0, 400, 2):
        passage = text(80)
        rows += [(k, " ".join(passage)), (k + 1, " ".join(passage[:40] + text(7) + passage[40:]))]
    rows += [(1000, " ".join(w := text(80))), (1001, " ".join(w[:40] + text(16) + w[40:]))]  # 72 of 96 shingles
    got = substring_dedup.passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert {(r.doc_id, r.other_id) for r in got} == {(k, k ^ 1) for k in range(400)}
    for r in got:
        assert 72 / 87 - 1e-9 <= r.similarity and {r.end - r.begin, r.other_end - r.other_begin} == {80, 87}


def test_shingles_alike_against_brute_force():
    rng = random.Random(9)
    for _ in range(60):
        a = [rng.randint(0, 10**9) for _ in range(rng.randint(20, 40))]
        b = a[:]
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(b))
            b[at : at + rng.randint(0, 3)] = [rng.randint(0, 10**9) for _ in range(rng.randint(0, 4))]
        least = 12
        best = any(
            (n := sum((Counter(a[i:j]) & Counter(b[k:m])).values())) >= 0.8 * (j - i + m - k - n)
            for i in range(len(a)) for j in range(i + least, len(a) + 1) for k in range(max(0, i - 9), min(len(b), i + 10)) for m in range(k + least, min(len(b), k + j - i + 9) + 1))
        got = substring_dedup.alike(np.array(a, np.uint64), np.array(b, np.uint64), [0], least, 0.8)
        assert bool(got) == best
        assert all(hi - lo + 1 >= least and upto - to + 1 >= least and sim >= 0.8 and 0 <= lo and hi < len(a) and 0 <= to and upto < len(b) for lo, hi, to, upto, sim in got)


def test_lm_counts_keep_pairs_apart(spark):
    from pyspark.sql import functions as F
    n = 20_000  # with a fixed number of buckets, many of these words and pairs would be counted together
    docs = spark.createDataFrame([(k, " ".join(f"x{k * 100 + i}" for i in range(100)), k == 0) for k in range(n // 10)] + [(-1, "y z y z", False)],
                                 "doc_id bigint, text string, good boolean")
    models = lm_scoring.fitted(docs, F.col("good"))
    assert models.losses.count() == n * 10 + 3 and models.words.count() == n * 10 + 2
    one = -np.log(lm_scoring.MIX + (1 - lm_scoring.MIX) * 2 / (n * 10 + 4 + models.vocabulary))
    first = -np.log(lm_scoring.MIX / (n // 10 + 1) + (1 - lm_scoring.MIX) * 2 / (n * 10 + 4 + models.vocabulary))
    for r in lm_scoring.scored(docs, models).where("doc_id >= 0").select("doc_id", "lm.*").collect():
        assert r.n_words == 100 and abs(r.background_loss - (99 * one + first) / 100) < 1e-9
    new = lm_scoring.scored(spark.createDataFrame([("z x5 q",)], "text string"), models).first().lm  # pairs never counted
    base = lambda c: -np.log((1 - lm_scoring.MIX) * (c + 1) / (n * 10 + 4 + models.vocabulary))
    assert abs(new.background_loss - (base(2) + base(1) + base(0)) / 3) < 1e-9


def test_trust_goes_on_until_nothing_is_labelled(spark):
    sizes, rows = [600, 255, 107, 43, 16, 0], []
    for k in range(5):  # the instances of a pattern get their labels by the pattern before
        rows += [(f"p{k}", f"i{k}_{i}", "email" if k == 0 else None) for i in range(sizes[k])]
        rows += [(f"p{k}", f"i{k + 1}_{i}", None) for i in range(sizes[k + 1])]
    graph = spark.createDataFrame(rows, "pattern string, instance string, kind string")
    assert {(r.pattern, r.kind) for r in pii.trusted_patterns(graph).collect()} == {(f"p{k}", "email") for k in range(5)}
    assert pii.trusted_patterns(graph.limit(0)).count() == 0


def test_lm_in_slices_of_few_bytes(spark, monkeypatch):
    """How counts and texts are dealt changes no loss, and a pair's counts take a few bytes."""
    import os
    from urllib.parse import urlparse
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(200)) + f" only{k}", k % 3 == 0) for k in range(300)]
    docs = spark.createDataFrame(rows + [(1000 + k, *rows[0][1:]) for k in range(20)], "doc_id bigint, text string, good boolean").repartition(4)
    found = []
    for slice_bytes, group_bytes in ((lm_scoring.SLICE, lm_scoring.GROUP), (1 << 14, 1 << 13)):
        monkeypatch.setattr(lm_scoring, "SLICE", slice_bytes, raising=False)
        monkeypatch.setattr(lm_scoring, "GROUP", group_bytes, raising=False)
        models = lm_scoring.fitted(docs, F.col("good"))
        found.append({r.doc_id: tuple(r.lm) for r in lm_scoring.scored(docs, models).collect()})
        if slice_bytes > 1 << 20:
            files = [urlparse(f).path for f in models.losses.inputFiles()]
            assert sum(map(os.path.getsize, files)) < 6 * models.losses.count()
        else:  # more text than the models' corpus
            again = lm_scoring.scored(docs.union(docs).union(docs), models)
            assert {r.doc_id: tuple(r.lm) for r in again.collect()} == found[1] and again.count() == 960
    assert found[0] == found[1] and len(found[0]) == 320 and found[0][0] == found[0][1005]


def test_lm_numbers_of_pairs_are_distinct():
    words = np.sort(hash_words(np.frombuffer(b"abcdefgh", np.uint8), np.arange(8), np.arange(1, 9)))
    frequent, text = words[1::2], np.concatenate([np.repeat(words, 8), np.tile(words, 8)]).reshape(2, -1).T.ravel()
    first = np.append(np.arange(0, len(text), 2), len(text))
    keys, short = lm_scoring.pair_keys(text, np.arange(len(text), dtype=np.uint64), first, frequent)
    assert short[1::2].tolist() == [a in frequent and b in frequent for a, b in text.reshape(-1, 2)]
    assert len(set(keys[1::2][short[1::2]])) == 16 and len(set(keys[::2][short[::2]])) == 4
    packed = lm_scoring._packed_keys(np.sort(keys))
    assert lm_scoring._unpacked_keys(packed).tolist() == sorted(keys.tolist())


def test_passage_of_repeated_shingles_on_the_diagonal_of_its_link():
    """Other chains are as long as the unbroken one, but spread wider."""
    line = [100, 101, 102]
    a = [7, 6, 9, 4, 200, 201] + line * 3 + [100, 101, 3, 8, 1, 2] + line
    b = [17, 19, 15, 18, 16] + line * 3 + [100, 101]
    (lo, hi, to, upto, similarity), = substring_dedup.alike(np.array(a, np.uint64), np.array(b, np.uint64), [1], 12, 0.8)
    assert (hi, upto) == (17, 15) and hi - lo >= 11 and upto - to >= 11 and similarity == pytest.approx(11 / 13)


def test_no_chain_is_looked_for_where_few_shingles_meet(monkeypatch):
    monkeypatch.setattr(substring_dedup, "matched", lambda *a: pytest.fail("a chain is looked for"))
    a, b = np.arange(300, dtype=np.uint64), np.arange(260, 560, dtype=np.uint64)
    assert substring_dedup.alike(a, b, [260], 46, 0.8) == []
    assert substring_dedup.alike(np.repeat(a[:1], 300), b, [0], 46, 0.8) == []


@given(st.lists(st.integers(0, 9), max_size=30), st.lists(st.integers(0, 9), max_size=30))
@settings(max_examples=150, deadline=None)
def test_equal_shingles_meet_by_rank(a, b):
    met = substring_dedup.meeting(np.array(a, np.uint64), np.array(b, np.uint64))
    pairs, both = list(zip(met.i.tolist(), met.j.tolist())), Counter(a) & Counter(b)
    assert [x for x, _ in pairs] == sorted({x for x, _ in pairs}) and len({y for _, y in pairs}) == len(pairs)
    assert all(a[x] == b[y] and a[:x].count(a[x]) == b[:y].count(b[y]) for x, y in pairs) and Counter(a[x] for x, _ in pairs) == both
    assert met.free.tolist() == [x not in b for x in a] and met.once == all(a.count(x) == b.count(x) == 1 for x in both)


def test_shuffles_of_passages_are_dropped(spark):
    import time
    rng = random.Random(9)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(90)]
    df = spark.createDataFrame([(k, " ".join(words[k:] + [str(k)])) for k in range(9)], "doc_id bigint, text string").repartition(3)
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for f in manager.getAllFiles().mkString("\n").split("\n") if f.endswith(".data") and "shuffle_" in f}

    before = files()
    found = substring_dedup.passages(df)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert found.count() > 0 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_links_are_verified_once(spark, monkeypatch):
    import functools
    verified = spark.sparkContext.accumulator(0)
    arrow_udf = substring_dedup.arrow_udf

    def counted(fn, returned):
        @functools.wraps(fn)
        def run(*columns):
            if fn.__name__ == "verify":
                verified.add(len(columns[0]))
            return fn(*columns)
        return arrow_udf(run, returned)

    monkeypatch.setattr(substring_dedup, "arrow_udf", counted)
    text = " ".join(f"w{k}" for k in range(80))
    rows = substring_dedup.passages(spark.createDataFrame([(1, text), (2, text + " end")], "doc_id bigint, text string")).collect()
    assert {(r.doc_id, r.other_id, r.begin, r.end) for r in rows} == {(1, 2, 0, 80), (2, 1, 0, 80)}
    assert verified.value == 1
