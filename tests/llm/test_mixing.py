"""Mixing: targets, apportionment and what is taken, against plain Python."""

import heapq
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from excursio.llm import mixing

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_targets(sizes: dict) -> dict:
    """Shares by weight; what is above a limit goes to the others, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full, left = set(), 1.5 * sum(sizes.values())
    while True:
        rest = left - sum(2 * sizes[s] for s in full)
        total = sum(weight[s] for s in order if s not in full)
        out = {s: 2.0 * sizes[s] if s in full else rest * weight[s] / total for s in order}
        above = {s for s in order if s not in full and out[s] > 2 * sizes[s]}
        if not above:
            return out
        full |= above


def brute_seats(votes: list[float], seats: int) -> list[int]:
    won = [0] * len(votes)
    heap = [(-v, k) for k, v in enumerate(votes) if v > 0]
    heapq.heapify(heap)
    for _ in range(seats):
        _, k = heap[0]
        won[k] += 1
        heapq.heapreplace(heap, (-votes[k] / (2 * won[k] + 1), k))
    return won


@pytest.mark.parametrize("votes,seats", [
    ([53, 24, 23], 7), ([10, 10, 10], 4), ([1, 1000, 0, 3], 50), ([5], 9), ([2, 2, 2, 2, 1], 0), ([7.5, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1], 6),
    ([k * k % 97 + 1 for k in range(60)], 1234), ([1e6] + [1] * 40, 500)])
def test_seats_go_to_the_highest_quotients(spark, votes, seats):
    rows = [(g, k, float(v), seats) for g in "ab" for k, v in enumerate(votes)]
    df = spark.createDataFrame(rows, "g string, k int, votes double, seats long")
    got = mixing.apportion(df, ["g"], ["k"], "votes", "seats", "won").orderBy("g", "k").collect()
    assert [r.won for r in got] == brute_seats(votes, seats) * 2


def test_targets_are_those_of_resharing(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 5, None: 70}, {"é": 0, "z": 10}, {"x": 0}, {f"s{k}": (k * 37) % 91 for k in range(40)}):
        df = spark.createDataFrame(list(sizes.items()), "source string, words long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def check(rows):
    """Sizes, targets, limits and nearness; rows of (source, mix, text)."""
    sizes, taken = Counter(), Counter()
    for r in rows:
        n = len(WORD.findall(r.text or ""))
        assert r.mix.size == n and 0 <= r.mix.taken <= 2 * n
        assert r.mix.taken == sum((s.end - s.begin) * s.times for s in r.mix.spans)
        assert all(0 <= s.begin < s.end <= n and 1 <= s.times <= 2 for s in r.mix.spans)
        sizes[r.source] += n
        taken[r.source] += r.mix.taken
    want = brute_targets(sizes) if sizes else {}
    for r in rows:
        assert r.mix.source_size == sizes[r.source] and r.mix.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * mixing.BLOCK, s


def test_query_comes_near_its_targets(spark, sf_dir, llm_queries):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(mixing.mixed(docs).collect())
    got = llm_queries["op11_source_mixing"](spark, sf_dir)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, llm_queries["op11_source_mixing"](spark, sf_dir).collect()))
    dealt = mixing.mixed(docs.select("doc_id", "source", "text").repartition(13), keep=["doc_id"])
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, dealt.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken").collect()))


def test_many_shards_come_as_near(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("source", F.when(F.col("doc_id") % 3 > 0, "hot").otherwise(F.col("source")))
    rows = mixing.mixed(docs, shard=1500, block=16).select("source", "text", "mix").collect()
    check(rows)
    assert len({r.mix.taken / r.mix.size for r in rows if r.mix.size}) > 10


def test_odd_rows(spark):
    rows = [(1, None, "a", None, "e"), (1, None, "a", None, "e"), (None, "", None, 1, None), (2, "word " * 90_000, "b", 1, "x"), (4, " \t\n", "c", 1, "x")]
    rows += [(3, "one two\vthree\ffour five", None, 7, "x")] * 400 + [(k, f"w{k} " * 7, "a", 7, "x") for k in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int, Mix string")
    got = mixing.mixed(docs)
    assert got.columns == ["doc_id", "text", "source", "size", "mix"]
    found = got.collect()
    assert Counter((r.doc_id, r.text, r.source, r.size) for r in found) == Counter(r[:4] for r in rows)
    check(found)
    assert mixing.mixed(docs.limit(0)).count() == 0
    assert mixing.mixed(docs.where("doc_id = 4 OR text IS NULL")).where("mix.taken = 0 AND mix.target = 0 AND size(mix.spans) = 0").count() == 3


def test_passages_are_the_words_taken(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    mix = mixing.mixed(docs)
    found = defaultdict(list)
    for r in mixing.passages(mix).collect():
        found[r.doc_id].append(r.passage)
    for r in mix.collect():
        words = WORD.findall(r.text or "")
        want = [" ".join(words[s.begin:s.end]) for s in r.mix.spans for _ in range(s.times)]
        assert sorted(found[r.doc_id]) == sorted(want)
        assert sum(len(p.split(" ")) for p in found[r.doc_id]) == r.mix.taken
