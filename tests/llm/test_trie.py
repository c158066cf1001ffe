"""Conversation tries and subtree sums against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from excursio.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, n_convs int"


def brute_trie(rows, rank=lambda r: (r[1] is not None, r[1] or 0)):
    """Rows of the contract from (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            turns[r[0]].append(r)
    turns = {c: [(r[2] or "", r[3] or "") for r in sorted(v, key=rank)] for c, v in turns.items()}
    nodes, members, ends, above, saved = {}, defaultdict(list), defaultdict(list), {0: None}, Counter()
    depth, last = {0: 0}, {0: 0}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = turns.get(c - int(math.fmod(c, 5)), [])
        at = 0
        members[0].append(c)
        for step in base[:h] + own[h:]:
            before, at = at, nodes.setdefault((at, step), len(nodes) + 1)
            above[at], depth[at], last[at] = before, depth[before] + 1, len(step[1].encode())
            members[at].append(c)
        ends[at].append(c)
    children = Counter(p for p in above.values() if p is not None)
    leaves = Counter()
    for p in members:
        up = p
        while up is not None:
            leaves[up] += children[p] == 0
            saved[up] += (len(members[p]) - 1) * last[p]
            up = above[up]
    return Counter(
        (min(own), depth[p], min(members[above[p]]) if p else None, len(own), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, own in members.items())


def got(df):
    assert df.columns == ["node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(tuple(r)[2:] for r in df.collect())


def talks(seed, n, texts=("hi", "", "é—", None, "a longer answer"), longest=12):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for t in range(rng.choice([1, 2, 3, longest])):
            out.append((c * rng.choice([1, 1, 1, 7]) if seed % 2 else c, t if t else None, rng.choice(["user", "bot", None]) if t else "user", rng.choice(texts), "x", 1))
    seen, unique = set(), []
    for r in out:
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            unique.append(r)
    return unique


@pytest.mark.parametrize("seed,n,fragment", [(0, 60, 1 << 14), (1, 90, 60), (2, 150, 150)])
def test_trie_is_brute_force(spark, seed, n, fragment):
    rows = talks(seed, n)
    assert got(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(4), fragment=fragment)) == brute_trie(rows)


def test_hot_conversations_and_odd_rows(spark):
    # one conversation of a third of the rows, copies of one, a turn that most share, ids that are negative, missing bases, no ids
    rows = [(10, t, "user", f"t{t}", "x", 1) for t in range(2500)]
    rows += [(100 + c, t, "user", ["first", "second", "third"][t], "x", 1) for c in range(600) for t in range(3)]
    rows += [(5000 + 5 * c, 0, "user", "first", "x", 1) for c in range(300)] + [(5000 + 5 * c, 1, "bot", f"r{c % 7}", "x", 1) for c in range(300)]
    rows += [(-7, 0, "user", "neg", "x", 1), (-5, 0, "user", "base", "x", 1), (-5, None, "", "", "x", 1), (9004, 0, "user", "alone", "x", 1)]
    rows += [(None, 0, "user", "nobody", "x", 1), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    want = brute_trie(rows)
    assert got(prefix_trie.trie(df)) == want
    assert got(prefix_trie.trie(df, fragment=1500)) == want
    assert prefix_trie.trie(df.limit(0)).count() == 0
    assert prefix_trie.trie(df.where("conv_id IS NULL")).count() == 0


def test_repeated_rows_are_turns(spark):
    rows = [(0, 0, "user", "again", "x", 1)] * 40 + [(0, 1, "bot", "yes", "x", 1)] + [(2, 0, "user", "again", "x", 1)] * 3
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(prefix_trie.trie(df, fragment=6)) == brute_trie(rows)
    # equal numbers: in the order of hashes, whatever the partitions are
    rows = [(0, 0, "user", f"t{k}", "x", 1) for k in range(9)]
    assert got(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA))) == got(prefix_trie.trie(spark.createDataFrame(rows[::-1], SCHEMA).repartition(4)))


def test_very_long_texts_and_conversations(spark):
    rows = [(0, t, "user", "ü" * (200_000 if t == 3 else 2), "x", 1) for t in range(3000)] + [(1, t, "user", "ü" * 2, "x", 1) for t in range(2100)]
    assert got(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), fragment=500)) == brute_trie(rows)


# ---- subtree sums -----------------------------------------------------------------------------


def random_parents(rng, n, kind):
    if kind == "chain":
        parent = list(range(-1, n - 1))
    elif kind == "star":
        parent = [-1] + [0] * (n - 1)
    elif kind == "comb":
        parent = [-1 if k == 0 else k - 2 if k % 2 == 0 else k - 1 for k in range(n)]
    else:
        parent = [-1 if k == 0 or rng.random() < 0.02 else rng.randrange(max(0, k - 9) if kind == "deep" else 0, k) for k in range(n)]
    names = list(range(n))
    rng.shuffle(names)  # parents need not come first
    out = [0] * n
    for k, p in enumerate(parent):
        out[names[k]] = -1 if p < 0 else names[p]
    return out


def brute_sums(parent, values):
    out = [0] * len(parent)
    for k, v in enumerate(values):
        while k >= 0:
            out[k] += v
            k = parent[k]
    return out


@given(st.integers(0, 10**6), st.integers(1, 300), st.sampled_from(["chain", "star", "comb", "deep", "wide"]))
@settings(max_examples=80, deadline=None)
def test_sums_and_balance(seed, n, kind):
    rng = random.Random(seed)
    parent = random_parents(rng, n, kind)
    values = [[rng.randrange(-5, 100) for _ in range(n)] for _ in range(2)]
    want = [brute_sums(parent, v) for v in values]
    prefix_trie.subtree_sums(parent, values)
    assert values == want
    # every node is a centroid once, and components are halved: a node is in at most log2(n) + 1 of them
    _, splits = prefix_trie.centroids(parent)
    assert sorted(c for c, _ in splits) == list(range(n))
    component, depth = {}, {}
    gone = set()
    for c, top in splits:
        nodes, todo = set(), [top]
        below = defaultdict(list)
        for k, p in enumerate(parent):
            below[p].append(k)
        while todo:
            x = todo.pop()
            if x not in gone:
                nodes.add(x)
                todo += [y for y in below[x] if y not in gone]
        assert c in nodes
        for x in nodes:
            depth[x] = depth.get(x, 0) + 1
            assert component.get(x, n * 2) // 2 >= len(nodes) or component.get(x) is None
            component[x] = len(nodes)
        gone.add(c)
    assert max(depth.values()) <= math.log2(n) + 1


def test_circles_are_refused():
    with pytest.raises(ValueError):
        prefix_trie.subtree_sums([1, 0, -1], [[1, 1, 1]])


@pytest.mark.parametrize("kind,order", [("chain", "first visit"), ("wide", "first visit"), ("star", "any")])
def test_rolled_over_fragments(spark, kind, order):
    rng = random.Random(len(kind))
    n = 400
    parent = random_parents(rng, n, kind)
    values = [rng.randrange(100) for _ in range(n)]
    want = brute_sums(parent, values)
    below, place, todo = defaultdict(list), {}, [-1]
    for k, p in enumerate(parent):
        below[p].append(k)
    while todo:
        x = todo.pop()
        place[x] = len(place)
        todo += below[x]
    name = lambda k: k.to_bytes(2, "big")
    rows = [(name(k), name(p) if p >= 0 else (None if k % 2 else b"nowhere"), v, place[k] if order == "first visit" else k * 7919 % n)
            for k, (p, v) in enumerate(zip(parent, values))]
    df = spark.createDataFrame(rows, "node binary, parent binary, v long, place long")
    got = {int.from_bytes(r.node, "big"): r.v for r in prefix_trie.rolled(df, ["v"], ["place"], fragment=150).collect()}
    assert got == dict(enumerate(want))
