import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from shoptrail.llm import simhash
from shoptrail.llm.components import components

LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_edge_cases_match_brute_force(edge_docs, edge_rows):
    prints = [fingerprint(r[1]) for r in edge_rows]
    n = len(prints)
    near = [(i, j) for i in range(n) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 4]
    root = roots(range(n), near)
    least = {}
    for i, r in enumerate(edge_rows):
        if r[0] is not None:
            least[root[i]] = min(least.get(root[i], r[0]), r[0])
    expected = [(r[0], format(prints[i], "016x"), least.get(root[i])) for i, r in enumerate(edge_rows)]
    assert sorted(map(tuple, simhash.query(edge_docs).collect()), key=repr) == sorted(expected, key=repr)
    kept = simhash.deduplicated(edge_docs)
    assert kept.columns == edge_docs.columns
    kept = kept.collect()
    assert len(kept) == len(set(root.values()))
    assert {r["doc_id"] for r in kept} == {least.get(r) for r in root.values()}


def test_empty(no_docs):
    assert simhash.query(no_docs).count() == 0 and simhash.deduplicated(no_docs).count() == 0


def test_segments_leave_no_pair_out():
    assert sum(bits for _, bits in simhash.SEGMENTS) == 64 and [low for low, _ in simhash.SEGMENTS] == [0, 32]
    # Two balls of radius 1 meet up to distance 2: a pair that is found in neither segment differs in more than the distance.
    assert sum(2 + 1 for _ in simhash.SEGMENTS) > simhash.DISTANCE


def test_links_are_all_pairs_within_the_distance(spark):
    rng = random.Random(6)
    prints = {0, 2**63, 2**64 - 1}
    for _ in range(40):
        base = rng.getrandbits(64)
        prints |= {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(8)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    found = simhash.links(spark.createDataFrame([(signed(p),) for p in prints], "fp long")).collect()
    pairs = {frozenset(map(tuple, [(a,), (b,)])) for a, b in found}
    expected = {frozenset([(signed(a),), (signed(b),)]) for a in prints for b in prints if 0 < bin(a ^ b).count("1") <= 4}
    assert pairs == expected


@pytest.mark.parametrize("hot_bucket", [0, 3])
def test_crowded_buckets_connect_the_same_fingerprints(spark, hot_bucket):
    rng = random.Random(8)
    prints = set()
    for _ in range(6):
        base = rng.getrandbits(63)
        prints |= {base ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 5))) for _ in range(12)}
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    near = [(a, b) for a in prints for b in prints if 0 < bin(a ^ b).count("1") <= 4]
    found = list(map(tuple, simhash.links(df, hot_bucket=hot_bucket).collect()))
    assert set(found) <= set(near) and roots(prints, found) == roots(prints, near)


def test_links_of_near_copies_grow_with_their_number(spark):
    rng = random.Random(9)
    base = rng.getrandbits(63)
    ball = [base ^ (1 << a | 1 << b) for a in range(63) for b in range(a)]
    rng.shuffle(ball)
    made = []
    for n in (400, 1600):
        found = list(map(tuple, simhash.links(spark.createDataFrame([(p,) for p in ball[:n]], "fp long")).collect()))
        assert all(0 < bin(a ^ b).count("1") <= 4 for a, b in found)
        assert len(set(roots(ball[:n], found).values())) == 1
        made.append(len(found))
    # All of them are near each other: listed as pairs, four times as many make sixteen times the rows.
    assert made[1] <= 6 * made[0]


def test_a_pair_is_found_once_where_a_segment_is_equal(spark):
    found = simhash.links(spark.createDataFrame([(5 << 32 | 1,), (5 << 32 | 0xF0F0,)], "fp long")).count()
    assert found == 0
    assert simhash.links(spark.createDataFrame([(5 << 32 | 1,), (5 << 32 | 0xE,)], "fp long")).count() == 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    df = spark.createDataFrame(edges + [(None, 1)], "x long, y long")
    expected = roots({n for e in edges for n in e}, edges)
    assert dict(map(tuple, components(df, "x", "y").collect())) == {n: r for n, r in expected.items() if n != r}


@pytest.mark.parametrize("shape", ["path", "star"])
def test_long_components(spark, shape):
    n = 300
    edges = [(k, k + 1) if shape == "path" else (n, k) for k in range(n)]
    random.Random(1).shuffle(edges)
    found = dict(map(tuple, components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()))
    assert found == {k: 0 for k in range(1, n + 1)}
