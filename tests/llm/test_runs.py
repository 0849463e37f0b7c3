import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoptrail.llm import runs, scan


def brute(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((s, e, q) for (s, e), q in found.items())


def fast(texts):
    line, begins = [], []
    for k, text in enumerate(texts):
        begins.append(len(line))
        line += [*text, 10**9 + k]
    found = runs.runs_of(scan.mix(np.array(line, np.uint64)), max(map(len, texts)))
    ends = [*begins[1:], len(line)]
    return [sorted((s - a, e - a, q) for s, e, q in found.tolist() if a <= s < b) for a, b in zip(begins, ends)]


def sample(rng):
    size, letters = rng.randrange(400), rng.choice([2, 2, 3, 5, 50])
    block = lambda n: [rng.randrange(letters) for _ in range(n)]
    kind = rng.randrange(5)
    if kind == 0:
        return block(size)
    if kind == 1:
        out = (block(rng.randrange(1, 60)) * size)[:size]
        for _ in range(rng.randrange(4) if size else 0):
            out[rng.randrange(size)] = rng.randrange(letters)
        return out
    if kind == 2:
        inner = (block(rng.randrange(1, 6)) * 90)[: rng.randrange(5, 90)] + block(rng.randrange(3))
        return (inner * size)[:size]
    if kind == 3:
        a, b = [0], [0, 1]
        while len(b) <= size:
            a, b = b, b + a
        return b[:size]
    out = []
    while len(out) < size:
        out += (block(rng.randrange(1, 8)) * 60)[: rng.randrange(1, 120)]
    return out[:size]


@pytest.mark.parametrize("seed", range(40))
def test_all_runs_are_found(seed):
    rng = random.Random(seed)
    texts = [sample(rng) for _ in range(8)]
    assert fast(texts) == [brute(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=90), min_size=1, max_size=3))
def test_all_runs_of_two_words_are_found(texts):
    assert fast(texts) == [brute(t) for t in texts]


def test_long_periods():
    rng = random.Random(5)
    block = [rng.randrange(10**6) for _ in range(7001)]
    text = [1, 2, 3] + block * 2 + block[:100] + [9]
    assert fast([text]) == [brute_long(text, 7001)]


def brute_long(words, q):
    start = next(i for i in range(len(words)) if words[i] == words[i + q])
    end = start
    while end + q < len(words) and words[end] == words[end + q]:
        end += 1
    return [(start, end + q, q)]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = sorted(((s, e - s, q) for s, e, q in brute(words) if e - s >= 12), key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def short(rows):
    """Brute force takes n^2 steps: the very long texts have a test of their own."""
    return [r for r in rows if len((r[1] or "").split()) < 2000]


def test_query_matches_brute_force(spark, edge_rows):
    from llm_rows import SCHEMA, document

    rng = random.Random(7)
    rows = short(edge_rows) + [document(k, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(200)))) for k in range(1000, 1060)]
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[0]) > 4
    found = runs.query(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted((expected(r[0], r[1]) for r in rows), key=repr)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {r["doc_id"]: tuple(r) for r in runs.query(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        if len(text.split()) < 1500:
            assert found[doc_id] == expected(doc_id, text)


def test_repeats_keep_all_columns(edge_docs, edge_rows):
    found = runs.repeats(edge_docs)
    assert found.columns == [*edge_docs.columns, "runs", "collapsed"]
    rows = found.collect()
    assert sorted((r["doc_id"], r["text"], r["row_id"]) for r in rows if r["doc_id"] is not None) == sorted(
        (r[0], r[1], r[7]) for r in edge_rows if r[0] is not None
    ) or len(rows) == len(edge_rows)
    same = next(r for r in rows if r["doc_id"] == 7)
    assert [tuple(r) for r in same["runs"]] == [(0, 500, 1)] and same["collapsed"] == "same"


def test_empty(no_docs):
    assert runs.query(no_docs).count() == 0 and runs.repeats(no_docs).count() == 0


def test_ids_of_another_type(spark):
    rows = spark.createDataFrame([("a", "x y"), (None, None)], "doc_id string, text string")
    assert {r["doc_id"] for r in runs.query(rows).collect()} == {"a", None}
