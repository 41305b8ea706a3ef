"""Near-duplicates against brute force over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from clickflow.llm import near_dedup
from clickflow.llm.linking import components, link_buckets
from clickflow.llm.queries import QUERIES
from tests.llm.conftest import EDGE_TEXTS


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows, percent):
    """Component by doc_id for rows of (doc_id, text) with distinct ids."""
    sets = {d: shingle_set(t) for d, t in rows}
    at = {d: d for d in sets}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    seen = set()
    for group in holders.values():
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    common = len(sets[a] & sets[b])
                    if 100 * common >= percent * len(sets[a] | sets[b]):
                        x, y = find(a), find(b)
                        at[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_query_equals_brute_force(spark, small_dir, small_docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op6_near_dedup"](spark, small_dir).collect()}
    assert got == brute(small_docs, 85)


def family(seed, words, copies, edits):
    """A text and copies of it, each with a few words changed."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(copies):
        words = list(base)
        for at in rnd.sample(range(len(words)), edits):
            words[at] = f"x{rnd.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_families_edges_and_chains(docs_of):
    texts = [*EDGE_TEXTS, "one two three", "One  two\nTHREE", "one two three four five", "ONE TWO three four five "]
    texts += family(1, 300, 30, 3)  # links
    texts += family(2, 200, 40, 8)  # alike, some below the threshold
    rnd = random.Random(5)
    chain = [f"c{i}" for i in range(100)]
    for _ in range(12):  # each a near copy of the one before
        texts.append(" ".join(chain))
        chain = chain[3:] + [f"d{rnd.randrange(10**6)}" for _ in range(3)]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    got = near_dedup.near_duplicates(docs_of(*rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_nulls_repeats_and_no_rows(docs_of):
    long = " ".join(f"w{i}" for i in range(60))
    docs = docs_of((None, long), (4, long), (2, long), (2, long), (7, "other words"), (8, None))
    got = sorted(
        (r["doc_id"] or -1, r["n_shingles"], r["component_id"], r["kept"])
        for r in near_dedup.near_duplicates(docs).collect()
    )
    assert got == [
        (-1, 56, None, True), (2, 56, 2, True), (2, 56, 2, True), (4, 56, 2, False), (7, 1, 7, True), (8, 0, 8, True)
    ]
    assert near_dedup.near_duplicates(docs.limit(0)).collect() == []


def test_open_buckets_are_compared_in_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 4)
    texts = family(3, 200, 25, 9)
    rows = list(enumerate(texts))
    got = near_dedup.near_duplicates(docs_of(*rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, 85)


@pytest.mark.parametrize("overlap", [0.3, 0.6, 0.85])
def test_estimate_is_close(overlap):
    rng = np.random.default_rng(11)
    errors = []
    for _ in range(40):
        shared = rng.integers(0, 2**64, int(1000 * overlap), dtype=np.uint64)
        sides = [
            np.concatenate([shared, rng.integers(0, 2**64, n, dtype=np.uint64)])
            for n in (int(700 * (1 - overlap)), int(300 * (1 - overlap)))
        ]
        true = len(shared) / (len(shared) + sum(len(s) - len(shared) for s in sides))
        sketches = [near_dedup.registers(s)[None] for s in sides]
        sizes = [np.array([float(len(s))]) for s in sides]
        errors.append(near_dedup.estimate(*sketches, *sizes)[0] - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_registers_merge_by_maximum():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (500, 90))
    both = near_dedup.registers(np.union1d(a, b))
    assert (np.maximum(near_dedup.registers(a), near_dedup.registers(b)) == both).all()


def test_components(spark):
    rnd = random.Random(9)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)] + [(5, 5)]
    at = {x: x for e in edges for x in e}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        at[max(x, y)] = min(x, y)
    want = {x: find(x) for x in at if find(x) != x}
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    assert {r["id"]: r["component"] for r in components(df).collect()} == want
    assert components(df.limit(0)).collect() == []


def test_no_buckets(spark):
    empty = spark.createDataFrame([], "key long, id long")
    assert link_buckets(empty, lambda p: p, lambda m: m).collect() == []
