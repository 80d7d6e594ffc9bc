"""SimHash groups against all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from conftest import SMALL

from tallyferry.llm import simhash_join as sj
from tallyferry.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def print_of(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def sets_of(prints, distance=3):
    """Linked sets of different fingerprints, all pairs compared."""
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= distance:
            parent[root(a)] = root(b)
    out = {}
    for p in prints:
        out.setdefault(root(p), set()).add(p)
    return {frozenset(s) for s in out.values()}


def expected(rows):
    prints = [(doc_id, print_of(text)) for doc_id, text in rows]
    out = []
    for group in sets_of({p for _, p in prints}):
        ids = [d for d, p in prints if p in group]
        least = min((i for i in ids if i is not None), default=None)
        out += [(d, f"{p:016x}", least) for d, p in prints if p in group]
    return sorted(out, key=repr)


def found(df, **more):
    rows = sj.near_duplicates(df, **more).withColumn("fp", sj.hex_digits(sj.F.col("fp"))).collect()
    return sorted([(r.doc_id, r.fp, r.component_id) for r in rows], key=repr)


def test_whole_table_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op13_simhash_join"](spark, SMALL).collect()]
    assert sorted(got, key=repr) == expected(rows)


def gray_sorted(prints):
    def rank(fp):
        out = 0
        while fp:
            out, fp = out ^ fp, fp >> 1
        return out

    return np.array(sorted(prints, key=rank), np.uint64)


def clustered(rng, n, flips, centres):
    middles = [rng.getrandbits(64) for _ in range(centres)]
    out = set()
    while len(out) < n:
        fp = rng.choice(middles)
        for _ in range(rng.randrange(flips + 1)):
            fp ^= 1 << rng.randrange(64)
        out.add(fp)
    return out


@pytest.mark.parametrize("n, flips, centres", [(1, 0, 1), (17, 2, 3), (400, 3, 60), (700, 5, 40), (900, 3, 1), (600, 9, 2)])
def test_index_finds_all_links(n, flips, centres):
    rng = random.Random(n)
    groups = [gray_sorted(clustered(rng, n, flips, centres)) for _ in range(3)]
    bounds = np.cumsum([0, *map(len, groups)])
    label = sj.linked_sets(np.concatenate(groups), bounds)
    for group, first in zip(groups, bounds):
        own = label[first : first + len(group)]
        sets = {frozenset(group[own == x].tolist()) for x in np.unique(own)}
        assert sets == sets_of(group.tolist())


def test_linked_nodes_are_skipped(monkeypatch):
    pairs = []
    real = sj._products
    monkeypatch.setattr(sj, "_products", lambda *a: pairs.append(int(((a[1] - a[0]) * (a[3] - a[2])).sum())) or real(*a))
    work = []
    for n in (2000, 8000):
        pairs.clear()
        dense = gray_sorted(clustered(random.Random(n), n, 3, 1))
        assert len(np.unique(sj.linked_sets(dense, np.array([0, n])))) <= n // 20
        work.append(sum(pairs))
    # Four times as many near copies: far from sixteen times the pairs.
    assert work[1] < 9 * work[0]


def test_masks_leave_no_pair_out():
    rng = random.Random(5)
    masks = [(1 << 7) - 1 << at for at in (0, 16, 32, 48)]
    for _ in range(3):
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), 3):
                b ^= 1 << bit
            assert any((a ^ b) & m == 0 for m in masks)
        masks = sj._narrower(masks, 4)


def test_large_groups_are_cut_again(spark):
    rng = random.Random(11)
    prints = clustered(rng, 1500, 4, 25)
    signed = [(p - (p >> 63 << 64),) for p in prints]
    classes = spark.createDataFrame(signed, "fp long")
    want = sets_of(prints)
    for limit in (40, 100_000):
        parent = {p: p for p in prints}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in sj.links(classes, group_limit=limit).collect():
            parent[root(a % (1 << 64))] = root(b % (1 << 64))
        got = {}
        for p in prints:
            got.setdefault(root(p), set()).add(p)
        assert {frozenset(s) for s in got.values()} == want


def test_odd_rows(spark):
    schema = "doc_id long, text string, fp string, component_id long"
    long = "word " * 150_000
    texts = [None, "", " \t\x0b", "one", "ONE", "one two", "a b c d", "A b\x0bC  d", "x\x85y", long, "É é É é"]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "one", "x", 1), (None, "alone in this, no id", "x", 1), (4, "a b c d", "y", 2)]
    rows += rows[-1:]
    assert found(spark.createDataFrame(rows, schema)) == expected([r[:2] for r in rows])
    assert found(spark.createDataFrame([], schema)) == []


def test_hot_fingerprint_and_many_near_copies(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(i, base) for i in range(2000)] + [(5000 + i, f"{base} tail{i}") for i in range(300)]
    got = {r[0]: r[1:] for r in found(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert len(got) == 2300 and {v[1] for d, v in got.items() if d < 5000} == {0}
    want = {r[0]: r[2] for r in expected(rows[:1] + rows[2000:])}
    assert {d: v[1] for d, v in got.items() if d >= 5000} == {d: v for d, v in want.items() if d >= 5000}
