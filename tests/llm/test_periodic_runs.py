"""Periodic runs against all stretches of all periods."""

import hashlib
import random
import re
import zlib

import pytest
from conftest import SMALL

from tallyferry.llm import periodic_runs as pr
from tallyferry.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def all_runs(words):
    """Every maximal stretch of period q, kept when q is its smallest period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            stretch = words[i : i + length]
            if length >= max(6, 4 * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out)


def expected(doc_id, text, plant=True):
    words = WORD.findall(text or "")
    n = len(words)
    if plant and n and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        len(runs), *best, best[1] * 1000 // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest(),
    )


def test_whole_table_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op12_periodic_runs"](spark, SMALL).collect()
    assert len(rows) == len(texts) and any(r.n_runs for r in rows)
    for r in rows:
        if len(WORD.findall(texts[r.doc_id] or "")) < 3000:
            assert tuple(r[1:]) == expected(r.doc_id, texts[r.doc_id]), r.doc_id


@pytest.mark.parametrize("letters, n, times", [(1, 30, 3), (2, 40, 300), (3, 120, 200), (9, 200, 60)])
def test_random_sequences(letters, n, times):
    rng = random.Random(letters)
    for _ in range(times):
        words = []
        while len(words) < n:
            block = [rng.randrange(letters) for _ in range(rng.randrange(1, 14))]
            words += block * rng.choice([1, 1, 2, 4, 5, 7])
        words = words[: rng.randrange(0, n + 1)]
        assert [tuple(r) for r in pr.runs_of(pr.word_ids(words))] == all_runs(words), words


def test_a_period_in_which_every_seed_comes_twice():
    # A short k-gram that comes again inside the period must not hide the period itself.
    block = [0, 1, 2, 3, 4, 5, 0, 1, 2, 3, 4, 6]
    for period in (block, block * 2 + [7], (block + [8]) * 3 + [9]):
        words = [10, *period * 4, 11]
        assert [tuple(r) for r in pr.runs_of(pr.word_ids(words))] == all_runs(words)


def test_odd_rows(spark):
    schema = "doc_id long, text string, runs string, collapsed long"
    texts = [
        None, "", " \t\n\x0b", "a a a a a", "a a a a a a", "A a A a A a A a", "x\x85x x\x85x", "é é é é é é é b",
        "w " * 40_000, " ".join(f"w{i % 5000}" for i in range(20_001)),
    ]
    rows = [(i, t, "r", 1) for i, t in enumerate(texts)] + [(None, "b b b b b b b", "r", 1), (4, texts[4], "s", 2), (4, texts[4], "s", 2)]
    got = pr.digests(pr.find_runs(spark.createDataFrame(rows, schema))).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: tuple(r[1:]) for r in got}
    for doc_id, text in [*enumerate(texts[:8]), (None, "b b b b b b b")]:
        assert by_id[doc_id] == expected(doc_id, text, plant=False)
    assert by_id[8][:5] == (1, 0, 40_000, 1, 40_000_000)
    assert by_id[9][:5] == (1, 0, 20_001, 5000, 4000)
    assert pr.digests(pr.find_runs(spark.createDataFrame([], schema))).collect() == []
    planted = pr.digests(pr.find_runs(spark.createDataFrame(rows, schema), plant=True)).collect()
    assert {r.doc_id: tuple(r[1:]) for r in planted}[None] == by_id[None]


def test_pairs_grow_with_the_text(monkeypatch):
    calls = []
    real = pr._agreement
    monkeypatch.setattr(pr, "_agreement", lambda a, b: calls.append(1) or real(a, b))
    pr.runs_of(pr.word_ids(["w"] * 50_000))
    # Both sides of one run: repeated extensions are suppressed.
    assert len(calls) == 2
