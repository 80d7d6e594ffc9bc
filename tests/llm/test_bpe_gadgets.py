"""The compiled automaton against byte-pair encoding by hand, over random merges."""

import random

import pytest

from tallyferry.llm.bpe_automaton import Automaton, ChunkCoder
from tallyferry.llm.token_files import arrow_uri


def random_merges(rng, letters, n):
    """Merges as in a vocabulary: halves come first and each makes a new token, though some never can."""
    words, merges = [bytes([c]) for c in letters], []
    for _ in range(n):
        a, b = rng.choice(words), rng.choice(words)
        if a + b not in words and len(a + b) <= 8:
            merges.append((a, b))
            words.append(a + b)
    return words, merges


def by_hand(word, merges):
    """Merge number by number, each from left to right."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        pairs = list(zip(parts, parts[1:]))
        rank = min((merges.index(p) for p in pairs if p in merges), default=None)
        if rank is None:
            return parts
        out, i = [], 0
        while i < len(parts):
            if i + 1 < len(parts) and (parts[i], parts[i + 1]) == merges[rank]:
                out.append(parts[i] + parts[i + 1])
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out


@pytest.mark.parametrize("letters, n", [(b"a", 4), (b"ab", 8), (b"ab", 20), (b"abc", 30)])
def test_every_short_word_is_spelled_as_merged(letters, n):
    rng = random.Random(n)
    for _ in range(40):
        words, merges = random_merges(rng, letters, n)
        ids = {w: i for i, w in enumerate(words)}
        machine = Automaton(merges, ids, {})
        for _ in range(120):
            word = bytes(rng.choice(letters) for _ in range(rng.randrange(0, 13)))
            got = machine.encode_word(word)
            assert [words[i] for i in got] == by_hand(word, merges), (merges, word)
            assert machine.decode_bytes(got) == word


def test_the_automaton_accepts_nothing_else():
    rng = random.Random(4)
    for _ in range(60):
        words, merges = random_merges(rng, b"ab", 10)
        ids = {w: i for i, w in enumerate(words)}
        machine = Automaton(merges, ids, {})
        arcs = [i for w, i in ids.items() if by_hand(w, merges) == [w]]
        for _ in range(200):
            path = [rng.choice(arcs) for _ in range(rng.randrange(1, 6))]
            accepted = all(machine.has_arc(a, b) for a, b in zip([-1, *path], path))
            assert accepted == (by_hand(b"".join(words[i] for i in path), merges) == [words[i] for i in path])


def test_transitions_kept_are_bounded(monkeypatch):
    monkeypatch.setattr("tallyferry.llm.bpe_automaton.TABLE_ENTRIES", 20)
    words, merges = random_merges(random.Random(1), b"abc", 25)
    machine = Automaton(merges, {w: i for i, w in enumerate(words)}, {})
    rng = random.Random(2)
    for _ in range(300):
        word = bytes(rng.choice(b"abc") for _ in range(9))
        assert [words[i] for i in machine.encode_word(word)] == by_hand(word, merges)
        assert sum(map(len, machine._table.values())) <= 20 + 9 * 9


def test_chunk_memory_is_bounded_by_bytes():
    coder = ChunkCoder(lambda chunks: [c.upper() for c in chunks], remembered=5_000)
    for i in range(400):
        text = f"word{i} " + "x" * (i * 7 % 900)
        assert "".join(coder(text)) == text.upper()
        assert len(coder._young) + len(coder._old) < 80


def test_object_stores_go_by_the_name_that_arrow_knows():
    assert arrow_uri("s3a://bucket/a/b") == "s3://bucket/a/b"
    assert [arrow_uri(u) for u in ("hdfs://n/a", "/tmp/a", "file:///tmp/a")] == ["hdfs://n/a", "/tmp/a", "file:///tmp/a"]
