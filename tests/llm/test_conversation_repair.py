"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from conftest import SMALL

from tallyferry.llm import conversation_repair as cr
from tallyferry.llm.queries import QUERIES

SPACE = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string, audit string, live long"


def damaged(rows):
    """The turns of each conversation after damage, by brute force."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        kept += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0)) for c, v in out.items()}


def cheapest(turns):
    """The repaired rows with least cost, then least initials: a search over whole edit lists."""
    faults = []
    for i, (_, role, text) in enumerate(turns):
        body = text.rstrip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in [t[1:] for t in turns[:i]] else "" if body[-1] in ".!?" else "truncated")
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, rows = heapq.heappop(heap)
        if at == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
            return faults, cost, audit, rows
        if (at, roles[-1:], bool(roles)) in seen:
            continue
        seen.add((at, roles[-1:], bool(roles)))
        options = [("I", 3, at, (r, "")) for r in ("user", "assistant")]
        if at < len(turns):
            _, role, text = turns[at]
            options.append(("D", 4, at + 1, None))
            if faults[at] not in ("blank", "duplicate"):
                more = 3 if faults[at] == "truncated" else 0
                options.append(("K", more, at + 1, (role, text)))
                options += [("R", 3 + more, at + 1, (r, text)) for r in ("user", "assistant")]
        for edit, price, then, row in options:
            initial = row[0][:1] if row else ""
            if row and (roles[-1:], initial) not in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                continue
            heapq.heappush(heap, (cost + price, audit + edit, then, roles + initial, rows + ((row,) if row else ())))
    raise AssertionError("no repair")


def expected(rows):
    out = {}
    for conv, turns in damaged(rows).items():
        faults, cost, audit, left = cheapest(turns)
        numbers = [t[0] for t in turns if t[0] is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
        text = "\n".join(f"{r}:{t}" for r, t in left)
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def found(rows_df):
    turns = cr.damage(cr.turns_of(rows_df))
    rows = cr.repair_digests(turns, cr.plan_repairs(turns)).collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def test_whole_table_against_search(spark):
    source = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [tuple(r) for r in source.select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op11_conversation_repair"](spark, SMALL).collect()}
    assert got == expected(rows)


def test_random_conversations(spark):
    rng = random.Random(7)
    texts = ["Yes.", "No!", "cut off", "", " \t\n", "What? ", "a.\x0b", "é!", "x\x85", None]
    roles = ["user", "assistant", "system", "tool", "umpire", None]
    rows = [
        (conv, turn * 2 if rng.random() < 0.2 else turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"Text {turn}.")
        for conv in range(300) for turn in range(rng.randrange(1, 14))
    ]
    # One turn number once: rows of one turn would be ordered by a hash.
    rows = list({(r[0], r[1]): r for r in rows}.values())
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "clash", 9) for r in rows], SCHEMA).repartition(5)
    assert found(df) == expected(rows)


def test_every_short_signature():
    letters = [cr.GONE, *"suaxSUAX"]
    words = [a + b + c + d for a in letters for b in letters for c in letters for d in ["", *letters]]
    shown = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    got = dict(zip(sorted(words), cr.repairs(iter(sorted(words)))))
    for word in random.Random(3).sample(words, 1500):
        turns = [
            (i, "user", "") if c == cr.GONE else (i, shown[c.lower()], f"t{i}" + ("" if c.isupper() else "."))
            for i, c in enumerate(reversed(word))
        ]
        _, cost, audit, _ = cheapest(turns)
        assert got[word] == (cost, audit), word


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "Hi."), (5, None, "user", "One."), (5, None, "assistant", "Two."),
        (5, 9, "", "No role."), (6, 3, "user", "same."), (6, 3, "user", "same."), (6, 4, "assistant", "long " * 200_000 + "."),
    ]
    got = found(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))
    assert set(got) == {None, 5, 6} and all(len(v) == 8 for v in got.values())
    assert all(cr.INSERT * v[6].count("I") + cr.DELETE * v[6].count("D") <= v[5] for v in got.values())
    assert found(spark.createDataFrame([], SCHEMA)) == {}
    # All rows of the conversation are dropped by the damage.
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    only = found(spark.createDataFrame([(gone, 0, "user", "Hi.", "x", 1)], SCHEMA))
    assert only == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_turns_are_legal_and_give_the_digest(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet")
    turns = cr.damage(cr.turns_of(rows))
    plans = cr.plan_repairs(turns)
    left = {}
    for r in cr.repaired_turns(turns, plans).collect():
        left.setdefault(r.conv_id, []).append(r)
    for row in cr.repair_digests(turns, plans).collect():
        own = sorted(left.get(row.conv_id, []), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(len(own)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in own))
        assert "".join(r.edit for r in own) == row.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in own).encode()).hexdigest() == row.repaired_sha256
    assert plans.where("audit = ''").count() + len(left) <= plans.count()


def test_conversations_that_end_alike_share_nodes():
    cr.node_before.cache_clear()
    long = [("ua" * 500)[:n] for n in range(1000, 0, -1)]
    ordered = sorted(w[::-1] for w in long)
    assert len(list(cr.repairs(iter(ordered)))) == 1000
    assert cr.node_before.cache_info().currsize < 20


@pytest.mark.parametrize("copies", [1, 3000])
def test_hot_conversation_and_hot_signature(spark, copies):
    hot = spark.range(copies).selectExpr(
        "7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('Text ', id, '.') as text"
    )
    alike = spark.range(copies).selectExpr("id + 100 as conv_id", "0L as turn", "'user' as role", "'Same text.' as text")
    rows = [tuple(r) for r in hot.union(alike).collect()]
    got = found(hot.union(alike))
    assert set(got) == {r[0] for r in rows}
    small = {r[0] for r in rows if r[0] != 7}
    want = expected([r for r in rows if r[0] in small])
    assert {c: v for c, v in got.items() if c in small} == want
