"""Conversation structure repair: the cheapest edits that make role orders legal.

Every turn becomes a one-letter signature of its role and fault, so a conversation
is a short string. Conversations that end alike need the same edits at their ends:
an automaton that shares suffixes (built from the end, one node per different
suffix) keeps per node and grammar state the least cost to go and the edit that it
starts with, and each node is worked out once for all conversations.

Spark groups and orders the turns, counts faults with window functions, and sorts
the different signatures by their reversed text. Conversations with a common
ending are neighbours then, and a task needs one path of nodes at a time.

Shuffles: one of the narrow turns (hashes in place of texts), one of the different
signatures, one of the texts with the edits found for them. A conversation is
one row of the result, its edits one letter a turn: that string (and its
signature) is held by one task, its texts never are; they stream through a running
hash in turn order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyferry.session import materialise

SPACE = " \t\n\x0b\f\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Tasks over which conversations of one signature spread when they fetch their edits.
SALTS = 32

# Grammar states of (s?(ua)+)?: nothing yet, after s, after u, after a.
EMPTY, AFTER_S, AFTER_U, AFTER_A = range(4)
_STATES = range(4)
_NEXT = {(EMPTY, "s"): AFTER_S, (EMPTY, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
#: The only user/assistant initial that may follow each state.
_OWN = ("u", "u", "a", "u")
_ROLE = {"u": "user", "a": "assistant"}
_NEVER = 1 << 40

#: Signature letters: a turn that has to go, and role initials (x: any other), upper case when truncated.
GONE = "-"


class Node(NamedTuple):
    """What is known of a suffix, by grammar state, and how its first turn is edited.

    ``extra``: cost to go above ``least`` of the suffix; ``edits``: the letter to start
    with; ``after``: the state behind it (of the same suffix for I, of the next one else).
    """

    extra: tuple[int, ...]
    edits: tuple[str, ...]
    after: tuple[int, ...]


def _with_inserts(costs: list[int], edits: list[str], after: list[int]) -> tuple[int, Node]:
    """Let an inserted turn come first where that is cheaper, or as cheap and earlier in ASCII."""
    base = list(costs)
    for state in (AFTER_U, AFTER_A, EMPTY, AFTER_S):
        to = _NEXT[state, _OWN[state]]
        # Inserts never go round: u and a look at each other's cost without one.
        cost = INSERT + (base if state in (AFTER_U, AFTER_A) else costs)[to]
        if (cost, "I") < (costs[state], edits[state]):
            costs[state], edits[state], after[state] = cost, "I", to
    least = min(costs)
    return least, Node(tuple(c - least for c in costs), tuple(edits), tuple(after))


@lru_cache(maxsize=None)
def end_node() -> tuple[int, Node]:
    """The empty suffix: legal in two states, elsewhere only turns can be inserted."""
    return _with_inserts([0, _NEVER, _NEVER, 0], ["", "", "", ""], list(_STATES))


@lru_cache(maxsize=None)
def node_before(letter: str, extra: tuple[int, ...]) -> tuple[int, Node]:
    """The suffix that starts with a turn of this signature; how much its least cost grows.

    Costs differ by few units between states, so there are few different arguments.
    """
    costs, edits, after = [], [], []
    for state in _STATES:
        options = [(DELETE + extra[state], "D", state)]
        if letter != GONE:
            more = TRUNCATED if letter.isupper() else 0
            to = _NEXT.get((state, letter.lower()))
            if to is not None:
                options.append((more + extra[to], "K", to))
            to = _NEXT[state, _OWN[state]]
            options.append((REROLE + more + extra[to], "R", to))
        cost, edit, to = min(options)
        costs.append(cost)
        edits.append(edit)
        after.append(to)
    return _with_inserts(costs, edits, after)


def repairs(reversed_signatures: Iterator[str]) -> Iterator[tuple[int, str]]:
    """Cost and edits of signatures given from the end, sorted: one path of the automaton at a time.

    The nodes of an ending shared with the signature before are taken as they are.
    """
    least, last = end_node()
    path, costs, before, answer = [last], [least], "", (0, "")
    for signature in reversed_signatures:
        shared = _common(before, signature)
        del path[shared + 1 :], costs[shared + 1 :]
        for letter in signature[shared:]:
            grown, node = node_before(letter, path[-1].extra)
            path.append(node)
            costs.append(costs[-1] + grown)
        if signature != before:
            answer = costs[-1] + path[-1].extra[EMPTY], _edits_along(path)
        before = signature
        yield answer


def _edits_along(path: list[Node]) -> str:
    """The edits that the nodes name, from the whole conversation down to the empty suffix."""
    state, edits = EMPTY, []
    for node in reversed(path):
        while node.edits[state] == "I":
            edits.append("I")
            state = node.after[state]
        edits.append(node.edits[state])
        state = node.after[state]
    return "".join(edits)


def _common(a: str, b: str) -> int:
    """Length of the common beginning, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def turns_of(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``live``; null roles and texts are one space. Other columns are not read."""
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        _shown("role").alias("role"), _shown("text").alias("text"), F.lit(True).alias("live"),
    )


def _shown(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """Turns damaged by the CRC of ``conv_id:turn`` modulo 20 (a null is one space there).

    0 drops the turn (``live`` is false: it only marks its conversation), 1 empties the
    text, 2 removes ``.!?`` from it, 3 repeats the turn, 4 sets the role to user.
    """
    code = F.col("code")
    coded = turns.withColumn("code", F.crc32(F.concat(_shown("conv_id"), F.lit(":"), _shown("turn")).cast("binary")) % 20)
    copies = F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return coded.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(code.isin(0, 1), "").when(code == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("live") & (code != 0)).alias("live"), F.explode(copies).alias("copy"),
    ).drop("copy")


def _text_keys() -> list[Column]:
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")]


def signatures(turns: DataFrame) -> DataFrame:
    """One row per conversation: fault counts, gaps, illegal pairs and the reversed signature.

    ``turns`` as made by ``turns_of``. Texts are hashed before the shuffle (128 bits).
    Turns are in order of turn (null first), role and those hashes.
    """
    body = F.rtrim(F.col("text"), F.lit(SPACE))
    narrow = turns.select(
        "conv_id", "turn", "role", "live", *_text_keys(),
        (body == "").alias("blank"), F.right(body, F.lit(1)).isin(".", "!", "?").alias("ended"),
    ).repartition("conv_id")
    same = Window.partitionBy("conv_id", "live", "role", "t1", "t2").orderBy("turn")
    order = Window.partitionBy("conv_id", "live").orderBy("turn", "role", "t1", "t2", "seen")
    numbered = narrow.withColumn("seen", F.row_number().over(same)).select(
        "conv_id", "turn", "live", F.row_number().over(order).alias("pos"),
        F.when(F.col("blank"), "blank").when(F.col("seen") > 1, "duplicate").when(~F.col("ended"), "truncated").alias("fault"),
        F.substring("role", 1, 1).alias("initial"), F.lag(F.substring("role", 1, 1)).over(order).alias("before"),
        F.lag("turn").over(order).alias("turn_before"),
    )
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    letter = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    live = F.col("live")

    def count(condition: Column) -> Column:
        return F.coalesce(F.sum((live & condition).cast("long")), F.lit(0).cast("long"))

    fresh_turn = F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))
    pair = F.concat("before", "initial")
    letters = F.array_sort(F.collect_list(F.when(live, F.struct(-F.col("pos"), letter.alias("letter")))))
    span = F.max(F.when(live, F.col("turn"))) - F.min(F.when(live, F.col("turn"))) + 1
    return numbered.groupBy("conv_id").agg(
        F.coalesce(span - count(fresh_turn), F.lit(0).cast("long")).alias("gaps"),
        *[count(F.coalesce(F.col("fault") == f, F.lit(False))).alias(f) for f in ("blank", "duplicate", "truncated")],
        count(F.col("before").isNotNull() & ~pair.isin("su", "ua", "au")).alias("illegal"),
        F.array_join(F.transform(letters, lambda x: x["letter"]), "").alias("signature"),
    )


def _edits_of(found: DataFrame) -> DataFrame:
    """signature, salt, cost and audit of the different signatures in ``found``."""
    different = found.select("signature", _salt().alias("salt")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def texts():
            for batch in batches:
                if batch.num_rows:
                    waiting.append(batch)
                    yield from batch.column(0).to_pylist()

        made: list[tuple[int, str]] = []
        for repair in repairs(texts()):
            made.append(repair)
            if len(made) == waiting[0].num_rows:
                yield _answer(waiting.pop(0), made)
                made = []

    ordered = different.repartitionByRange("signature", "salt").sortWithinPartitions("signature", "salt")
    return ordered.mapInArrow(run, "signature string, salt int, cost long, audit string")


def _answer(batch: pa.RecordBatch, made: list[tuple[int, str]]) -> pa.RecordBatch:
    costs, audits = zip(*made)
    columns = [batch.column(0), batch.column(1), pa.array(costs, pa.int64()), pa.array(audits, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["signature", "salt", "cost", "audit"])


def _salt() -> Column:
    return F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int")


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def plan_repairs(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation.

    ``turns`` as made by ``turns_of``. ``audit``: the initials of the cheapest edits (Keep,
    Rerole, Delete, Insert) in order, the ASCII-least where several cost the same.

    - A null turn comes first and counts for no gap; all rows with a null id are one conversation.
    - A role's initial is its first code point; an empty role has none and cannot be kept.
    - Rows of one turn are in order of role, then of a hash of the text; equal rows are
      next to each other. Rows that repeat are duplicates.
    - A conversation without live rows: zeros and an empty audit. An empty table: no rows.
    """
    found = materialise(signatures(turns), "signatures")
    judged = found.withColumn("salt", _salt()).join(_edits_of(found), ["signature", "salt"])
    return judged.select("conv_id", *_COUNTS, "audit")


def repaired_turns(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), edit, role and text of each turn that is left."""
    return _in_order(turns, plans).mapInArrow(_emit_turns, "conv_id long, position long, edit string, role string, text string")


def repair_digests(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """``plans`` with ``repaired_sha256``: the repaired ``role:text`` of a conversation, joined by line feeds."""
    schema = "conv_id long, " + "".join(f"{c} long, " for c in _COUNTS) + "audit string, repaired_sha256 string"
    return _in_order(turns, plans).mapInArrow(_emit_digests, schema)


def _in_order(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's plan, then its turns in the order of its signature; texts are shuffled here, once."""
    nothing = F.lit(None)
    heads = plans.select(
        "conv_id", F.lit(0).alias("kind"), nothing.cast("long").alias("turn"), nothing.cast("string").alias("role"),
        nothing.cast("long").alias("t1"), nothing.cast("long").alias("t2"), F.col("audit").alias("text"), *_COUNTS,
    )
    bodies = turns.where("live").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", *_text_keys(), "text",
        *[nothing.cast("long").alias(c) for c in _COUNTS],
    )
    ordered = heads.union(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "t1", "t2")
    return ordered.select("conv_id", "kind", "role", "text", *_COUNTS)


class _Repair:
    """One conversation while its turns pass by: where its edits are and the role before."""

    def __init__(self, conv, audit: str, counts: list[int]):
        self.conv, self.audit, self.counts = conv, audit, counts
        self.at, self.state = 0, EMPTY

    def _own(self, edit: str, text: str) -> tuple[str, str, str]:
        own = _OWN[self.state]
        self.state = _NEXT[self.state, own]
        return edit, _ROLE[own], text

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._own("I", "")

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of what the next turn leaves, with what is inserted before it."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _NEXT[self.state, role[0]]
            yield edit, role, text
        elif edit == "R":
            yield self._own(edit, text)


def _repairing(batch: pa.RecordBatch, current: _Repair | None) -> Iterator[tuple[_Repair, list | None]]:
    """Repairs and what each row of the batch adds to them; None where the repair before is complete."""
    ids, kinds, roles, texts, *counts = (c.to_pylist() for c in batch.columns)
    for i, kind in enumerate(kinds):
        if kind == 0:
            if current is not None:
                yield current, list(current.inserted())
                yield current, None
            current = _Repair(ids[i], texts[i], [c[i] for c in counts])
            yield current, []
        else:
            yield current, list(current.turn(roles[i], texts[i]))


def _emit_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, position = None, 0
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    names = ["conv_id", "position", "edit", "role", "text"]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        out = []
        for current, added in _repairing(batch, current):
            if added is None:
                position = 0
                continue
            for row in added:
                out.append((current.conv, position, *row))
                position += 1
        yield made(out)
    if current is not None:
        yield made([(current.conv, position + i, *row) for i, row in enumerate(current.inserted())])


def _emit_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, digest, first = None, hashlib.sha256(), True
    names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]
    types = [pa.int64()] * (1 + len(_COUNTS)) + [pa.string()] * 2

    def add(rows: list[tuple]) -> None:
        nonlocal first
        for _, role, text in rows:
            digest.update(f"{role}:{text}".encode() if first else f"\n{role}:{text}".encode())
            first = False

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        out = []
        for current, added in _repairing(batch, current):
            if added is None:
                out.append((current.conv, *current.counts, current.audit, digest.hexdigest()))
                digest, first = hashlib.sha256(), True
            else:
                add(added)
        yield made(out)
    if current is not None:
        add(list(current.inserted()))
        yield made([(current.conv, *current.counts, current.audit, digest.hexdigest())])
