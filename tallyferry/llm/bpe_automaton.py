"""BPE encoding and decoding with a tokenization automaton.

The merges are compiled one after the other into a deterministic automaton over tokens,
which accepts exactly the token sequences that byte-pair encoding produces. It starts with
a state behind every byte that has an arc for every byte. The gadget of merge number k,
(u, v), looks at the state behind u. Has it an arc v, then the pair stands somewhere:

- every state with an arc u gets an arc uv, which leads to a copy of the state behind v;
- the state behind u loses its arc v.

A copy keeps only what sets it apart: what it was copied from, the moment, and the arcs
removed since. A state has an arc uv if it had the arc u at moment k, so arcs are kept by
token: left half and moment. Stored so, a gadget adds one state and one removed arc.

Every byte string is spelled by exactly one accepted sequence, and so is each of its
beginnings. Encoding a pre-split word goes over its bytes once and keeps, for each
position, the state that its beginning leads to: the one arc that ends there and that the
state where it starts has in the transition table. Nothing settled is taken back. Decoding
emits the labels of the arcs.

The vocabulary file (a fixed size) is read by each worker once, from a path that
the cluster must offer to all of them.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

#: Fixed white space of the pre-split pattern's \s (Unicode White_Space).
WHITE = "\\t\\n\\x0b\\x0c\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Fixed pre-split pattern of the byte-level vocabulary files.
PRE_SPLIT = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
#: White space with the letters and digits after it, or else all up to the next white space. A pre-split
#: word never crosses from letters or digits into other signs, so "word", "word." and "word," share a chunk.
#: Special tokens are whole in a chunk, as they begin with a sign.
CHUNK = rf"[{WHITE}]*[^\W_]+|[{WHITE}]*[^{WHITE}]+|[{WHITE}]+"
#: Bytes of chunks and what they gave in one generation of a worker's memory.
REMEMBERED = 60 << 20
#: The same for ``encode_documents``.
TASK_REMEMBERED = 20 << 20
#: What a remembered chunk takes besides its text and ids, which take about five bytes a character.
ENTRY_BYTES = 200
#: Documents whose ids are handed on together.
BATCH_DOCS = 500
#: Looked-up transitions that are kept, about 100 bytes each.
TABLE_ENTRIES = 200_000
_NEVER = 1 << 60


def _byte_letters() -> dict[str, int]:
    """The fixed letters that stand for bytes in vocabulary files."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Automaton:
    """The compiled merges: states with their removed arcs, arcs with their labels.

    Each merge makes a token of its own out of tokens that earlier merges make.
    """

    def __init__(self, merges: list[tuple[bytes, bytes]], ids: dict[bytes, int], special: dict[str, int]):
        self.label = {i: w for w, i in ids.items()}
        self.special = special
        self.label.update({i: s.encode() for s, i in special.items()})
        size = 1 + max(self.label, default=0)
        #: Per token: the moment of its gadget (a byte: -1, none yet: -2); the token its arc grew
        #: from; the token whose state was copied to be the state behind it.
        self.made = [-2] * size
        self.left = [-1] * size
        self.right = [-1] * size
        #: state * size + arc: the moment at which the arc was removed from the state itself.
        self.removed: dict[int, int] = {}
        self._size = size
        #: Per state and arc: looked-up transitions, and how many there are.
        self._table: dict[int, dict[int, bool]] = {}
        self._kept = 0
        # A word of the vocabulary that no gadget makes is never encoded; it has a label but no arc.
        self._arcs = {w: i for w, i in ids.items() if len(w) == 1}
        for arc in self._arcs.values():
            self.made[arc] = -1
        for moment, (a, b) in enumerate(merges):
            if self._gadget(moment, ids[a], ids[b], ids[a + b]):
                self._arcs[a + b] = ids[a + b]
        self._split = regex.compile(PRE_SPLIT)
        self._marks = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    @classmethod
    def from_file(cls, path: str) -> Automaton:
        """From a byte-level vocabulary file with its merges."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        as_bytes = lambda word: bytes(letters[c] for c in word)
        ids = {as_bytes(w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        return cls([(as_bytes(a), as_bytes(b)) for a, b in pairs], ids, special)

    def _gadget(self, moment: int, a: int, b: int, ab: int) -> bool:
        """The gadget of one merge; false when the state behind ``a`` has no arc ``b``."""
        if self.made[a] == -2 or self.made[b] == -2 or not self.has_arc(a, b):
            return False
        self.made[ab], self.left[ab], self.right[ab] = moment, a, b
        self.removed[a * self._size + b] = moment
        return True

    def has_arc(self, state: int, arc: int) -> bool:
        """Whether the state behind a token has an arc; the first state (-1) has all.

        It has unless the arc, or one that it grew from before it did, was removed: from the
        state, or before the copy from the one that it was copied from.
        """
        removed, made, right, size = self.removed, self.made, self.right, self._size
        until_arc = _NEVER
        while arc >= 0:
            at, until = state, until_arc
            while at >= 0:
                moment = removed.get(at * size + arc)
                if moment is not None and moment <= until:
                    return False
                if made[at] <= until:
                    until = made[at] - 1
                at = right[at]
            until_arc, arc = made[arc], self.left[arc]
        return True

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one pre-split word: the one path of the automaton that spells it."""
        arc_of = self._arcs.get
        whole = arc_of(word)
        if whole is not None:
            return [whole]
        if self._kept > TABLE_ENTRIES:
            self._table.clear()
            self._kept = 0
        row_of, size = self._table.setdefault, len(word)
        #: Per position: the arc that reaches it on the path of the bytes before it, from where, and
        #: the transitions out of the state there.
        reached, starts, rows = [-1], [0], [row_of(-1, {})]
        for end in range(1, size + 1):
            for at in range(end - 1, -1, -1):
                arc = arc_of(word[at:end])
                if arc is None:
                    continue
                found = rows[at].get(arc)
                if found is None:
                    found = rows[at][arc] = self.has_arc(reached[at], arc)
                    self._kept += 1
                if found:
                    reached.append(arc)
                    starts.append(at)
                    rows.append(row_of(arc, {}))
                    break
            else:
                raise ValueError(f"no token for byte {word[end - 1]}")
        out = []
        while size:
            out.append(reached[size])
            size = starts[size]
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        """Ids of a text, special tokens included."""
        if text.isalpha() or (text[:1] == " " and text[1:].isalpha()):
            return self.encode_word(text.encode())
        out: list[int] = []
        for k, part in enumerate(self._marks.split(text) if self._marks else [text]):
            if k % 2:
                out.append(self.special[part])
            else:
                for word in self._split.findall(part):
                    out += self.encode_word(word.encode())
        return out

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        """The labels of the arcs, joined."""
        label = self.label
        return b"".join([label[i] for i in ids])

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


_loaded: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    """The automaton of a vocabulary file, compiled once per process."""
    if path not in _loaded:
        _loaded[path] = Automaton.from_file(path)
    return _loaded[path]


class ChunkCoder:
    """Encodes texts chunk by chunk and remembers what a chunk gave.

    Chunks are independent: a token never crosses from one into the next. ``make``
    turns a list of new chunks into what is remembered of each. Memory is bounded:
    two generations of about ``remembered`` bytes, and what one text adds.
    """

    def __init__(self, make, remembered: int = REMEMBERED):
        self._make = make
        self._most = remembered
        self._bytes = 0
        self._young: dict[str, object] = {}
        self._old: dict[str, object] = {}
        self._cut = re.compile(CHUNK).findall

    def __call__(self, text: str) -> list:
        young, old = self._young, self._old
        if self._bytes > self._most:
            self._old, self._young, self._bytes = young, {}, 0
            young, old = self._young, young
        chunks = self._cut(text)
        out = [young.get(c) for c in chunks]
        if None in out:
            lost = {c for c, made in zip(chunks, out) if made is None}
            new = []
            for chunk in lost:
                made = old.get(chunk)
                if made is None:
                    new.append(chunk)
                else:
                    young[chunk] = made
            young.update(zip(new, self._make(new)))
            self._bytes += ENTRY_BYTES * len(lost) + 5 * sum(map(len, lost))
            out = [young[c] for c in chunks]
        return out


_coders: dict[str, ChunkCoder] = {}


def _text_coder(path: str) -> ChunkCoder:
    """Gives the ids of chunks in digits and their decoded text.

    One per worker process, so its later tasks find the chunks it has met.
    """
    if path not in _coders:
        machine = automaton(path)
        digits = {i: str(i) for i in machine.label}

        def make(chunks: list[str]) -> Iterator[tuple[str, str]]:
            for chunk in chunks:
                ids = machine.encode(chunk)
                back = machine.decode(ids)
                # Chunks hold whole characters, so their texts join; the same text is kept once.
                yield ",".join([digits[i] for i in ids]), chunk if back == chunk else back

        _coders[path] = ChunkCoder(make)
    return _coders[path]


def encode_documents(
    docs: DataFrame, path: str, text_col: str = "text", columns: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` with ``ids`` (array of int): the whole text, encoded.

    ``columns`` names those to keep (all by default); what is not kept, such as the text,
    is not sent back from the Python workers.

    - Null text: as empty, no ids. Repeated rows are encoded each.
    - A very long text is handled chunk by chunk; its ids are one array.
    - Empty input gives an empty result; extra columns pass through, one named
      ``ids`` is replaced.
    """
    kept = [c for c in (docs.columns if columns is None else columns) if c != "ids"]
    # The text comes first, under a name of its own, and once more if it is kept.
    rows = docs.select(F.col(f"`{text_col}`").alias("__encoded"), *[f"`{c}`" for c in kept])
    schema = StructType([*rows.schema.fields[1:]]).add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        # Of this task alone: a job with other work leaves no room for lasting memories.
        coder = ChunkCoder(lambda chunks: [np.array(machine.encode(c), "<i4").tobytes() for c in chunks], TASK_REMEMBERED)
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_DOCS):
                part = batch.slice(first, BATCH_DOCS)
                found = [b"".join(coder(t.as_py() or "")) for t in part.column(0)]
                cuts = np.cumsum([0] + [len(f) // 4 for f in found], dtype=np.int32)
                values = pa.array(np.frombuffer(b"".join(found), "<i4"))
                ids = pa.ListArray.from_arrays(pa.array(cuts), values)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], ids], names=[*kept, "ids"])

    return rows.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the text of ``ids_col``; null ids give an empty text."""
    schema = StructType([*encoded.schema.fields]).add("decoded", "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = automaton(path)
        for batch in batches:
            yield batch.assign(decoded=[machine.decode(() if i is None else i) for i in batch[ids_col]])

    return encoded.mapInPandas(run, schema)


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_tokens, ids_sha256 and decoded_sha256 of its encoding and decoding.

    The same encoder as ``encode_documents``; the ids and the decoded text are
    hashed where they arise, so neither leaves the task. Null and empty texts have
    no ids; both digests are then those of the empty string. Null ids of
    documents, repeated rows and ties pass through as rows of their own.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = StructType([rows.schema["doc_id"]]).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _text_coder(path)
        for batch in batches:
            counts, ids_hash, text_hash = [], [], []
            texts = batch.column(1)
            for k in range(len(texts)):
                made = coder(texts[k].as_py() or "")
                ids = ",".join([m[0] for m in made])
                counts.append(ids.count(",") + bool(ids))
                ids_hash.append(hashlib.sha256(ids.encode()).hexdigest())
                text_hash.append(hashlib.sha256("".join([m[1] for m in made]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)
