"""Token ids as flat binary files with 64-bit document offsets.

One range partition of the documents gives three files: ``.bin`` (ids, unsigned
little-endian integers without any header), ``.idx`` (64-bit offsets into them, one
more than documents) and ``.doc`` (64-bit document ids; the lowest value is a null).
Where a file begins in the whole corpus comes from prefix sums of the files'
lengths. Readers map the files into memory.

The corpus is shuffled once, into id order. A task writes files under names of its
own attempt and reports them in its result rows; the written manifest lists the
attempts that counted, so a task that is lost or runs twice does no harm.
"""

from __future__ import annotations

import os
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyferry.llm.bpe_automaton import ChunkCoder
from tallyferry.session import materialise

END = 0
#: Bytes of chunks and their ids in one generation of a worker's memory.
REMEMBERED = 200 << 20
NO_ID = -(2**63)
MANIFEST = "part int, name string, first_id long, n_docs long, n_ids long, width int"


_coders: dict[tuple[str, int], tuple[ChunkCoder, int]] = {}


def library_coder(tokenizer: str, end_id: int) -> tuple[ChunkCoder, int]:
    """A coder that gives chunks as bytes of ids, and their width; one per worker process.

    It outlives a task, so a worker's later tasks find the chunks it has met.
    """
    if (tokenizer, end_id) not in _coders:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library = Tokenizer.from_file(tokenizer)
        library.no_truncation()
        library.no_padding()
        width = 2 if max(library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4

        def make(chunks: list[str]) -> list[bytes]:
            made = []
            for encoding in library.encode_batch_fast(chunks, add_special_tokens=False):
                ids = array("H" if width == 2 else "I", encoding.ids)
                if sys.byteorder == "big":
                    ids.byteswap()
                made.append(ids.tobytes())
            return made

        _coders[tokenizer, end_id] = ChunkCoder(make, REMEMBERED), width
    return _coders[tokenizer, end_id]


def arrow_uri(folder: str) -> str:
    """The folder under the name that Arrow knows its kind of store by; Spark's checkpoint folder may say ``s3a``."""
    kind, mark, place = folder.partition("://")
    return f"s3://{place}" if mark and kind in ("s3a", "s3n") else folder


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode, append ``end_id`` to each document, write; returns the manifest, in order, with ``base``.

    ``folder`` is a path that all executors share. Ids are two bytes wide when the
    vocabulary fits, else four.

    - Null or empty text: the end id alone. Null id: first in order.
    - Rows with the same id follow each other by their text; each is a document.
    - An empty table writes no file; the manifest is empty. Extra columns are not written.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, width = library_coder(tokenizer, end_id)
        end = np.array([end_id], f"<u{width}").tobytes()
        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"
        store, root = stores.FileSystem.from_uri(arrow_uri(folder))
        at, n_docs, first = 0, 0, None
        out = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            if not out:
                store.create_dir(root, recursive=True)
                out = {end_: store.open_output_stream(f"{root}/{name}.{end_}") for end_ in ("bin", "idx", "doc")}
                out["idx"].write(np.zeros(1, "<i8").tobytes())
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            first = int(ids[0]) if first is None else first
            n_docs += len(ids)
            out["doc"].write(ids.astype("<i8").tobytes())
            offsets = []
            texts = batch.column(1)
            for k in range(len(texts)):
                data = b"".join([*coder(texts[k].as_py() or ""), end])
                out["bin"].write(data)
                at += len(data) // width
                offsets.append(at)
            out["idx"].write(np.array(offsets, "<i8").tobytes())
        for file in out.values():
            file.close()
        if out:
            row = {"part": [part], "name": [name], "first_id": [first], "n_docs": [n_docs], "n_ids": [at], "width": [width]}
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types)], names=list(row))

    # Written before use: what is read later are the files of exactly these attempts.
    return with_bases(materialise(ordered.mapInArrow(run, MANIFEST), "token-manifest"))


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest in corpus order with ``base``, the ids in all files before. One row per file."""
    files = sorted(manifest.collect(), key=lambda r: (r.first_id, r.part))
    bases = np.cumsum([0] + [r.n_ids for r in files]).tolist()
    rows = [(*r, b) for r, b in zip(files, bases)]
    return manifest.sparkSession.createDataFrame(rows, MANIFEST + ", base long")


def _numbers(store: stores.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file's numbers, mapped into memory where the store is a local folder."""
    if isinstance(store, stores.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read_buffer(), kind)


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and ids_crc32."""

    def run(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = stores.FileSystem.from_uri(arrow_uri(folder))
        for batch in files:
            for file in batch.itertuples():
                path = f"{root}/{file.name}"
                ids = _numbers(store, f"{path}.bin", f"<u{file.width}")
                offsets = _numbers(store, f"{path}.idx", "<i8")
                docs = _numbers(store, f"{path}.doc", "<i8")
                step = 10_000
                for a in range(0, len(docs), step):
                    b = min(a + step, len(docs))
                    cuts = offsets[a : b + 1]
                    sums = [zlib.crc32(ids[x:y].astype("<u4")) for x, y in zip(cuts[:-1], cuts[1:])]
                    own = pd.Series(docs[a:b].astype("i8"), dtype="Int64")
                    yield pd.DataFrame(
                        {"doc_id": own.mask(own == NO_ID), "start": cuts[:-1] + file.base, "n_tokens": np.diff(cuts), "ids_crc32": sums}
                    )

    n_files = max(1, manifest.count())
    spread = manifest.repartition(n_files, "part")
    return spread.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
