"""Concatenate-and-cut packing with two-pass prefix sums.

Pass one tokenizes every document once and writes the ids to the shared folder
with each document's token offset inside its partition.  The partitions' totals
(one number per input partition) are summed up to global offsets.  Pass two
adds them and cuts the stream into fixed windows; a document that crosses a
window's end leaves one piece on either side, also across partitions.  Only the
very last sequence is padded.

Defined cases: null or empty text is one closing id; a document longer than a
window spans several; repeated rows are packed each; an empty table gives no
rows.  Stream order is the table's own partition and row order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, id_and_text, store
from .tokens import JSON_PATH, RANKS_PATH, encoder

WINDOW = 1024
CLOSING_ID = 0

PIECE_SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                "sequence_id bigint, offset bigint, ids binary")


def tokenize(docs: DataFrame, json_path: str = JSON_PATH, ranks_path: str = RANKS_PATH) -> DataFrame:
    """Ids of every document (little-endian, ``width`` bytes each) and its offset in the partition."""

    def encode(batches):
        enc = encoder(json_path, ranks_path)
        width = 2 if enc.ranks.n_vocab <= 1 << 16 and enc.library.get_vocab_size() <= 1 << 16 else 4
        part, at = TaskContext.get().partitionId(), 0
        for rows, _, _ in blocks(batches):
            ids = [np.append(enc.encode(t or ""), np.uint32(CLOSING_ID)).astype(f"<u{width}") for t in rows.column(1).to_pylist()]
            n = np.array([len(x) for x in ids], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, np.int32)), pa.array(at + np.cumsum(n) - n), rows.column(0), pa.array(n),
                 pa.array(np.full(len(n), width, np.int32)), pa.array([x.tobytes() for x in ids], pa.binary())],
                ["part", "at", "doc_id", "n", "width", "ids"])
            at += int(n.sum())

    return id_and_text(docs).mapInArrow(encode, "part int, at bigint, doc_id bigint, n bigint, width int, ids binary")


def pack(docs: DataFrame, window: int = WINDOW, with_ids: bool = False, **paths) -> DataFrame:
    """Pieces of all documents in sequences of ``window`` ids."""
    tokens = store(tokenize(docs, **paths), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # a row per partition
    base, reached = {}, 0
    for r in totals:
        base[r["part"]] = reached
        reached += r["n"]

    def cut(batches):
        for rows, _, _ in blocks(batches, column="ids"):
            out = []
            for part, at, doc, n, width, ids in zip(*(rows.column(k).to_pylist() for k in range(6))):
                begin, start = base[part] + at, 0
                ids = np.frombuffer(ids, f"<u{width}").astype("<u4")
                while start < n:
                    sequence, offset = divmod(begin + start, window)
                    length = min(window - offset, n - start)
                    piece = ids[start:start + length].tobytes()
                    out.append((doc, start, length, zlib.crc32(piece), n, sequence, offset, piece if with_ids else None))
                    start += length
            doc, *more, ids = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), *(pa.array(x, pa.int64()) for x in more), pa.array(ids, pa.binary())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    return tokens.mapInArrow(cut, PIECE_SCHEMA)
