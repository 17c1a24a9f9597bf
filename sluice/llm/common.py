"""Shared helpers: scratch tables, text blocks and byte-level word splitting.

Texts travel from the JVM as Arrow buffers and are handled in blocks of a few
megabytes, so a task's memory does not depend on how many rows its partition
holds.  One text is the smallest unit; a very long one forms its own block.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 2 << 20
LONG_WORD = 64
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Only a local-mode session without the setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-llm-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage durably: a lost executor costs at most the tasks it ran.
    Spark removes the write's shuffle files as soon as it has ended.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete a table written by ``store`` once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/llm/" in folder:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's context cleaner remove shuffle files of finished steps.

    Spark deletes them only once the driver has collected the frames that own
    them; between collections, by default half an hour apart, several steps'
    files would pile up on the executors' disks.  Results do not depend on it.
    """
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator needs; null text becomes the empty text."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES,
           column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges of about ``limit`` text bytes: (rows, bytes, offsets)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        if text.null_count:
            text = pc.fill_null(text, "" if pa.types.is_string(text.type) or pa.types.is_large_string(text.type) else b"")
        wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int64 if wide else np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
        data = text.buffers()[2]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield (batch.slice(row, end - row), data[offsets[row]:offsets[end]],
                   offsets[row:end + 1] - offsets[row])
            row = end


def ids_of(batch: pa.RecordBatch, column: str = "doc_id") -> pa.Array:
    return batch.column(batch.schema.get_field_index(column))


# --- words -----------------------------------------------------------------
# A word is a run of 0-9, a-z (A-Z lower-cased) and bytes from 0x80 on; in
# UTF-8 this is the class [^\x00-\x2F\x3A-\x60\x7B-\x7F] on code points.

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[65:91] = _IS_WORD[128:] = True
LOWER_BYTES = _LOWER.tobytes()
SPACED_BYTES = bytes(int(_LOWER[i]) if _IS_WORD[i] else 32 for i in range(256))

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_CODE = _BYTE_CODE[_LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 2**64))
_POWERS = {}


def _powers(n: int, base: np.uint64) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + (1 << 16))
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 16 << 20:
            _POWERS[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_hashes(data: np.ndarray, code: np.ndarray) -> np.ndarray:
    """S[i] = sum over j < i of code[data[j]] * base**j (mod 2**64).

    For ranges of a few hundred bytes only: modulo a power of two there are
    strings of 2,048 bytes and more that collide whatever the base is.
    """
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(code[data] * _powers(len(data), _BASE), out=out[1:])
    return out


def range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free 64-bit hashes of the byte ranges [start, end)."""
    inverse = _powers(len(sums), _BASE_INV)
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def _lanes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The first bytes of each range, at most eight, as one number (zero bytes follow)."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))[start]
    return eight & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * np.minimum(size, 8).astype(np.uint64)))


def word_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit codes of the words [start, end), A-Z as a-z.

    Words hold no zero byte, so up to eight bytes are one number and its mixing is
    one-to-one; longer words mix in eight bytes at a time, and those over
    ``LONG_WORD`` bytes have a cryptographic digest.
    """
    lower = np.append(_LOWER[data], np.zeros(8, np.uint8))
    size = end - start
    codes = mix(_lanes(lower, start, size)) if len(start) else np.zeros(0, np.uint64)
    for at in range(8, LONG_WORD, 8):
        more = np.flatnonzero((size > at) & (size <= LONG_WORD))
        if not len(more):
            break
        codes[more] = mix((codes[more] + np.uint64(at)) ^ _lanes(lower, start[more] + at, size[more] - at))
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        codes[k] = int.from_bytes(hashlib.blake2b(lower[start[k]:end[k]].tobytes(), digest_size=8).digest(), "little")
    return codes


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes in order, each document's first word number, word starts."""
    n = len(data)
    first = np.zeros(len(offsets), dtype=np.int64)
    if not n:
        return np.zeros(0, np.uint64), first, np.zeros(0, np.int64)
    inside = np.zeros(n + 1, dtype=bool)
    inside[:n] = _IS_WORD[data]
    begins = inside[:n].copy()
    begins[1:] &= ~inside[:n - 1]
    stops = inside[:n] & ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    begins[cut] = inside[cut]
    stops[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    hashes = word_codes(data, start, end)
    first[:] = np.searchsorted(start, offsets)
    return hashes, first, start


def word_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return split_words(data, np.array([0, len(data)]))[0]


def in_sorted(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of each value in the sorted table, -1 where absent."""
    if not len(table):
        return np.full(len(values), -1, dtype=np.int64)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return np.where(table[at] == values, at, -1)


def concat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges [start, start + length), one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths - starts, lengths)


# --- components ------------------------------------------------------------

def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links (a, b) of one block and the smallest node each reaches."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        np.minimum.at(low, label[x], label[y])
        np.minimum.at(low, label[y], label[x])
        low = low[low[label]]
        if np.array_equal(low, label):
            return nodes, nodes[label]
        label = low


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of the edges (a, b); component is its smallest id.

    Each round maps every node with a smaller neighbour to the smallest one and
    contracts the edges, so only local minima are left and the graph at least
    halves.  Tables of a round are stored; nothing but their sizes reaches the
    driver.
    """
    edges = edges.filter("a != b").select("a", "b")
    edges = store(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = store(edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct(), "labels")
    while not edges.isEmpty():
        smaller = edges.groupBy("a").agg(F.min("b").alias("to")).filter("to < a")
        smaller = store(smaller, "smaller")
        to_a, to_b = smaller.toDF("a", "to_a"), smaller.toDF("b", "to_b")
        new_edges = (edges.join(to_a, "a", "left").join(to_b, "b", "left")
                     .select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))
                     .filter("a != b").distinct())
        new_edges = store(new_edges, "edges")
        new_labels = store(labels.join(smaller.toDF("component", "to"), "component", "left")
                           .select("id", F.coalesce("to", "component").alias("component")), "labels")
        for old in (edges, labels, smaller):
            drop_stored(old)
        edges, labels = new_edges, new_labels
    return labels


# --- running sums ----------------------------------------------------------

def running(rows: DataFrame, group: str, order: list, terms: str | None = None, name: str = "running") -> DataFrame:
    """``rows`` with ``rank`` (from 0, within the group) and, for 16-byte ``terms``, running sums ``sum1``, ``sum2`` modulo 2**64.

    ``group`` is a bigint without nulls.  Rows are range-partitioned by group and
    order, so a group of any size is spread over partitions; each partition runs
    through its sorted rows once, and a group that began in earlier ones gets
    their totals added.  At most one group enters a partition, so the driver sees
    one row per partition.  The result is stored.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    sums = ["sum1", "sum2"] if terms else []
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", part int, line bigint, rank bigint" + "".join(f", {s} bigint" for s in sums)
    at, width = rows.columns.index(group), 1 + len(sums)

    def scan(batches):
        part, line, last, carry = TaskContext.get().partitionId(), 0, None, np.zeros(width, np.uint64)
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            keys = b.column(at).to_numpy()
            values = np.ones((n, width), np.uint64)
            if terms:
                values[:, 1:] = np.frombuffer(b"".join(b.column(b.schema.get_field_index(terms)).to_pylist()), "<u8").reshape(n, 2)
            new = np.append(last is None or keys[0] != last, keys[1:] != keys[:-1])
            total = np.cumsum(values, axis=0, dtype=np.uint64)
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            before = np.where((start > 0)[:, None], total[start - 1], np.uint64(0))
            before[start < 0] = np.zeros(width, np.uint64) - carry  # the group began in an earlier batch
            total = total - before
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(line + np.arange(n)), *(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in (total - np.eye(1, width, dtype=np.uint64)).T)],
                [*b.schema.names, "part", "line", "rank", *sums])
            line, last, carry = line + n, keys[-1], total[-1].copy()

    local = store(ranged.mapInArrow(scan, schema), name)
    ends = (local.groupBy("part").agg(F.min_by(group, "line").alias("first"), F.max_by(F.struct(group, "rank", *sums), "line").alias("last"))
            .orderBy("part").collect())  # a row per partition
    entering, reached, so_far = {}, None, np.zeros(width, np.uint64)
    for r in ends:
        key, *totals = r["last"]
        totals = np.array(totals, np.int64).view(np.uint64) + np.eye(1, width, dtype=np.uint64)[0]
        if r["first"] == reached:
            entering[r["part"]] = (reached, so_far)
        so_far = totals + so_far if key == reached else totals
        reached = key
    if not entering:
        return local.drop("part", "line")

    def add(batches):
        for b in batches:
            columns = [b.column(k) for k in range(b.num_columns)]
            keys, parts = columns[at].to_numpy(), b.column(b.schema.get_field_index("part")).to_numpy()
            for part in np.unique(parts).tolist():
                if part in entering:
                    key, more = entering[part]
                    hit = (parts == part) & (keys == key)
                    for k, extra in zip(("rank", *sums), more):
                        i = b.schema.get_field_index(k)
                        columns[i] = pa.array(np.where(hit, columns[i].to_numpy().view(np.uint64) + extra, columns[i].to_numpy().view(np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    out = store(local.mapInArrow(add, schema), name).drop("part", "line")
    drop_stored(local)
    return out
