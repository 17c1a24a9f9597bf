"""Removal of repeated byte strings by sampled, recursively induced suffix sorting.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts
earlier (smaller id, or earlier in the same document).

Level 0, reduction: not every suffix is sorted.  Each window of ``LENGTH``
bytes is represented by one sampled suffix in it, the one whose first ``NAME``
bytes have the smallest hash (leftmost on ties).  The choice depends on the
window's bytes alone, so equal windows sample equal suffixes at equal offsets.
Consecutive windows with one sample form a run.  A suffix tuple holds the
sample's name, the name of the run's whole context, document and position.

Level 1, sort: Spark's external sort orders the tuples by name, context and
position.  Its spill files are the disk-backed queue, and a task only
looks at neighbours, so a shard may be far larger than memory.  What a
tuple has in common with the one before it decides: the same context means all
windows of the run start earlier elsewhere; only the same name means that some
windows may (common prefix between ``NAME`` and the context); a name of its own
means that no window does.

Level 2, induction: only first tuples of contexts that share their name go one
level down.  They take their bytes along, meet again by name, and each window
left of the sample is named and compared with the others of that name: a
task holds the tuples of a few names.  A name with more than ``CROWD`` open
tuples is not gathered; its windows become tuples that are sorted like those
of level 1.

Equal tuples within a block of documents are reduced to the first before the
shuffle, so copies and hot passages do not travel.  Names are 64-bit hashes.

Defined cases: null text is empty; texts shorter than ``LENGTH`` lose nothing;
rows without an id are neither searched nor changed; rows that share an id are
one document and must hold the same text (each gets the same result); an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (blocks, concat_ranges, drop_stored, id_and_text, mix,
                     prefix_hashes, range_hashes, release_shuffles, store)

LENGTH = 100
NAME = 40
_REACH = LENGTH - NAME + 1  # names in a window
_BLOCK = 1 << 20
CROWD = 20_000
_PLACE_BITS = 22
_SEGMENT = 3 << 20

_RNG = np.random.Generator(np.random.PCG64(41))
_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: n < LENGTH: windows start, ..., start + n are still open; n >= LENGTH: the
#: n bytes from start on are covered.
TUPLE_SCHEMA = "name bigint, context bigint, doc_id bigint, start bigint, n int"


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one sample: (sample, first window, last window, sums)."""
    empty = np.zeros(0, np.int64)
    sums = prefix_hashes(data, _CODE)
    if len(data) < LENGTH:
        return empty, empty, empty, sums
    starts = np.arange(len(data) - NAME + 1)
    names = range_hashes(sums, starts, starts + NAME)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    sample = (_sliding_min(names & ~low | starts.astype(np.uint64), _REACH) & low).astype(np.int64)
    edge = np.zeros(len(data) + 1, dtype=np.int64)
    long = np.diff(offsets) >= LENGTH
    np.add.at(edge, offsets[:-1][long], 1)
    np.add.at(edge, offsets[1:][long] - LENGTH + 1, -1)
    window = np.flatnonzero(np.cumsum(edge[:len(sample)]) > 0)
    if not len(window):
        return empty, empty, empty, sums
    sample = sample[window]
    change = np.flatnonzero((sample[1:] != sample[:-1]) | (window[1:] != window[:-1] + 1)) + 1
    first, last = np.append(0, change), np.append(change - 1, len(window) - 1)
    return sample[first], window[first], window[last], sums


def _segments(rows, data, offsets):
    """A block as it is, or a very long text in segments that share LENGTH - 1 bytes."""
    ids = rows.column(0).to_numpy(zero_copy_only=False)
    if len(data) <= _SEGMENT:
        yield ids, data, offsets, 0
        return
    for row in range(len(ids)):
        for at in range(0, max(1, int(offsets[row + 1] - offsets[row]) - LENGTH + 1), _SEGMENT):
            part = data[offsets[row] + at:min(offsets[row] + at + _SEGMENT + LENGTH - 1, offsets[row + 1])]
            yield ids[row:row + 1], part, np.array([0, len(part)]), at


def _covered(doc, start, end):
    """Union of the ranges [start, end) of each document, as (doc, start, length)."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    _, group = np.unique(doc, return_inverse=True)
    wide = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * wide)
    fresh = np.flatnonzero(np.append(True, start[1:] + group[1:] * wide > reach[:-1]))
    stop = reach[np.append(fresh[1:] - 1, len(reach) - 1)] - group[fresh] * wide
    return doc[fresh], start[fresh], stop - start[fresh]


def _reduce(name, context, doc, start, n):
    """First tuple of each (name, context) of a block, and what the others cover."""
    order = np.lexsort((start, doc, context, name))
    name, context, doc, start, n = (x[order] for x in (name, context, doc, start, n))
    first = np.append(True, (name[1:] != name[:-1]) | (context[1:] != context[:-1]))[:len(name)]
    head = np.maximum.accumulate(np.where(first, np.arange(len(name)), 0)) if len(name) else np.zeros(0, np.int64)
    other = ~first & ((doc != doc[head]) | (start != start[head]))
    doc2, start2, n2 = _covered(doc[other], start[other], start[other] + n[other] + LENGTH)
    spread = mix(doc2.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start2.astype(np.uint64))
    cat = lambda a, b: pa.array(np.concatenate([a, b]))
    return pa.RecordBatch.from_arrays(
        [cat(name[first].view(np.int64), spread.view(np.int64)), cat(context[first].view(np.int64), np.zeros(len(doc2), np.int64)),
         cat(doc[first], doc2), cat(start[first], start2), cat(n[first], n2).cast(pa.int32())],
        ["name", "context", "doc_id", "start", "n"])


def sampled_suffixes(docs: DataFrame) -> DataFrame:
    """Level 0: a tuple for every run of windows."""

    def sample(batches):
        for rows, text, bounds in blocks(batches, _BLOCK):
            for ids, data, offsets, shift in _segments(rows, text, bounds):
                at, first, last, sums = _runs(data, offsets)
                if not len(at):
                    continue
                doc = np.searchsorted(offsets, first, side="right") - 1
                name = range_hashes(sums, at, at + NAME)
                context = mix(range_hashes(sums, first, last + LENGTH) + (at - first).astype(np.uint64))
                yield _reduce(name, context, ids[doc].astype(np.int64), first - offsets[doc] + shift, last - first)

    return docs.mapInArrow(sample, TUPLE_SCHEMA)


OPEN_SCHEMA = "name bigint, doc_id bigint, start bigint, n int"


def decide(tuples: DataFrame) -> DataFrame:
    """Sort tuples by name and context; compare each with its neighbours.

    Gives covered ranges (n >= LENGTH) and the tuples that stay open: first of
    their context, with another context under the same name.
    """

    def rows(name, doc, start, n):
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(name, np.int64)), pa.array(np.asarray(doc, np.int64)),
                                           pa.array(np.asarray(start, np.int64)), pa.array(np.asarray(n, np.int32))],
                                          ["name", "doc_id", "start", "n"])

    def compare(batches):
        # the last context's first tuple waits for what follows under its name
        name = context = held = head = None
        seen_other = False
        for b in batches:
            covered = np.asarray(b.column(4)) >= LENGTH
            done = b.filter(pa.array(covered)).select(["name", "doc_id", "start", "n"])
            if done.num_rows:
                yield done
            b = b.filter(pa.array(~covered))
            if not b.num_rows:
                continue
            names, contexts, doc, start, n = (c.to_numpy() for c in b.columns)
            m = len(names)
            new_name = np.append(names[0] != name if name is not None else True, names[1:] != names[:-1])
            new_context = new_name | np.append(contexts[0] != context if context is not None else True, contexts[1:] != contexts[:-1])
            place = np.maximum.accumulate(np.where(new_context, np.arange(m), -1))
            head_doc = np.where(place >= 0, doc[place], head[0] if head else 0)
            head_start = np.where(place >= 0, start[place], head[1] if head else 0)
            other = ~new_context & ((doc != head_doc) | (start != head_start))
            yield rows(names[other], doc[other], start[other], n[other] + LENGTH)
            # a context's first tuple is open when its name has another context
            firsts = np.flatnonzero(new_context)
            if len(firsts):
                if held is not None and (seen_other or not new_name[firsts[0]]):
                    yield rows(*([v] for v in held))
                earlier = ~new_name[firsts]
                later = np.append(~new_name[firsts[1:]], False)  # the last one waits
                opened = firsts[:-1][(earlier | later)[:-1]]
                yield rows(names[opened], doc[opened], start[opened], n[opened])
                k = firsts[-1]
                held, seen_other = (names[k], doc[k], start[k], n[k]), bool(earlier[-1])
                head = (doc[k], start[k])
            name, context = names[-1], contexts[-1]
        if held is not None and seen_other:
            yield rows(*([v] for v in held))

    return tuples.repartition("name").sortWithinPartitions("name", "context", "doc_id", "start").mapInArrow(compare, OPEN_SCHEMA)


CONTEXT_SCHEMA = "name bigint, doc_id bigint, start bigint, text binary"


def contexts_of(docs: DataFrame, opened: DataFrame) -> DataFrame:
    """The bytes of every open run, cut out of its document."""
    runs = opened.groupBy("doc_id").agg(F.collect_list(F.struct("name", "start", "n")).alias("runs"))
    both = docs.join(runs, "doc_id").select("doc_id", "text", "runs.name", "runs.start", "runs.n")

    def cut(batches):
        for rows, data, offsets in blocks(batches, _BLOCK):
            raw = data.tobytes()
            count = np.diff(np.asarray(rows.column(2).offsets))
            name, start, n = (rows.column(c).flatten().to_numpy() for c in (2, 3, 4))
            begin = np.repeat(offsets[:-1], count) + start
            texts = [raw[a:a + b + LENGTH] for a, b in zip(begin.tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(name), rows.column(0).take(pa.array(np.repeat(np.arange(len(count)), count))),
                                              pa.array(start), pa.array(texts, pa.binary())], ["name", "doc_id", "start", "text"])

    return both.mapInArrow(cut, CONTEXT_SCHEMA)


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of all windows of the contexts, the context of each, its offset there."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.cumsum(size) - size
    sums = prefix_hashes(np.frombuffer(b"".join(texts), np.uint8), _CODE)
    count = np.maximum(size - LENGTH + 1, 0)
    at = concat_ranges(begin, count)
    row = np.repeat(np.arange(len(texts)), count)
    return range_hashes(sums, at, at + LENGTH), row, at - begin[row]


def windows_of(contexts: DataFrame) -> DataFrame:
    """A tuple for every window of the contexts."""

    def induce(batches):
        for b, _, _ in blocks(batches, _BLOCK, column="text"):
            name, row, shift = _windows(b.column(3).to_pylist())
            doc, start = (b.column(c).to_numpy()[row] for c in (1, 2))
            yield _reduce(name, np.zeros_like(name), doc, start + shift, np.zeros(len(name), np.int64))

    return contexts.mapInArrow(induce, TUPLE_SCHEMA)


def compare_windows(contexts: DataFrame) -> DataFrame:
    """Covered ranges among the windows of contexts, name by name."""

    def compare(batches):
        held = None
        for b in batches:
            held = b if held is None else pa.concat_batches([held, b])
            names = held.column(0).to_numpy()
            last = int(np.searchsorted(names, names[-1])) if len(names) else 0
            if last and held.num_rows >= CROWD // 4:  # all names but the last are complete
                yield covered(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield covered(held)

    def covered(b):
        name, row, shift = _windows(b.column(3).to_pylist())
        doc, start = (b.column(c).to_numpy()[row] for c in (1, 2))
        start = start + shift
        order = np.lexsort((start, doc, name))
        name, doc, start = name[order], doc[order], start[order]
        first = np.append(True, name[1:] != name[:-1])[:len(name)]
        head = np.maximum.accumulate(np.where(first, np.arange(len(name)), 0))
        other = ~first & ((doc != doc[head]) | (start != start[head]))
        doc, start, n = _covered(doc[other], start[other], start[other] + LENGTH)
        return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(doc), np.int64)), pa.array(doc), pa.array(start), pa.array(n.astype(np.int32))],
                                          ["name", "doc_id", "start", "n"])

    return contexts.repartition("name").sortWithinPartitions("name").mapInArrow(compare, OPEN_SCHEMA)


RESULT_SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, start, n) byte ranges covered by strings that also start earlier."""
    spark = docs.sparkSession
    first = store(decide(sampled_suffixes(docs)), "suffixes")
    release_shuffles(spark)
    opened = first.filter(F.col("n") < LENGTH)
    contexts = store(contexts_of(docs, opened), "contexts")
    release_shuffles(spark)
    crowded = opened.groupBy("name").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).select("name")
    second = compare_windows(contexts.join(crowded, "name", "left_anti")).unionByName(
        decide(windows_of(contexts.join(crowded, "name", "left_semi"))))
    second = store(second.filter(F.col("n") >= LENGTH), "windows")
    drop_stored(contexts)
    release_shuffles(spark)
    return first.filter(F.col("n") >= LENGTH).unionByName(second).select("doc_id", "start", "n")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """Per document: sizes, number of maximal removed runs, digest of what is left."""
    rows = id_and_text(docs, id_col, text_col)
    named = rows.filter(F.col("doc_id").isNotNull())
    ranges = repeated_ranges(named).groupBy("doc_id").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns"))
    both = rows.join(ranges, "doc_id", "left").select("doc_id", "text", "starts", "ns")

    def cut(batches):
        for part, data, offsets in blocks(batches, _BLOCK):
            out = []
            raw = data.tobytes()
            for k in range(part.num_rows):
                text, kept, at, removed, spans = raw[offsets[k]:offsets[k + 1]], [], 0, 0, 0
                if part.column(2)[k].is_valid:
                    start, n = (part.column(c)[k].values.to_numpy().astype(np.int64) for c in (2, 3))
                    _, start, n = _covered(np.zeros(len(start), np.int64), start, start + n)
                    for s, m in zip(start.tolist(), n.tolist()):
                        kept.append(text[at:s])
                        at = s + m
                    removed, spans = int(n.sum()), len(start)
                kept = b"".join([*kept, text[at:]])
                out.append((len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
            size, removed, spans, digest, kept = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, pa.int64()) for c in (size, removed, spans)), pa.array(digest), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return both.mapInArrow(cut, RESULT_SCHEMA)
