"""Benchmark decontamination with a positional inverted index.

``build_index`` writes one index row per block of documents: for every term of
the test set the ascending word positions where it stands.  ``search`` takes a
window's terms from the rarest posting list of the block to the most frequent,
shifts each list by the term's offset and intersects; what is left are exact
phrase starts.  ``search_near`` uses the same lists for terms that stand within
a distance.  The index is sharded by document, so nothing is shuffled by term
and a frequent term or passage only lengthens the lists of its own blocks.

The test set is collected in blocks of ``BENCH_BYTES`` text (its size is
measured first); each block is one pass over the documents.  With several
blocks the documents are stored with a key for each row, by which the passes
are put together.

Defined cases: null or empty text has no words and no hits; a null item id
counts as the item "null"; items without words have no window; repeated items
and repeated documents are handled row by row; an empty table gives no rows.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (blocks, concat_ranges, id_and_text, ids_of, in_sorted,
                     split_words, store, word_hashes)

WINDOW = 10
BENCH_BYTES = 4 << 20
#: Text behind an index row: its lists stay small objects for the JVM that stores them.
INDEX_BYTES = 512 << 10

INDEX_SCHEMA = ("doc_ids array<bigint>, first_word array<int>, terms array<int>, "
                "term_start array<int>, positions array<int>")
HIT_SCHEMA = "doc_id bigint, n_words bigint, hit_start array<int>, hit_end array<int>, items array<string>"


@dataclass
class TestSet:
    """Windows of a block of test items as rows of term numbers (-1: no term)."""

    vocabulary: np.ndarray
    windows: np.ndarray
    length: np.ndarray
    item_start: np.ndarray
    items: np.ndarray
    names: list[str]

    @classmethod
    def of(cls, rows: list[tuple], size: int = WINDOW) -> TestSet:
        names = sorted({"null" if i is None else str(i) for i, _ in rows})
        number = {n: k for k, n in enumerate(names)}
        found: dict[tuple, set[int]] = {}
        for item, text in rows:
            words = [int(h) for h in word_hashes(text or "")]
            for at in range(max(1, len(words) - size + 1) if words else 0):
                found.setdefault(tuple(words[at:at + size]), set()).add(number["null" if item is None else str(item)])
        vocabulary = np.array(sorted({w for win in found for w in win}), dtype=np.uint64)
        place = {int(w): k for k, w in enumerate(vocabulary)}
        windows = np.full((len(found), size), -1, dtype=np.int64)
        for k, win in enumerate(found):
            windows[k, :len(win)] = [place[w] for w in win]
        counts = np.array([len(v) for v in found.values()], dtype=np.int64)
        return cls(vocabulary, windows, (windows >= 0).sum(axis=1),
                   np.concatenate([[0], np.cumsum(counts)]).astype(np.int64),
                   np.array([i for v in found.values() for i in sorted(v)], dtype=np.int64), names)


def test_sets(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
              size: int = WINDOW, limit: int = BENCH_BYTES):
    """The test set in blocks whose text is about ``limit`` bytes."""
    items = benchmark.select(F.col(id_col).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("words")).distinct()
    total = items.agg(F.sum(F.octet_length("words")).alias("b")).first()["b"] or 0
    n = -(-total // limit) or 1
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == k)
        yield TestSet.of([(r["item"], r["words"]) for r in part.collect()], size)


def _postings(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, ...]:
    """First words of a block's documents, its terms, where each one's list starts, positions."""
    hashes, first, _ = split_words(data, offsets)
    term = in_sorted(vocabulary, hashes)
    at = np.flatnonzero(term >= 0)
    order = np.argsort(term[at], kind="stable")
    at, term = at[order], term[at][order]
    terms, start = np.unique(term, return_index=True)
    return first, terms, np.append(start, len(at)), at


def build_index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Positional postings of the vocabulary's terms, one row per block of documents."""

    def index(batches):
        for rows, data, offsets in blocks(batches, INDEX_BYTES):
            lists = [ids_of(rows).to_pylist(), *_postings(data, offsets, vocabulary)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], type=pa.list_(pa.int64() if k == 0 else pa.int32())) for k, v in enumerate(lists)],
                ["doc_ids", "first_word", "terms", "term_start", "positions"])

    return id_and_text(docs).mapInArrow(index, INDEX_SCHEMA)


def _rows_of(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield [batch.column(c)[k].values if c == 0 else
                   batch.column(c)[k].values.to_numpy(zero_copy_only=False).astype(np.int64)
                   for c in range(5)]


def _phrase_starts(test: TestSet, terms, term_start, positions):
    """(window, start) of every exact phrase in one index row."""
    count = np.zeros(len(test.vocabulary) + 1, dtype=np.int64)
    begin = np.zeros(len(test.vocabulary) + 1, dtype=np.int64)
    count[terms], begin[terms] = np.diff(term_start), term_start[:-1]
    key = np.repeat(terms, np.diff(term_start)) << 32 | positions
    length = np.where(test.windows >= 0, count[test.windows], np.iinfo(np.int64).max)
    alive = np.flatnonzero((length > 0).all(axis=1))
    order = np.argsort(length[alive], axis=1, kind="stable")
    rarest = test.windows[alive, order[:, 0]]
    window = np.repeat(alive, count[rarest])
    start = positions[concat_ranges(begin[rarest], count[rarest])] - np.repeat(order[:, 0], count[rarest])
    rank = np.repeat(np.arange(len(alive)), count[rarest])
    for step in range(1, test.windows.shape[1]):
        if not len(start):
            break
        offset = order[rank, step]
        term = test.windows[window, offset]
        keep = (term < 0) | ((start >= 0) & (in_sorted(key, np.where(term < 0, 0, term) << 32 | np.maximum(start, 0) + offset) >= 0))
        window, start, rank = window[keep], start[keep], rank[keep]
    keep = start >= 0
    return window[keep], start[keep]


def _phrases(test: TestSet, first, terms, term_start, positions):
    """(window, start, document) of every exact phrase inside one document."""
    window, start = _phrase_starts(test, terms, term_start, positions)
    doc = np.searchsorted(first, start, side="right") - 1
    keep = start + test.length[window] <= first[np.minimum(doc + 1, len(first) - 1)]
    return window[keep], start[keep], doc[keep]


def _find(test: TestSet):
    """The search as a step over batches of index rows."""

    def find(batches):
        for doc_ids, first, terms, term_start, positions in _rows_of(batches):
            window, start, doc = _phrases(test, first, terms, term_start, positions)
            delta = np.zeros(first[-1] + 2, dtype=np.int64)
            np.add.at(delta, start, 1)
            np.add.at(delta, start + test.length[window], -1)
            hit = np.cumsum(delta)[:first[-1] + 1] > 0
            edge = np.zeros(len(hit) + 1, dtype=bool)
            edge[1:] = hit
            edge[first] = False  # a run ends with its document
            opens = hit & ~edge[:-1]
            starts = np.flatnonzero(opens)
            closing = hit.copy()
            closing[:-1] = hit[:-1] & (~hit[1:] | opens[1:])
            ends = np.flatnonzero(closing) + 1
            of = np.searchsorted(first, starts, side="right") - 1
            cut = np.searchsorted(of, np.arange(len(doc_ids) + 1))
            number = test.item_start[window + 1] - test.item_start[window]
            pair = np.unique(np.repeat(doc, number) * max(1, len(test.names)) + test.items[concat_ranges(test.item_start[window], number)])
            item_doc, item = pair // max(1, len(test.names)), pair % max(1, len(test.names))
            items = [[] for _ in range(len(doc_ids))]
            for d, i in zip(item_doc.tolist(), item.tolist()):
                items[d].append(test.names[i])
            lists = lambda v: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(v - first[of], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(np.diff(first)), lists(starts), lists(ends), pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "n_words", "hit_start", "hit_end", "items"])

    return find


def search(index: DataFrame, test: TestSet) -> DataFrame:
    """Per document: hit word ranges [hit_start, hit_end) and the items found."""
    return index.mapInArrow(_find(test), HIT_SCHEMA)


def _union_length(starts: list[int], ends: list[int]) -> int:
    total, reach = 0, 0
    for s, e in sorted(zip(starts, ends)):
        total += max(0, e - max(s, reach))
        reach = max(reach, e)
    return total


SUMMARY_SCHEMA = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def _summary(batches):
    for b in batches:
        doc, words, starts, ends, items = (b.column(k) for k in range(5))
        hits = [_union_length(s, e) for s, e in zip(starts.to_pylist(), ends.to_pylist())]
        names = [sorted(x) for x in items.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [doc, words, pa.array(hits, pa.int64()), pa.array([len(x) for x in names], pa.int64()),
             pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]),
             pa.array([h > 0 for h in hits])],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: n_words, n_hit, the items found and whether any word is hit."""
    tests = test_sets(benchmark, size=size)
    test, more = next(tests), next(tests, None)
    if more is None:
        find = _find(test)
        # found and summed up by one Python worker per task: two in a row hold twice the memory
        return store(build_index(docs, test.vocabulary), "postings").mapInArrow(lambda batches: _summary(find(batches)), SUMMARY_SCHEMA)
    # Each row has a key of its own, the same in every pass: ids may repeat or be null.
    rows = store(id_and_text(docs).withColumn("row", F.monotonically_increasing_id()), "rows")
    keyed = rows.select(F.col("row").alias("doc_id"), "text")
    found = None
    for test in chain([test, more], tests):
        hits = search(store(build_index(keyed, test.vocabulary), "postings"), test)
        found = hits if found is None else found.unionByName(hits)
    found = found.groupBy(F.col("doc_id").alias("row"), "n_words").agg(
        F.flatten(F.collect_list("hit_start")).alias("hit_start"),
        F.flatten(F.collect_list("hit_end")).alias("hit_end"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    out = rows.select("row", "doc_id").join(found, "row").select("doc_id", "n_words", "hit_start", "hit_end", "items")
    return out.mapInArrow(_summary, SUMMARY_SCHEMA)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """The rows, with all their columns, in which no window of the test set occurs."""
    for test in test_sets(benchmark, size=size):

        def keep(batches, test=test):
            for b in batches:
                for rows, data, offsets in blocks([b], column=text_col):
                    hit = np.zeros(rows.num_rows, dtype=bool)
                    hit[_phrases(test, *_postings(data, offsets, test.vocabulary))[2]] = True
                    yield rows.filter(pa.array(~hit))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def search_near(index: DataFrame, test: TestSet, words: list[str], distance: int) -> DataFrame:
    """Documents and positions where all words stand within ``distance`` words.

    Starts from the rarest list and keeps its positions that have every other
    word at most ``distance`` away in the same document.
    """
    wanted = [int(in_sorted(test.vocabulary, word_hashes(w))[0]) for w in words]

    def near(batches):
        for doc_ids, first, terms, term_start, positions in _rows_of(batches):
            lists = []
            for t in wanted:
                k = in_sorted(terms, np.array([t]))[0]
                lists.append(positions[term_start[k]:term_start[k + 1]] if k >= 0 else positions[:0])
            lists.sort(key=len)
            at = lists[0]
            doc = np.searchsorted(first, at, side="right") - 1
            for other in lists[1:]:
                low = np.searchsorted(other, np.maximum(at - distance, first[doc]))
                high = np.searchsorted(other, np.minimum(at + distance + 1, first[doc + 1]))
                at, doc = at[high > low], doc[high > low]
            yield pa.RecordBatch.from_arrays([doc_ids.take(pa.array(doc)), pa.array(at - first[doc])], ["doc_id", "position"])

    return index.mapInArrow(near, "doc_id bigint, position bigint")
