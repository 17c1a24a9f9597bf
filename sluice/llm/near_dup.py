"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles.

1. Document frequencies of five-word shingles over all documents, exact for
   every shingle: documents are dealt to blocks, a block sends its distinct
   shingles to the hash ranges that count them and gets a number for each back.
2. Improved consistent weighted sampling: per document ``BANDS * ROWS`` samples
   of its weighted shingles; equal samples have probability weighted Jaccard.
3. Bands of samples are bucket keys.  A bucket's members are first compared
   with its leader, then the heads of the components that meet in it, and at
   last all members whose components still differ, in blocks of bounded size:
   there a task holds both blocks' shingles, verifies in place and gives links
   only.  Each pair is compared in the first band it shares; pairs that agree
   in fewer than half of their samples are not verified.
4. A link is a pair whose exact weighted Jaccard similarity reaches the
   threshold; links are joined to components.

Weights are term count times idf; idf falls with the logarithm of the document
frequency from 1.5 (in one document) to 1 (in all), so the weighted similarity
stays close to the plain one.  Texts with the same words are one node from the start and only
its smallest row goes through steps 3 and 4.  At similarity 0.8 a pair shares a
band with probability 0.998.

Defined cases: a text of one to four words is one shingle; texts without words
(null, empty, punctuation) are duplicates only of byte-equal texts; rows
without an id are not compared and stand for themselves; repeated rows count as
copies, and as one document in frequencies; rows of one id with different texts are compared like any others; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.dimension import local_rows
from sluice.operators.enrich import hot_keys, skew_join

from .common import (blocks, connected_components, drop_stored, id_and_text,
                     ids_of, in_sorted, mix, release_shuffles, split_words, store)

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 4
SAMPLES = BANDS * ROWS
#: Share of the documents from which a shingle is called common.
COMMON = 0.01
#: Members of a bucket that are compared with each other or with as many others at once.
MEMBERS = 1000
#: Text behind a block of documents, and behind a range of shingle hashes.
_BLOCK, _RANGE = 2 << 20, 16 << 20

_RNG = np.random.Generator(np.random.PCG64(77))
_PLACE = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEEDS = _RNG.integers(1, 2**63, SAMPLES, dtype=np.uint64)


def _gamma2_quantiles() -> np.ndarray:
    """Quantiles of the gamma(2, 1) distribution at the middles of 2**16 steps."""
    x = np.linspace(0, 40, 1 << 20)
    p = 1 - np.exp(-x) * (1 + x)
    return np.interp((np.arange(1 << 16) + 0.5) / (1 << 16), p, x)


_GAMMA = _gamma2_quantiles()
_R, _PER_R, _LOG_C = (_GAMMA.astype(np.float32), (1 / _GAMMA).astype(np.float32), np.log(_GAMMA).astype(np.float32))
_BETA = ((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes in text order, their documents, word hashes, first words."""
    words, first, _ = split_words(data, offsets)
    padded = np.append(words, np.zeros(SHINGLE, np.uint64))
    n = np.diff(first)
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), count)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[doc]
    out = np.zeros(len(at), dtype=np.uint64)
    left = first[doc + 1] - at
    for k in range(SHINGLE):
        out += np.where(left > k, padded[at + k], np.uint64(0)) * _PLACE[k]
    return mix(out), doc, words, first


def counted_sets(data: np.ndarray, offsets: np.ndarray):
    """Each document's distinct shingle hashes in ascending order, their documents and term counts, word hashes, first words."""
    hashes, doc, words, first = shingles(data, offsets)
    key = doc.astype(np.uint64) << np.uint64(32) | hashes >> np.uint64(32)
    key, index, count = np.unique(key, return_index=True, return_counts=True)
    return hashes[index], (key >> np.uint64(32)).astype(np.int64), count, words, first


def _distinct(ordered: np.ndarray) -> np.ndarray:
    """Where a sorted array's values begin."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)


def _texts(table: pa.Table):
    """A block of documents: (rows, bytes, offsets)."""
    return next(blocks(table.combine_chunks().to_batches(), table.nbytes + 1))


def in_blocks(docs: DataFrame, n_bytes: int) -> DataFrame:
    """``docs`` (doc_id, text, row) dealt to blocks: block, doc_id, row, text, copies (equal rows are one).

    A row's block depends on the row alone, so every pass finds the same blocks.
    """
    n = -(-n_bytes // _BLOCK) or 1
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "row"), F.lit(n))).repartition(-(-n // 8), "block")
    return dealt.groupBy("block", "doc_id", "row").agg(F.any_value("text").alias("text"), F.count(F.lit(1)).alias("copies"))


def document_counts(dealt: DataFrame, n_bytes: int) -> DataFrame:
    """Per block and hash range: the document counts (uint32) of the block's distinct shingles, by hash.

    A block sends its documents' shingles in order of their hashes, cut at the
    bounds of the ranges; a range holds all of a shingle's documents.  However
    common a shingle is, a block sends it once for each of its documents and gets
    one number back.
    """
    n = -(-n_bytes // _RANGE) or 1
    bounds = np.array([-(-(k << 64) // n) for k in range(n)], dtype=np.uint64)

    def send(table: pa.Table) -> pa.Table:
        _, data, offsets = _texts(table)
        hashes = np.sort(counted_sets(data, offsets)[0])
        cut = np.append(np.searchsorted(hashes, bounds), len(hashes))
        used = np.flatnonzero(np.diff(cut))
        return pa.table([pa.array(np.full(len(used), table["block"][0].as_py())), pa.array(used),
                         pa.array([hashes[cut[k]:cut[k + 1]].tobytes() for k in used], pa.binary())], ["block", "part", "hashes"])

    def count(table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["hashes"]]
        every = np.sort(np.concatenate(sent))
        at = _distinct(every)
        times = np.diff(np.append(at, len(every)))
        shared, times = every[at][times > 1], np.append(times[times > 1], 1).astype(np.uint32)  # -1, not shared: once
        found = [times[in_sorted(shared, own[_distinct(own)])].tobytes() for own in sent]
        return pa.table([table["block"], table["part"], pa.array(found, pa.binary())], ["block", "part", "counts"])

    sent = dealt.select("block", "text").groupBy("block").applyInArrow(send, "block bigint, part bigint, hashes binary")
    return sent.repartition(n, "part").groupBy("part").applyInArrow(count, "block bigint, part bigint, counts binary")


def idf(n, n_docs: int):
    """1.5 for a shingle in one document, 1 for one in all, between them by the logarithm of their number ``n``."""
    return 1.5 - np.log(np.minimum(n, n_docs)) / math.log(max(2, n_docs)) / 2


def samples(elements: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Consistent weighted samples, one row per document that begins at ``starts``.

    For element s with weight S: t = floor(ln S / r + beta), ln y = r (t - beta)
    and ln a = ln c - ln y - r; the sample is the element with the smallest a.
    The value a depends on the element and t alone, so it stands for both.
    """
    out = np.empty((len(starts), SAMPLES), dtype=np.float32)
    log_s = np.log(weights)
    for k in range(SAMPLES):
        z = (elements ^ _SEEDS[k]) * np.uint64(0xD6E8FEB86659FD93)
        z ^= z >> np.uint64(32)
        z *= np.uint64(0xCA4BCAA75EC3F625)
        z ^= z >> np.uint64(29)
        i, j, b = (z & np.uint64(0xFFFF)).astype(np.int32), (z >> np.uint64(16) & np.uint64(0xFFFF)).astype(np.int32), (z >> np.uint64(48)).astype(np.int32)
        beta = _BETA[b]
        t = np.floor(log_s * _PER_R[i] + beta)
        out[:, k] = np.minimum.reduceat(_LOG_C[j] - _R[i] * (t - beta + np.float32(1)), starts)
    return out.view(np.uint32)


SKETCH_SCHEMA = ("doc_id bigint, row binary, copies bigint, text_hash1 bigint, text_hash2 bigint, bands array<bigint>, brief binary, "
                 "total double, elements binary, weights binary")


def sketches(dealt: DataFrame, counts: DataFrame, n_docs: int) -> DataFrame:
    """Per row of ``dealt``: class hashes, band keys, one byte per sample, weighted shingles."""
    band_seed = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def sketch(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows, data, offsets = _texts(table)
        n = rows.num_rows
        elements, doc, count, words, first = counted_sets(data, offsets)
        ordered = np.sort(elements)
        by_part = np.argsort(answers["part"].to_numpy())
        found = answers["counts"].to_pylist()
        rate = idf(np.frombuffer(b"".join(found[k] for k in by_part), np.uint32), n_docs).astype(np.float32)
        weights = (count * rate[in_sorted(ordered[_distinct(ordered)], elements)]).astype(np.float32)
        cut = np.searchsorted(doc, np.arange(n + 1))
        has = np.flatnonzero(np.diff(cut))
        # the class of a text: its word sequence, or its bytes without words
        ranks = np.arange(len(words), dtype=np.uint64) - np.repeat(first[:-1], np.diff(first)).astype(np.uint64)
        one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        if len(has):
            one[has] = np.add.reduceat(mix(words + ranks * np.uint64(0x9E3779B97F4A7C15)), first[:-1][has])
            two[has] = np.add.reduceat(mix(words * np.uint64(0xCA4BCAA75EC3F625) ^ ranks), first[:-1][has])
        bare = np.setdiff1d(np.arange(n), has)
        if len(bare):
            raw = [hashlib.blake2b(data[offsets[k]:offsets[k + 1]].tobytes(), digest_size=16).digest() for k in bare]
            one[bare], two[bare] = np.frombuffer(b"".join(raw), np.uint64).reshape(-1, 2).T
        bands = [None] * n
        brief = [None] * n
        total = np.zeros(n)
        if len(has):
            s = samples(elements, weights, cut[:-1][has])
            keys = np.zeros((len(has), BANDS), dtype=np.uint64)
            for r in range(ROWS):
                keys = mix(keys + s[:, r::ROWS].astype(np.uint64) + np.uint64(1))
            keys = mix(keys ^ band_seed).view(np.int64)
            short = (s * np.uint32(2654435761) >> np.uint32(24)).astype(np.uint8)
            total[has] = np.add.reduceat(weights.astype(float), cut[:-1][has])
            for k, d in enumerate(has.tolist()):
                bands[d], brief[d] = keys[k], short[k].tobytes()
        h32 = (elements >> np.uint64(32)).astype(np.uint32)
        blob = lambda v: pa.array([v[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())
        return pa.table(
            [ids_of(rows), ids_of(rows, "row"), ids_of(rows, "copies"), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(bands, pa.list_(pa.int64())),
             pa.array(brief, pa.binary()), pa.array(total), blob(h32), blob(weights)],
            ["doc_id", "row", "copies", "text_hash1", "text_hash2", "bands", "brief", "total", "elements", "weights"])

    return dealt.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(sketch, SKETCH_SCHEMA)


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).sum(axis=-1)


def _leader_pairs(batches):
    """Sorted by key and id: each member with its bucket's first, if enough samples agree."""
    key = lead = brief = total = None
    for b in batches:
        if not b.num_rows:
            continue
        keys, ids, totals = (b.column(k).to_numpy() for k in (0, 1, 3))
        briefs = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(-1, SAMPLES)
        new = np.append(len(keys) > 0 and keys[0] != key, keys[1:] != keys[:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
        led = np.where(head >= 0, ids[head], lead if lead is not None else 0)
        of = briefs[head]
        size = totals[head]
        if (head < 0).any():
            of[head < 0], size[head < 0] = brief, total
        agree = _agree(briefs, of)
        ratio = np.minimum(totals, size) >= THRESHOLD * np.maximum(totals, size) * (1 - 1e-6)
        keep = (led != ids) & (agree * 2 >= SAMPLES) & ratio
        yield pa.RecordBatch.from_arrays([pa.array(led[keep]), pa.array(ids[keep]), pa.array(agree[keep])], ["a", "b", "agree"])
        key, lead, brief, total = keys[-1], led[-1], of[-1].copy(), size[-1]


def weighted_jaccard(e1, w1, e2, w2) -> float:
    """Exact similarity of two sets sorted by element."""
    at = in_sorted(e1, e2)
    both = at >= 0
    shared = np.minimum(w1[at[both]], w2[both]).sum(dtype=float)
    total = w1.sum(dtype=float) + w2.sum(dtype=float) - shared
    return shared / total if total else 0.0


def _verify(batches):
    read = lambda c, kind: [np.frombuffer(x, kind) for x in c.to_pylist()]
    for rows in batches:
        # pairs of few rows at a time: vectors of both sides travel with each
        for at in range(0, rows.num_rows, 512):
            b = rows.slice(at, 512)
            e1, w1, e2, w2 = (read(b.column(k), t) for k, t in ((2, np.uint32), (3, np.float32), (4, np.uint32), (5, np.float32)))
            s = np.array([weighted_jaccard(*x) for x in zip(e1, w1, e2, w2)])
            keep = pa.array(s >= THRESHOLD)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep), pa.array(s).filter(keep)], ["a", "b", "similarity"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose exact weighted Jaccard similarity reaches the threshold."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("e1"), F.col("weights").alias("w1"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("e2"), F.col("weights").alias("w2"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "e1", "w1", "e2", "w2")
    return both.mapInArrow(_verify, "a bigint, b bigint, similarity double")


def _block_links(batches):
    """Sorted by key and block pair: links between members of different components."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        held = b if held is None else pa.concat_batches([held, b])
        groups = [held.column(k).to_numpy() for k in range(3)]
        change = np.flatnonzero(np.any([g[1:] != g[:-1] for g in groups], axis=0)) + 1
        for at, end in zip(np.append(0, change), change):
            yield _links_of(held.slice(at, end - at))
        if len(change):
            held = held.slice(change[-1])
    if held is not None:
        yield _links_of(held)


def _links_of(group: pa.RecordBatch) -> pa.RecordBatch:
    group = group.take(pa.array(np.argsort(group.column(6).to_numpy(), kind="stable")))
    keys, low, high, ids, component, block, total = (group.column(k).to_numpy() for k in range(7))
    brief = np.frombuffer(b"".join(group.column(7).to_pylist()), np.uint8).reshape(-1, SAMPLES)
    bands = np.asarray(group.column(8).flatten()).reshape(-1, BANDS)
    sets = [(np.frombuffer(e, np.uint32), np.frombuffer(w, np.float32)) for e, w in zip(group.column(9).to_pylist(), group.column(10).to_pylist())]
    label = component.copy()
    apart = low[0] != high[0]  # two blocks: pairs within one are another group's
    lightest = np.searchsorted(total, total * THRESHOLD * (1 - 1e-6))
    out = []
    for i in range(len(ids)):
        near = np.arange(lightest[i], i)
        near = near[(label[near] != label[i]) & ((block[near] != block[i]) | (not apart))]
        shared = bands[near] == bands[i]
        near = near[(shared.argmax(axis=1) == np.argmax(bands[i] == keys[0])) & (2 * _agree(brief[near], brief[i]) >= SAMPLES)]
        for j in near.tolist():
            if label[j] != label[i] and weighted_jaccard(*sets[i], *sets[j]) >= THRESHOLD:
                out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                label[label == label[j]] = label[i]
    a, b = zip(*out) if out else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def row_digest(text: Column) -> Column:
    """Tells rows of one id apart."""
    return F.unhex(F.md5(text.cast("binary")))


def classes_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows with an id (doc_id, row, text_hash1, text_hash2) and their nodes.

    A node stands for all rows with the same words: text_hash1, text_hash2,
    copy_of (its smallest id), class_id and class_row (the smallest id, and its
    row, that links reach).
    """
    spark = docs.sparkSession
    named = id_and_text(docs, id_col, text_col).filter(F.col("doc_id").isNotNull()).withColumn("row", row_digest(F.col("text")))
    n_docs, n_bytes = named.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    dealt = in_blocks(named, n_bytes)
    counts = store(document_counts(dealt, n_bytes), "counts")
    release_shuffles(spark)
    every = store(sketches(dealt, counts, n_docs), "sketches")
    drop_stored(counts)
    release_shuffles(spark)
    ids = store(every.select("doc_id", "row", "text_hash1", "text_hash2", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy")).drop("copy"), "members")
    first = ids.groupBy("text_hash1", "text_hash2").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    nodes = store(first.select("text_hash1", "text_hash2", F.col("first.doc_id").alias("copy_of"), F.col("first.row").alias("row"),
                               F.monotonically_increasing_id().alias("node")), "nodes")  # numbers hold once they are stored

    sketched = every.filter(F.col("bands").isNotNull()).select("doc_id", "row", "brief", "total", "bands")
    of_node = skew_join(sketched, nodes.select(F.col("copy_of").alias("doc_id"), "row", "node"), ["doc_id", "row"], "inner")
    keyed = of_node.select(F.col("node").alias("doc_id"), "brief", "total", "bands", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).filter("x != y").select("key")
    crowded = hot_keys(every.select(F.explode("bands").alias("key")), ["key"])  # copies count here, so keys of large classes too
    bands = store(skew_join(keyed, shared, ["key"], "inner", hot=crowded).select("key", "doc_id", "brief", "total", "bands").distinct(), "bands")
    release_shuffles(spark)
    # only texts that share a band are ever verified
    wanted = nodes.join(bands.select(F.col("doc_id").alias("node")).distinct(), "node").select(F.col("copy_of").alias("doc_id"), "row", "node")
    sets = store(every.select("doc_id", "row", "elements", "weights").join(wanted, ["doc_id", "row"]).select(F.col("node").alias("doc_id"), "elements", "weights")
                 .dropDuplicates(["doc_id"]), "sets")
    drop_stored(every)
    release_shuffles(spark)

    # first its bucket's leader; a document goes to the leader it agrees with most.
    # A crowded bucket is dealt out first, and its parts' leaders meet after that
    hot = F.broadcast(local_rows(spark, hot_keys(bands, ["key"]), "hash bigint, parts bigint"))
    dealt = (bands.select("key", "doc_id", "brief", "total").withColumn("hash", F.xxhash64("key")).join(hot, "hash", "left")
             .withColumn("part", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col("parts")))))
    led_by = lambda rows, *by: (rows.select(F.xxhash64(*by).alias("key"), "doc_id", "brief", "total").repartition("key")
                                .sortWithinPartitions("key", "doc_id").mapInArrow(_leader_pairs, "a bigint, b bigint, agree bigint"))
    heads = (dealt.filter(F.col("part").isNotNull()).groupBy("key", "part").agg(F.min_by(F.struct("doc_id", "brief", "total"), "doc_id").alias("head"))
             .select("key", "head.*"))
    led = led_by(dealt, "key", "part").unionByName(led_by(heads, "key"))
    led = led.groupBy("b").agg(F.max(F.struct("agree", -F.col("a"))).alias("best")).select((-F.col("best.col2")).alias("a"), "b")
    links = store(verified(led, sets).select("a", "b"), "links")
    release_shuffles(spark)
    component = connected_components(links)

    def in_components():
        placed = bands.join(component.toDF("doc_id", "component"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
        spread = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("doc_id").alias("a"),
                                           F.count("*").alias("members"))
        return placed, spread.filter("x != y").select("key", "a", "members")

    # then the heads of the components that meet in a bucket
    placed, leaders = in_components()
    heads = placed.groupBy("key", "component").agg(F.min("doc_id").alias("b")).join(leaders, "key").filter("a != b")
    found = store(verified(heads.select("a", "b").distinct(), sets).select("a", "b"), "links")
    if not found.isEmpty():
        links = links.unionByName(found)
        component = connected_components(links)

    # then every pair of a bucket whose components still differ, block by block
    placed, leaders = in_components()
    blocks_of = F.ceil(F.col("members") / MEMBERS)
    open_rows = (placed.join(leaders.select("key", blocks_of.alias("n_blocks")), "key")
                 .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("n_blocks")))
                 .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
                 .join(sets, "doc_id")
                 .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "doc_id", "component",
                         "block", "total", "brief", "bands", "elements", "weights"))
    found = store(open_rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
                  .mapInArrow(_block_links, "a bigint, b bigint"), "links")
    release_shuffles(spark)
    if not found.isEmpty():
        component = connected_components(links.unionByName(found))

    linked = store(nodes.join(component.toDF("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node")), "linked")
    smallest = linked.groupBy("component").agg(F.min(F.struct("copy_of", "row")).alias("least")).select(
        "component", F.col("least.copy_of").alias("class_id"), F.col("least.row").alias("class_row"))
    out = skew_join(linked, smallest, ["component"], "inner").select("text_hash1", "text_hash2", "copy_of", "class_id", "class_row")
    return ids, store(out, "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, copy_of (smallest id with the same words),
    class_id (smallest id reachable over links), kept (doc_id = class_id)."""
    ids, classes = classes_of(docs, id_col, text_col)
    out = skew_join(ids, classes.drop("class_row"), ["text_hash1", "text_hash2"], "inner")
    out = out.select("doc_id", "copy_of", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))
    unnamed = id_and_text(docs, id_col, text_col).filter(F.col("doc_id").isNull()).select(
        "doc_id", F.col("doc_id").alias("copy_of"), F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"))
    return out.unionByName(unnamed)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns, without near duplicates of a smaller row (by id, then by digest of the text).

    Every class keeps one row: of rows equal in id and text it is one of them;
    rows of one id whose texts are no duplicates all stay, as do rows without an id.
    """
    _, classes = classes_of(docs, id_col, text_col)
    kept = classes.select(F.col("class_id").alias("__id"), F.col("class_row").alias("__row")).distinct()
    marked = docs.filter(F.col(id_col).isNotNull()).withColumn("__id", F.col(id_col).cast("long")).withColumn(
        "__row", row_digest(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    one = marked.join(kept, ["__id", "__row"], "left_semi").dropDuplicates(["__id", "__row"])
    return one.select(*docs.columns).unionByName(docs.filter(F.col(id_col).isNull()))
