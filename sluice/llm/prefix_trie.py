"""Prefix trie of rebuilt conversations, rolled up in depth bands.

A conversation is rebuilt from the first turns of its base conversation and its
own turns after as many; every distinct sequence of first turns is a node.

1. Turns are numbered and, once rebuilt, their prefixes named by running sums in
   range partitions, so a conversation of any length is spread over tasks.  A
   prefix's name is the 128-bit sum of digests of (place, role, text): equal
   prefixes have equal names, and text stops travelling once it is digested.
2. A node is a group of equal prefixes; its smallest member stands for it and
   gives the names of all its ancestors.
3. Subtree totals: depth is cut into bands of ``BAND`` levels.  A node explodes
   only to its ancestors inside its band (``BAND`` at most), which gives totals
   within bands.  The bands' top nodes with those totals are a tree of a
   ``BAND``-th of the depth, completed by the same step; then each completed top
   node adds its total to its ancestors in the band above.  A trie of depth D takes
   log(D) / log(BAND) rounds, and no row explodes to more than ``BAND``.
4. Ids of conversations that end in a node are cut into sorted chunks in range
   partitions before a node's chunks meet, in order, in one running digest.

Defined cases: turns are ordered by turn (null first), equal ones by a digest of
role and text; null role or text is empty; repeated rows are separate turns;
rows without conv_id are ignored; ``c % 20`` has the sign of c; an empty table
gives no rows.  Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.enrich import skew_join

from .common import drop_stored, running, store

BAND = 4
#: A conversation shares turns with the first one of its group of so many ids ...
GROUP = 20
#: ... fewer than so many of them.
SHARED = 4
CHUNK = 1 << 16


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, digest, words, rank): every turn with its place in its conversation."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.md5(said("role").cast("binary")), F.md5(said("text").cast("binary"))).cast("binary"))).alias("digest"),
        F.regexp_count(said("text"), F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    turns = store(turns, "turns")
    ranked = running(turns, "conv_id", ["turn", "digest"], name="ranked").drop("turn")
    drop_stored(turns)
    return ranked


def rebuilt(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, depth, digest, words, size) and all conversations (conv_id, size)."""
    own = ranked.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    plan = own.withColumn("shared", F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    plan = plan.join(own.toDF("base", "base_size"), "base", "left").withColumn("taken", F.least("shared", F.coalesce("base_size", F.lit(0))))
    plan = store(plan.withColumn("size", F.col("taken") + F.greatest(F.col("own") - F.col("shared"), F.lit(0)))
                 .select("conv_id", "base", "shared", "taken", "size"), "conversations")
    heads = ranked.filter((F.col("rank") < SHARED - 1) & (F.col("conv_id") % GROUP == 0)).withColumnRenamed("conv_id", "base")
    first = plan.join(heads, "base").filter("rank < taken").select("conv_id", (F.col("rank") + 1).alias("depth"), "digest", "words", "size")
    rest = (skew_join(ranked, plan.drop("base"), ["conv_id"], "inner").filter("rank >= shared")
            .select("conv_id", (F.col("rank") - F.col("shared") + F.col("taken") + 1).alias("depth"), "digest", "words", "size"))
    return store(first.unionByName(rest), "rebuilt"), plan.select("conv_id", "size")


def named_prefixes(turns: DataFrame) -> DataFrame:
    """Every rebuilt turn with the name (h1, h2) of the prefix it ends and of the one before it."""
    term = F.unhex(F.md5(F.concat_ws(":", "depth", F.hex("digest")).cast("binary")))
    named = running(turns.select("conv_id", "depth", term.alias("term"), "words", "size"), "conv_id", ["depth"], "term", "prefixes")

    def before(batches):
        for b in batches:
            term = np.frombuffer(b"".join(b.column(b.schema.get_field_index("term")).to_pylist()), "<u8").reshape(-1, 2)
            above = [pa.array((b.column(b.schema.get_field_index(s)).to_numpy().view(np.uint64) - term[:, k]).view(np.int64)) for k, s in enumerate(("sum1", "sum2"))]
            keep = [b.column(b.schema.get_field_index(c)) for c in ("conv_id", "depth", "sum1", "sum2")]
            yield pa.RecordBatch.from_arrays([*keep, *above, *(b.column(b.schema.get_field_index(c)) for c in ("words", "size"))],
                                             ["conv_id", "depth", "h1", "h2", "p1", "p2", "words", "size"])

    return named.mapInArrow(before, "conv_id bigint, depth bigint, h1 bigint, h2 bigint, p1 bigint, p2 bigint, words int, size bigint")


def end_digests(ends: DataFrame) -> DataFrame:
    """(h1, h2, ends_sha256) from (h1, h2, conv_id): ids in ascending order, comma-joined."""

    def chunk(batches):
        part, seq, key, ids = TaskContext.get().partitionId(), 0, None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([part], pa.int32()), pa.array([seq]), pa.array([",".join(ids)])],
                                              ["h1", "h2", "part", "seq", "ids"])
        for b in batches:
            rows = []
            for h1, h2, c in zip(*(b.column(k).to_pylist() for k in range(3))):
                if ids and ((h1, h2) != key or len(ids) == CHUNK):
                    rows.append(out())
                    seq, ids = seq + 1, []
                key = (h1, h2)
                ids.append(str(c))
            yield from rows
        if ids:
            yield out()

    def digest(batches):
        key, sha = None, None
        for b in batches:
            done = []
            for h1, h2, ids in zip(*(b.column(b.schema.get_field_index(k)).to_pylist() for k in ("h1", "h2", "ids"))):
                if (h1, h2) != key:
                    if sha:
                        done.append((*key, sha.hexdigest()))
                    key, sha = (h1, h2), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["h1", "h2", "ends_sha256"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, sha.hexdigest())], ["h1", "h2", "ends_sha256"])

    chunks = (ends.select("h1", "h2", "conv_id").repartitionByRange("h1", "h2", "conv_id").sortWithinPartitions("h1", "h2", "conv_id")
              .mapInArrow(chunk, "h1 bigint, h2 bigint, part int, seq bigint, ids string"))
    chunks = store(chunks, "chunks")
    return (chunks.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "part", "seq")
            .mapInArrow(digest, "h1 bigint, h2 bigint, ends_sha256 string"))


def band_rollup(nodes: DataFrame, paths: DataFrame, band: int = BAND) -> DataFrame:
    """Subtree totals (h1, h2, leaves, saved).

    ``nodes``: h1, h2, depth, conv_id (whose path leads to the node), leaves,
    saved.  ``paths``: conv_id, depth, h1, h2 of every node on a path.
    """
    in_band = F.floor(F.col("depth") / band)
    steps = paths.select("conv_id", in_band.alias("band"), F.col("depth").alias("at"), "h1", "h2")
    low = nodes.select("conv_id", in_band.alias("band"), "depth", "leaves", "saved")
    total = lambda rows: rows.groupBy("h1", "h2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    within = store(total(low.join(steps, ["conv_id", "band"]).filter("at <= depth")), "bands")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    if deepest < band:
        return within
    tops = store(nodes.filter(F.col("depth") % band == 0).select("h1", "h2", (F.col("depth") / band).cast("long").alias("depth"), "conv_id")
                 .join(within, ["h1", "h2"]), "tops")
    shorter = store(paths.filter(F.col("depth") % band == 0).withColumn("depth", (F.col("depth") / band).cast("long")), "paths")
    done = band_rollup(tops, shorter, band)
    passed = (tops.filter("depth > 0").select("h1", "h2", "conv_id", (F.col("depth") - 1).alias("band")).join(done, ["h1", "h2"])
              .select("conv_id", "band", "leaves", "saved").join(steps.select("conv_id", "band", "h1", "h2"), ["conv_id", "band"]))
    out = store(total(within.unionByName(passed.select("h1", "h2", "leaves", "saved"))), "totals")
    for old in (within, tops, shorter, done):
        drop_stored(old)
    return out


def prefix_trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    ranked = numbered_turns(conversations)
    turns, convs = rebuilt(ranked)
    drop_stored(ranked)
    prefixes = store(named_prefixes(turns), "named")
    drop_stored(turns)
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("h1"), zero.alias("h2"), zero.alias("depth"), "conv_id", "n_convs", F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), zero.alias("saved"))
    grouped = prefixes.groupBy("h1", "h2", "depth").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                                        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("words").alias("words"))
    grouped = grouped.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).drop("words")
    nodes = store(root.unionByName(grouped), "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = store(nodes.join(children, ["h1", "h2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")

    # only the smallest members' paths lead to nodes
    named = nodes.select("conv_id").distinct()
    paths = skew_join(prefixes.select("conv_id", "depth", "h1", "h2"), named, ["conv_id"], "left_semi")
    paths = store(paths.unionByName(named.select("conv_id", zero.alias("depth"), zero.alias("h1"), zero.alias("h2"))), "paths")
    totals = band_rollup(nodes.select("h1", "h2", "depth", "conv_id", (F.col("n_children") == 0).cast("long").alias("leaves"), "saved"), paths, band)

    ends = prefixes.filter("depth = size").select("h1", "h2", "conv_id").unionByName(
        convs.filter("size = 0").select(zero.alias("h1"), zero.alias("h2"), "conv_id"))
    out = nodes.drop("saved").join(totals, ["h1", "h2"], "left").join(end_digests(ends), ["h1", "h2"], "left")
    parents = nodes.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = skew_join(store(out, "rolled"), parents, ["p1", "p2"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                      F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
