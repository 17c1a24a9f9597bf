"""Embedding near-duplicates with an inverted multi-index.

Unit vectors are cut into halves; each half has its own codebook, learnt on a
bounded sample (``SAMPLE`` vectors), and the pairs of code words form a grid of
cells.  Every vector is indexed in its cell.  A query visits cells in the order
of the sum of its halves' distances to the code words (the multi-sequence
order) until target recall: the number of cells is calibrated so that vectors
at exactly the threshold cosine from sampled ones, in random directions, fall
into a visited cell with the probability ``TARGET``.  Vectors met there are
verified by their cosine in double precision.

Up to ``LINE`` cells that share the first half's code word and lie side by side in
the second half form a line of the grid.  A query goes once to each line it
visits, with the list of the cells it visits there, so its components (in their
own type) travel a few times, not once per cell, and in one shuffle.  A task holds
a line's vectors while its queries pass by; a crowded line's vectors are split
into blocks and its queries into parts, and every block meets every part.
Equal vectors are one class whose members count as links without being
compared.  A pair that one side finds counts for both: each vector travels with
its own visits, so a query's task knows whether the other side finds the pair
too.  Only counts and spanning links of a block leave it.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing and stand for themselves; vectors of different
lengths are never compared (each length is a separate index); rows without an
id are returned unlinked; repeated rows are equal vectors; an empty table gives
no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.enrich import skew_join

from .common import concat_ranges, connected_components, drop_stored, local_components, store

THRESHOLD = 0.95
TARGET = 0.99
SAMPLE = 16_384
CELL_SIZE = 32  # vectors aimed at per cell
LINE = 64  # cells in a line at most
BLOCK = 4096  # vectors of a line that a task holds
QUERIES = 16_384  # queries of a line that pass by them
MOST_WORDS = 4096  # code words per half at most, reached at CELL_SIZE * MOST_WORDS ** 2 = 537 million vectors


def _kmeans(points: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    words = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        near = _distances(points, words).argmin(axis=1)
        sums = np.zeros_like(words)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=k)
        words[n > 0] = sums[n > 0] / n[n > 0, None]
    return words


def _distances(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances up to a term that depends on the point alone."""
    return (words ** 2).sum(axis=1) - 2 * points @ words.T


class MultiIndex:
    """Codebooks of both halves and the number of cells a query visits."""

    def __init__(self, sample: np.ndarray, n: int, threshold: float = THRESHOLD, target: float = TARGET):
        rng = np.random.default_rng(11)
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.half = unit.shape[1] // 2
        k = int(np.clip(round((n / CELL_SIZE) ** 0.5), 1, min(MOST_WORDS, len(unit))))
        self.words = [_kmeans(unit[:, :self.half], k, rng), _kmeans(unit[:, self.half:], k, rng)]
        # the second half's words along their main direction, so that a line's cells lie side by side
        middle = self.words[1] - self.words[1].mean(axis=0)
        self.words[1] = self.words[1][np.argsort(middle @ np.linalg.svd(middle, full_matrices=False)[2][0], kind="stable")]
        # vectors at the threshold from sampled ones, in random directions
        base = unit[rng.choice(len(unit), min(len(unit), 2048), replace=False)]
        away = rng.normal(size=base.shape)
        away -= (away * base).sum(axis=1, keepdims=True) * base
        away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-300)
        other = threshold * base + (1 - threshold ** 2) ** 0.5 * away
        cell = self.cells(other)
        one, two = (_distances(x, w) for x, w in zip((base[:, :self.half], base[:, self.half:]), self.words))
        i, j = np.divmod(cell, k)
        # how many cells are nearer: for each word of one half, words of the other below a bound
        ranks = [np.searchsorted(np.sort(two[r]), one[r, i[r]] + two[r, j[r]] - one[r]).sum() for r in range(len(base))]
        self.visits = int(min(k * k, np.quantile(ranks, target) + 1))

    def cells(self, unit: np.ndarray) -> np.ndarray:
        one, two = (_distances(x, w).argmin(axis=1) for x, w in zip((unit[:, :self.half], unit[:, self.half:]), self.words))
        return one * len(self.words[1]) + two

    def line(self, cell: np.ndarray) -> np.ndarray:
        k = len(self.words[1])
        return cell // k * -(-k // LINE) + cell % k // LINE

    def visited(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, cell) of the nearest cells of each vector, by multi-sequence.

        Cell (i, j) of the ranked code words has (i + 1)(j + 1) - 1 cells at
        least as near, so only (i + 1)(j + 1) <= visits can be among the first.
        """
        one, two = (_distances(x, w) for x, w in zip((unit[:, :self.half], unit[:, self.half:]), self.words))
        a, b = np.argsort(one, axis=1, kind="stable"), np.argsort(two, axis=1, kind="stable")
        k = len(self.words[1])
        per_row = np.minimum(self.visits // (np.arange(min(k, self.visits)) + 1), k)
        i = np.repeat(np.arange(len(per_row)), per_row)
        j = np.arange(len(i)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        total = np.take_along_axis(one, a, 1)[:, i] + np.take_along_axis(two, b, 1)[:, j]
        best = np.argpartition(total, min(self.visits, len(i)) - 1, axis=1)[:, :self.visits] if self.visits < len(i) else np.broadcast_to(np.arange(len(i)), total.shape)
        cell = np.take_along_axis(a, i[best], 1) * k + np.take_along_axis(b, j[best], 1)
        return np.repeat(np.arange(len(unit)), cell.shape[1]), cell.ravel()


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _side(rows: pa.RecordBatch, dim: int) -> tuple:
    """ids, members, home cells, visited cells (with where each list starts) and unit vectors."""
    column = lambda c: rows.column(rows.schema.get_field_index(c))
    ids, members, home = (column(c).to_numpy() for c in ("id", "members", "home"))
    cells = column("cells")
    raw = [np.frombuffer(r, np.float32 if len(r) == 4 * dim else np.float64) for r in column("raw").to_pylist()]
    first = np.asarray(cells.offsets, np.int64)
    return ids, members, home, (cells.flatten().to_numpy(), first - first[0]), _unit(np.array(raw, np.float64).reshape(-1, dim))


def _visits(visits: tuple, of: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Is the cell among those that the vector ``of`` visits?"""
    values, first = visits
    count = first[of + 1] - first[of]
    pair = np.repeat(np.arange(len(of)), count)
    hit = values[concat_ranges(first[of], count)] == cells[pair]
    return np.bincount(pair, weights=hit, minlength=len(of)) > 0


def _links(x: tuple, q: tuple, threshold: float) -> pa.RecordBatch | None:
    """Link counts and spanning links among the vectors ``x`` and queries ``q`` of a line."""
    ids, weights, home, visits, there = x
    queries, more, from_, sought, here = q
    qi, xi = np.nonzero(here @ there.T >= threshold)
    met = (queries[qi] != ids[xi]) & _visits(sought, qi, home[xi])
    qi, xi = qi[met], xi[met]
    if not len(qi):
        return None
    back = ~_visits(visits, xi, from_[qi])  # the other side does not find this pair
    who, at = np.unique(np.concatenate([queries[qi], ids[xi[back]]]), return_inverse=True)
    count = np.bincount(at, weights=np.concatenate([weights[xi], more[qi[back]]])).astype(np.int64)
    nodes, least = local_components(queries[qi], ids[xi])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([who, nodes])), pa.array(np.concatenate([count, np.zeros(len(nodes), np.int64)])),
                                       pa.array(np.concatenate([who, least]))], ["id", "n", "reaches"])


def _link_lines(threshold: float, dim: int):
    """Rows sorted by (line, block, part), vectors first: a block's vectors are held, its queries pass by."""

    def link(batches):
        at, held, x = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("line", "block", "part", "query")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            for start, end in zip(np.append(0, change), np.append(change, b.num_rows)):
                key, rows = tuple(k[start] for k in keys[:3]), b.slice(start, end - start)
                if key != at:
                    at, held, x = key, [], None
                if not keys[3][start]:
                    held.append(rows)
                    continue
                if not held:
                    continue
                x = x or _side(pa.Table.from_batches(held).combine_chunks().to_batches()[0], dim)
                for k in range(0, rows.num_rows, 1024):
                    found = _links(x, _side(rows.slice(k, 1024), dim), threshold)
                    if found is not None:
                        yield found

    return link


def embedding_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                         threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """Per row: vec_id, n_links, component_id and kept (vec_id = component_id)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    usable = F.coalesce(F.col("vec_id").isNotNull() & (F.size("v") > 0)
                        & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
                        & (norm > 0) & (norm < float("inf")), F.lit(False))
    rows = rows.withColumn("usable", usable)
    good = rows.filter("usable")
    classes = store(good.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("members")).withColumn("dim", F.size("v")), "vectors")

    edges, counts = None, None
    for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect():
        dim, n = r["dim"], r["n"]
        mine = classes.filter(F.col("dim") == dim)
        # a hashed sample: about SAMPLE vectors at any size
        share = min(1.0, SAMPLE / n)
        sample = mine.filter(F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30))).select("v").toPandas()["v"]
        sample = np.stack(sample.tolist()) if len(sample) else np.stack([mine.first()["v"]]).astype(float)
        if dim == 1:  # one half would be empty: repeat the component
            sample = np.repeat(sample, 2, axis=1)
        index = MultiIndex(sample, n, threshold, target)

        def assign(batches, index=index, dim=dim):
            """Every vector in its own line with all its visits, and as a query in each line it visits."""
            line = index.line
            for b in batches:
                for at in range(0, b.num_rows, 512):
                    part = b.slice(at, 512)
                    raw = _matrix(part.column(2))
                    unit = _unit(raw)
                    wide = np.repeat(unit, 2, axis=1) / 2 ** 0.5 if dim == 1 else unit
                    n = len(unit)
                    vector, cell = index.visited(wide)
                    home = index.cells(wide)
                    short = raw.astype(np.float32)
                    exact = np.array_equal(short, raw)  # components that fit four bytes travel in four
                    blobs = pa.array([u.tobytes() for u in (short if exact else raw)], pa.binary())
                    order = np.lexsort((cell, vector))
                    vector, cell = vector[order], cell[order]
                    new = np.flatnonzero(np.append(True, (vector[1:] != vector[:-1]) | (line(cell[1:]) != line(cell[:-1]))))
                    whole = np.flatnonzero(np.append(True, vector[1:] != vector[:-1]))
                    starts = np.concatenate([whole, new])
                    lengths = np.concatenate([np.diff(np.append(whole, len(cell))), np.diff(np.append(new, len(cell)))])
                    who = pa.array(np.concatenate([np.arange(n), vector[new]]))
                    cells = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(cell[concat_ranges(starts, lengths)].astype(np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([line(home), line(cell[new])]).astype(np.int64)), pa.array(np.arange(len(starts)) >= n),
                         part.column(0).take(who), part.column(1).take(who), pa.array(home.astype(np.int64)).take(who), cells, blobs.take(who)],
                        ["line", "query", "id", "members", "home", "cells", "raw"])

        placed = store(mine.select("rep", "members", "v").mapInArrow(
            assign, "line bigint, query boolean, id bigint, members bigint, home bigint, cells array<bigint>, raw binary"), "cells")
        # a crowded line's vectors are split into blocks, its queries into parts, by hash
        count = lambda c, size: F.greatest(F.ceil(F.count_if(c) / F.lit(size)), F.lit(1).cast("bigint"))
        sizes = placed.groupBy("line").agg(count(~F.col("query"), BLOCK).alias("blocks"), count(F.col("query"), QUERIES).alias("parts"))
        sizes = store(sizes, "sizes")  # so that its size is known: a small one is broadcast and the vectors stay where they are
        own = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
        every = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
        dealt = skew_join(placed, sizes, ["line"], "inner").select(
            *placed.columns, F.when(F.col("query"), every("blocks")).otherwise(F.array(own("blocks"))).alias("_blocks"),
            F.when(F.col("query"), F.array(own("parts"))).otherwise(every("parts")).alias("_parts"))
        dealt = dealt.withColumn("block", F.explode("_blocks")).withColumn("part", F.explode("_parts")).drop("_blocks", "_parts")
        found = store(dealt.repartition("line", "block", "part").sortWithinPartitions("line", "block", "part", "query")
                      .mapInArrow(_link_lines(threshold, dim), "id bigint, n bigint, reaches bigint"), "links")
        drop_stored(placed)
        n_links = found.groupBy("id").agg(F.sum("n").alias("n"))
        links = found.filter("id != reaches").select(F.col("id").alias("a"), F.col("reaches").alias("b"))
        edges = links if edges is None else edges.unionByName(links)
        counts = n_links if counts is None else counts.unionByName(n_links)

    unlinked = rows.filter(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if edges is None:
        return unlinked.withColumn("kept", F.lit(True))
    component = connected_components(edges.distinct())
    known = (classes.select("v", "rep", "members").join(counts.toDF("rep", "n"), "rep", "left").join(component.toDF("rep", "component"), "rep", "left")
             .select("v", (F.col("members") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = good.join(known, "v").select("vec_id", "n_links", "component_id")
    out = out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    return out.unionByName(unlinked.withColumn("kept", F.lit(True)))
