"""Vector code compression: product codebooks learnt by Lloyd rounds over cover trees.

Components become integers, vectors are cut into ``PARTS`` parts, and each part
position has a codebook of ``ENTRIES`` entries.  All arithmetic that decides
anything is on integers, so results do not depend on partitions.

1. Each task packs its vectors into chunks of ``CHUNK`` and builds, per part, a
   cover tree: centres in farthest-first order (those inserted at distance r or
   more are r apart and cover all others within r), each below the nearest centre
   of a coarser scale.  Points are stored in the tree's depth-first order, so a
   subtree is a range, and its count and sum are differences of cumulative sums.
   Trees are built once and stored.
2. A round sends the codebooks (fixed size) to the trees.  If the second nearest
   entry of a centre is further than the nearest by more than twice the subtree's
   radius, the triangle inequality gives the whole subtree to the nearest entry:
   one difference of cumulative sums.  Only ambiguous nodes descend, and only
   points right below them are compared one by one.
3. Tasks return sums and counts per entry; Spark adds them up.

Defined cases: vectors that are null, empty, hold null or non-finite components,
or components too large for a 64-bit error (2**15 at 64 dimensions) are dropped,
as are those whose length differs from that of the smallest id's vector; lengths
that ``PARTS`` does not divide are filled up with zeros; rows of equal id are
ordered by vector; rows without an id come last; fewer vectors than ``ENTRIES``
give fewer entries; equal distances go to the lower index; null labels form one
group; an empty table gives no rows.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.enrich import skew_join

from .common import concat_ranges, store

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
CHUNK = 4096  # vectors in a tree
OWN = 16  # points per centre aimed at


class CoverTree:
    """Cover tree of integer points: nodes in insertion order, points in depth-first order."""

    def __init__(self, points: np.ndarray, node: np.ndarray, parent: np.ndarray, start: np.ndarray, own: np.ndarray,
                 end: np.ndarray, radius: np.ndarray):
        self.points, self.node, self.parent, self.start, self.own, self.end, self.radius = points, node, parent, start, own, end, radius
        self.children = np.argsort(parent[1:], kind="stable") + 1
        self.n_children = np.bincount(parent[1:], minlength=len(parent))
        self.first_child = np.cumsum(self.n_children) - self.n_children
        self.cumulated = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(points, axis=0, out=self.cumulated[1:])

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Per entry: count and sum; per point: its nearest entry; number of exact point comparisons."""
        k = len(entries)
        counts, sums = np.zeros(k, np.int64), np.zeros(entries.shape, np.int64)
        near = np.zeros(len(self.points), np.uint8)
        open_, single = np.zeros(1, np.int64), []
        while len(open_):
            at = self.start[open_]
            d = distances(self.points[at], entries)
            best = d.argmin(axis=1)
            two = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(float)) if k > 1 else None
            sure = two[:, 1] - two[:, 0] > 2 * self.radius[open_] * (1 + 1e-9) + 1e-6 if k > 1 else np.ones(len(open_), bool)
            whole = open_[sure]
            if len(whole):
                a, b, e = self.start[whole], self.end[whole], best[sure]
                np.add.at(counts, e, b - a)
                np.add.at(sums, e, self.cumulated[b] - self.cumulated[a])
                near[concat_ranges(a, b - a)] = np.repeat(e, b - a)
            open_ = open_[~sure]
            single.append(concat_ranges(self.start[open_], self.own[open_]))
            open_ = self.children[concat_ranges(self.first_child[open_], self.n_children[open_])]
        single = np.concatenate(single)
        if len(single):
            e = distances(self.points[single], entries).argmin(axis=1)
            np.add.at(counts, e, 1)
            np.add.at(sums, e, self.points[single])
            near[single] = e
        return counts, sums, near, len(single)


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points to integer entries."""
    return ((points[:, None, :].astype(np.int64) - entries[None, :, :]) ** 2).sum(axis=2)


def farthest_first(x: np.ndarray, centres: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of several point sets (p, m, w): centres, their distances when inserted, each point's centre.

    Sets without ``centres`` different points repeat their last centre at distance 0.
    """
    p, m, _ = x.shape
    sets = np.arange(p)
    squares = (x ** 2).sum(axis=2)
    chosen, away = np.zeros((p, centres), np.int64), np.zeros((p, centres))
    owner, least = np.zeros((p, m), np.int64), np.full((p, m), np.inf)
    j = np.zeros(p, np.int64)
    for k in range(centres):
        if k:
            j = least.argmax(axis=1)
            away[:, k] = np.sqrt(np.maximum(least[sets, j], 0))
            if not away[:, k].any():
                break
        chosen[:, k] = j
        c = x[sets, j]
        d = np.maximum(squares - 2 * np.matmul(x, c[:, :, None])[:, :, 0] + squares[sets, j][:, None], 0)
        closer = d < least
        owner[closer] = k
        least = np.where(closer, d, least)
    return chosen, away, owner


def build_trees(x: np.ndarray) -> list[tuple[CoverTree, np.ndarray]]:
    """A cover tree for each of the point sets (p, m, w), with the points' depth-first order."""
    p, m, _ = x.shape
    exact = x.astype(float)
    chosen, away, owner = farthest_first(exact, max(1, m // OWN))
    out = []
    for s in range(p):
        n = int(max(1, np.count_nonzero(away[s]) + 1))
        centre, scale = chosen[s, :n], np.floor(np.log2(np.maximum(away[s, :n], 1e-9)))
        scale[0] = np.inf
        # the centres of coarser scales come first; the nearest of them is the parent
        coarser = np.searchsorted(-scale, -scale, side="left")
        c = exact[s, centre]
        gap = (c ** 2).sum(axis=1)[:, None] - 2 * c @ c.T + (c ** 2).sum(axis=1)
        gap[np.arange(n)[None, :] >= coarser[:, None]] = np.inf
        parent = gap.argmin(axis=1)
        parent[0] = 0
        own = np.bincount(owner[s], minlength=n)
        size, start, free = own.copy(), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for k in range(n - 1, 0, -1):
            size[parent[k]] += size[k]
        free[0] = own[0]
        for k in range(1, n):
            start[k] = free[parent[k]]
            free[parent[k]] += size[k]
            free[k] = start[k] + own[k]
        is_centre = np.zeros(m, bool)
        is_centre[centre] = True
        order = np.argsort(start[owner[s]] * 2 + ~is_centre, kind="stable")
        points = x[s, order]
        radius = np.zeros(n)
        for k in range(n):
            below = points[start[k]:start[k] + size[k]].astype(np.int64) - points[start[k]].astype(np.int64)
            radius[k] = np.sqrt(float((below ** 2).sum(axis=1).max()))
        out.append((CoverTree(points, centre, parent, start, own, start + size, radius), order))
    return out


TREE_COLUMNS = ("points", "parents", "starts", "owns", "ends", "radii", "orders")


def _packed(trees) -> list[bytes]:
    """The trees of one chunk, part after part."""
    join = lambda kind, arrays: b"".join(np.ascontiguousarray(a, kind).tobytes() for a in arrays)
    return [join("<i4", (t.points for t, _ in trees)), join("<i4", (t.parent for t, _ in trees)), join("<i4", (t.start for t, _ in trees)),
            join("<i4", (t.own for t, _ in trees)), join("<i4", (t.end for t, _ in trees)), join("<f8", (t.radius for t, _ in trees)),
            join("<i4", (o for _, o in trees))]


def _unpacked(n: int, sizes: list[int], blobs: list[bytes]) -> list[tuple[CoverTree, np.ndarray]]:
    points = np.frombuffer(blobs[0], "<i4").reshape(PARTS, n, -1)
    orders = np.frombuffer(blobs[6], "<i4").reshape(PARTS, n)
    cut = np.cumsum(sizes)[:-1]
    parent, start, own, end = (np.split(np.frombuffer(b, "<i4").astype(np.int64), cut) for b in blobs[1:5])
    radius = np.split(np.frombuffer(blobs[5], "<f8"), cut)
    return [(CoverTree(points[s], start[s], parent[s], start[s], own[s], end[s], radius[s]), orders[s]) for s in range(PARTS)]


def _trees_of(row: pa.RecordBatch, r: int) -> list[tuple[CoverTree, np.ndarray]]:
    value = lambda c: row.column(row.schema.get_field_index(c))[r].as_py()
    return _unpacked(value("n"), value("sizes"), [value(c) for c in TREE_COLUMNS])


def cover_trees(vectors: DataFrame, width: int) -> DataFrame:
    """(ids, labels, n, sizes, trees) per chunk; ``vectors`` has vec_id, label, x (integers)."""
    padded = -(-width // PARTS) * PARTS

    def build(batches):
        held = None
        for b in batches:
            held = b if held is None else pa.concat_batches([held, b])
            while held.num_rows >= CHUNK:
                yield chunk(held.slice(0, CHUNK))
                held = held.slice(CHUNK)
        if held is not None and held.num_rows:
            yield chunk(held)

    def chunk(rows):
        n = rows.num_rows
        x = np.zeros((n, padded), np.int32)
        x[:, :width] = rows.column(2).flatten().to_numpy().reshape(n, width)
        trees = build_trees(np.ascontiguousarray(x.reshape(n, PARTS, -1).transpose(1, 0, 2)))
        return pa.RecordBatch.from_arrays(
            [pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([rows.column(1).to_pylist()], pa.list_(pa.string())), pa.array([n], pa.int32()),
             pa.array([[len(t.parent) for t, _ in trees]], pa.list_(pa.int32())), *(pa.array([b], pa.binary()) for b in _packed(trees))],
            ["ids", "labels", "n", "sizes", *TREE_COLUMNS])

    schema = "ids array<bigint>, labels array<string>, n int, sizes array<int>, " + ", ".join(f"{c} binary" for c in TREE_COLUMNS)
    return vectors.select("vec_id", "label", "x").mapInArrow(build, schema)


def lloyd_round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (part, entry, component) after one round."""

    def add_up(batches):
        counts, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for b in batches:
            for r in range(b.num_rows):
                for s, (tree, _) in enumerate(_trees_of(b, r)):
                    n, total, _, _ = tree.assign(books[s])
                    counts[s] += n
                    sums[s] += total
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(PARTS, dtype=np.int32), books.shape[1])), pa.array(np.tile(np.arange(books.shape[1], dtype=np.int32), PARTS)),
             pa.array(counts.ravel()), pa.array(sums.reshape(-1, books.shape[2]).tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])

    added = trees.mapInArrow(add_up, "part int, entry int, n bigint, total array<bigint>")
    parts = added.select("part", "entry", "n", F.posexplode("total").alias("place", "x"))
    found = parts.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()  # the codebooks' size
    out = books.copy()
    for r in found:
        if r["n"]:
            out[r["part"], r["entry"], r["place"]] = int(r["x"]) // r["n"]
    return out


def final_codes(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""

    def assign(batches):
        for b in batches:
            for r in range(b.num_rows):
                n = b.column(b.schema.get_field_index("n"))[r].as_py()
                codes, error = np.zeros((n, PARTS), np.uint8), np.zeros(n, np.int64)
                for s, (tree, order) in enumerate(_trees_of(b, r)):
                    near = tree.assign(books[s])[2]
                    codes[order, s] = near
                    error[order] += ((tree.points.astype(np.int64) - books[s][near]) ** 2).sum(axis=1)
                text = codes.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [b.column(b.schema.get_field_index("ids"))[r].values, b.column(b.schema.get_field_index("labels"))[r].values,
                     pa.array([text[i:i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)]), pa.array(error)], ["vec_id", "label", "code", "error"])

    return trees.mapInArrow(assign, "vec_id bigint, label string, code string, error bigint")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Codes (vec_id, label, code, error) of all usable vectors, and the final codebooks."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.size("v") > 0)
    order = [F.asc_nulls_last("vec_id"), F.asc("x")]
    usable = rows.filter(F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    # components whose squared differences may not sum up to a bigint
    bound = F.sqrt(F.pow(F.lit(2.0), 60) / F.size("v"))
    usable = usable.filter(F.forall("v", lambda x: F.abs(x * SCALE) < F.least(bound, F.lit(2.0 ** 30))))
    whole = usable.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * SCALE).cast("int")).alias("x"))
    first = whole.orderBy(*order).limit(1).collect()
    width = len(first[0]["x"]) if first else PARTS
    whole = whole.filter(F.size("x") == width)
    start = whole.orderBy(*order).limit(ENTRIES).collect()
    trees = store(cover_trees(whole, width), "trees")
    padded = -(-width // PARTS) * PARTS
    books = np.zeros((max(1, len(start)), padded), np.int64)
    for k, r in enumerate(start):
        books[k, :width] = r["x"]
    books = np.ascontiguousarray(books.reshape(len(books), PARTS, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        books = lloyd_round(trees, books)
    return final_codes(trees, books), books


def codebooks_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.ravel().tolist()))


def vector_codes(vectors: DataFrame, **columns) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable vector."""
    codes, books = compress(vectors, **columns)
    codes = store(codes.select("vec_id", "code", "error", F.col("label").isNull().alias("unlabelled"), F.coalesce("label", F.lit("")).alias("label")), "codes")
    labels = codes.groupBy("unlabelled", "label").agg(F.sum("error").alias("label_error"))
    sha = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return skew_join(codes, labels, ["unlabelled", "label"], "inner").select("vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))
