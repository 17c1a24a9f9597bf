"""Cover-tree codes against plain Lloyd rounds in Python integers."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from sluice.llm import queries, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int, code string"


def brute_force(rows):
    kept = [(i, [math.floor(4096 * float(x)) for x in v], y) for i, v, y in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    w = -(-len(kept[0][1]) // 8)
    parts = [[(v + [0] * (8 * w - len(v)))[p * w:p * w + w] for p in range(8)] for _, v, _ in kept]
    books = [[list(v[p]) for v in parts[:16]] for p in range(8)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min(range(len(book)), key=lambda k: (far(x, book[k]), k))
    for _ in range(6):
        for p in range(8):
            groups = defaultdict(list)
            for v in parts:
                groups[near(v[p], books[p])].append(v[p])
            for k, g in groups.items():
                books[p][k] = [sum(c) // len(g) for c in zip(*g)]
    out, by_label = [], defaultdict(int)
    for (i, _, y), v in zip(kept, parts):
        code = [near(v[p], books[p]) for p in range(8)]
        error = sum(far(v[p], books[p][k]) for p, k in enumerate(code))
        out.append((i, "".join(f"{k:02x}" for k in code), error, y))
        by_label[y] += error
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[y], sha) for i, c, e, y in out), key=repr)


def run(spark, rows, partitions=3):
    table = spark.createDataFrame([(*r, "clash") for r in rows], VECTORS).repartition(partitions)
    return sorted((tuple(r) for r in vector_codes.vector_codes(table).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def vectors(n, width, seed=0, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, width))
    x = (centres[rng.integers(0, 20, n)] + rng.normal(size=(n, width)) * spread).astype(np.float32)
    return [(i, v.tolist(), int(i % 5) if i % 7 else None) for i, v in enumerate(x)]


def test_equals_brute_force(spark):
    rows = vectors(260, 16) + [(300, None, 1), (301, [], 1), (302, [float("nan")] * 16, 1), (303, [None] + [1.0] * 15, 2),
                               (304, [float("inf")] * 16, 2), (305, [1.0] * 8, 2), (None, [0.5] * 16, None), (306, [0.0] * 16, None)]
    rows += [(400, [0.25] * 16, 3)] * 40 + [(k, [0.25] * 16, 3) for k in range(401, 460)]  # repeated rows, equal vectors
    assert run(spark, rows) == brute_force(rows)


def test_lengths_that_do_not_divide_and_few_vectors(spark):
    rows = vectors(11, 13, spread=1.0)
    assert run(spark, rows) == brute_force(rows)


def test_ties_go_to_the_lower_index(spark):
    rows = [(i, [float(x)] * 8, 0) for i, x in enumerate([0, 2, 0, 2, 1, 1, 1, 3])]
    assert run(spark, rows) == brute_force(rows)


def test_huge_components_and_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1e30] * 8, 0)]) == []


@pytest.mark.parametrize("spread", [0.001, 0.02, 1.0])
def test_trees_hold_and_assign_every_point(spread):
    x = np.array([[math.floor(4096 * c) for c in v] for _, v, _ in vectors(1500, 16, 5, spread)], np.int32)
    parts = np.ascontiguousarray(x.reshape(len(x), 8, -1).transpose(1, 0, 2))
    compared = 0
    for s, (tree, order) in enumerate(vector_codes.build_trees(parts)):
        assert sorted(order.tolist()) == list(range(len(x))) and (tree.points == parts[s][order]).all()
        for k in range(len(tree.parent)):
            inside = tree.points[tree.start[k]:tree.end[k]].astype(float) - tree.points[tree.start[k]]
            assert np.sqrt((inside ** 2).sum(axis=1)).max() <= tree.radius[k] + 1e-6
            assert k == 0 or tree.start[tree.parent[k]] < tree.start[k] and tree.end[k] <= tree.end[tree.parent[k]]
        book = tree.points[tree.start[:16]].astype(np.int64)  # the coarsest centres
        n, total, near, exact = tree.assign(book)
        expected = vector_codes.distances(tree.points, book).argmin(axis=1)
        assert (near == expected).all() and (np.bincount(expected, minlength=16) == n).all() and total.sum() == tree.points.sum()
        compared += exact
    if spread < 0.01:  # whole subtrees go to one entry
        assert compared < 8 * len(x) / 4


def test_query_equals_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    frame = queries.op11_vector_codes(spark, sf)
    expected = con.execute(f"SELECT {', '.join(frame.columns)} FROM ({queries.SQL['op11_vector_codes']})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(expected)
